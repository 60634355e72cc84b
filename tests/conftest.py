import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from genenet_spark.session import build_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 8, app_name="genenet_spark_tests")
    yield s


@pytest.fixture(scope="session")
def sf0001():
    return SF0001
