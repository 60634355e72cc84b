"""Comparable output form for registered queries.

Complex columns become text and doubles are rounded to 6 places (plus ``0.0`` to
fold ``-0.0``), so a result can be hashed against the DuckDB oracle. The
operators themselves keep native types; only the registered query applies this.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fmt(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.StructType):
        return F.concat_ws(":", *[c[f.name].cast("string") for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return F.array_join(c.cast("array<string>"), "|", "NA")
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.round(c.cast("double"), 6) + F.lit(0.0)
    return c


def presentable(df: DataFrame) -> DataFrame:
    return df.select(*[_fmt(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
