"""Spark-native engine for gene-association and gene-interaction tables.

DataFrame in, DataFrame out. Sub-packages:

* ``sources``    Parquet readers for the six input datasets and the test-table adapters.
* ``functions``  column helpers that reproduce R null / NaN semantics, skew-safe ranking.
* ``operators``  quality counts, coverage, harmonisation, graph and analysis operators.
* ``plans``      materialised intermediates, run ledger, sinks and the query catalogue.
* ``streaming``  incremental (Structured Streaming) view of the run ledger.
"""

from genenet_spark.params import DEFAULTS, Params

__all__ = ["DEFAULTS", "Params"]
