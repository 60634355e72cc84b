"""Helpers shared by the operators: table access, scratch tables, Arrow batch plumbing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genenet_spark.session import ensure_checkpoint_dir, free_shuffles, ship_package  # noqa: F401

#: The six ASCII white-space bytes that separate words in the row contracts (fixed values).
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: Rows and bytes that a Python task of a memory-bound step gets at once. Spark's own bound of 10,000 rows is 20 MB of common
#: texts, held by the JVM, by Arrow and as Python objects.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and gives the planner real sizes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frozen: DataFrame) -> None:
    """Delete stored tables that no frame is read from any more."""
    for df in frozen:
        remove_tree(df.sparkSession, df._scratch)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a superseded scratch table through the store's own file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def doc_crc(doc_id: Column) -> Column:
    """Unsigned crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package; Arrow's free memory goes back to the system when a task ends."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python tasks of the jobs run inside get ``BATCH_ROWS`` rows at once, or fewer; the session's settings come back."""
    keys = {f"spark.sql.execution.arrow.max{what}PerBatch": most for what, most in (("Records", BATCH_ROWS), ("Bytes", BATCH_BYTES))}
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        for key, most in keys.items():
            spark.conf.set(key, str(most))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def in_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, ``BATCH_ROWS`` at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def least_count(counts: DataFrame, most: int) -> int:
    """The least count whose rows, with all of greater count, are at most ``most``; from a histogram of count classes."""
    # Classes of about 9 % width: a few hundred rows whatever the corpus.
    histogram = counts.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("c")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("low"))
    least, total = 1 << 62, 0
    for r in sorted(histogram.collect(), key=lambda r: -r["c"]):
        total += r["k"]
        if total > most:
            break
        least = r["low"]
    return least
