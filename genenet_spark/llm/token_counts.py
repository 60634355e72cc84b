"""Token counts through a digest cache (operator 7).

The cache is a Parquet table of (content digest, tokenizer digest, count). A run
joins the digests of its rows to the stored counts, encodes each distinct
content that has none exactly once, appends those counts, and answers from the
cache. The same content under another tokenizer file or library version has
another key, so a stale count is never served.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genenet_spark.llm.common import map_batches
from genenet_spark.llm.library import library, tokenizer_version

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts, one row a key; an absent cache is created empty."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([], CACHE_SCHEMA).write.parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path).dropDuplicates(["content", "tokenizer"])


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = library(path)
        for batch in batches:
            counts = lib.counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str, cache_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each input row, of its whole text.

    ``n_bytes`` is the UTF-8 length, ``over_limit`` says whether ``n_tokens > limit``. The normalised
    content is the text with null taken as empty: any other change could change the count. New counts are
    in the cache at ``cache_path`` when this returns.

    Cases: null and empty texts have their own (zero) count; copies of a text are encoded once, combined on
    the map side before the shuffle, so a text that fills a third of the table costs one row a task; null ids
    stay null and repeated rows are repeated; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    key = tokenizer_version(tokenizer)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.unhex(F.sha2("text", 256)).alias("content"), F.octet_length("text").cast("long").alias("n_bytes"))
    stored = open_cache(spark, cache_path).where(F.col("tokenizer") == key).select("content")
    distinct = rows.groupBy("content").agg(F.first("text").alias("text"))
    misses = distinct.join(stored, "content", "left_anti").select("content", "text")
    counted = map_batches(misses, _counter(tokenizer), "content binary, n_tokens long")
    counted.select("content", F.lit(key).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)

    counts = open_cache(spark, cache_path).where(F.col("tokenizer") == key).select("content", "n_tokens")
    return rows.select("doc_id", "content", "n_bytes").join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
