"""Incremental view of the run ledger with Structured Streaming.

The ledger is an append-only Parquet directory (``plans.ledger``): every finished
trait appends a file. Two streaming queries follow it without rescanning:

* ``trait_status_stream``: the done set (L2) and per-trait totals, kept as
  streaming aggregation state (one row per trait) and written as a whole table
  on each micro-batch.
* ``progress_stream``: entries per event-time window (tumbling), with a watermark
  so late entries within the allowed delay still count and the state of closed
  windows is dropped; windows are appended once final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from genenet_spark.params import LEDGER_STATUS_OK
from genenet_spark.plans.ledger import TRAIT_LEDGER_SCHEMA


def ledger_source(spark: SparkSession, ledger_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(TRAIT_LEDGER_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(ledger_dir)


def trait_status(entries: DataFrame) -> DataFrame:
    """Per trait: done (any ok entry), entries, errors, seconds, last entry time."""
    return entries.groupBy("trait_id").agg(
        F.max((F.col("status") == LEDGER_STATUS_OK).cast("int")).cast("boolean").alias("done"),
        F.count(F.lit(1)).alias("n_entries"),
        F.count_if(F.col("status") != LEDGER_STATUS_OK).alias("n_errors"),
        F.sum("tiempo_s").alias("tiempo_s"),
        F.max("timestamp").alias("last_seen"),
    )


def trait_status_stream(
    spark: SparkSession, ledger_dir: str, out_dir: str, checkpoint_dir: str, available_now: bool = True
) -> StreamingQuery:
    """Keep ``out_dir`` equal to ``trait_status`` over every entry seen so far."""

    def write(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_dir)

    q = (
        trait_status(ledger_source(spark, ledger_dir))
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint_dir)
        .foreachBatch(write)
    )
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()


def progress(entries: DataFrame, window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """Entries per tumbling event-time window."""
    return (
        entries.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n_entries"),
            F.count_if(F.col("status") == LEDGER_STATUS_OK).alias("n_ok"),
            F.sum("tiempo_s").alias("tiempo_s"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "n_entries", "n_ok", "tiempo_s")
    )


def progress_stream(
    spark: SparkSession, ledger_dir: str, out_dir: str, checkpoint_dir: str,
    window: str = "1 hour", watermark: str = "10 minutes", available_now: bool = True,
) -> StreamingQuery:
    """Append finished windows to a Parquet directory."""
    q = (
        progress(ledger_source(spark, ledger_dir), window, watermark)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
    )
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()
