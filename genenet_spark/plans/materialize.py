"""Materialised intermediates (M1-M4).

``materialize`` returns the stored Parquet table for a key when present and
fresh, otherwise builds it with a DataFrame job, writes it and reads it back.
Keys fingerprint the inputs' file listing (path, size, modification time), so a
changed input under the same path produces a new key instead of a stale hit.
Tables live under a shared directory (default: ``<spark.checkpoint.dir>/tables``)
so every executor and later runs see them.

A table is a folder of versions, ``<key>/<version>/part-*``, none of which is ever
changed. The file ``<key>/_SUCCESS`` names the one to read and is replaced in one
step after a version is whole: readers and a second writer never see half a table,
and whoever still reads an older version keeps it until ``forget_old``.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genenet_spark.params import Params
from genenet_spark.session import ensure_checkpoint_dir


def table_root(spark: SparkSession, root: str | None = None) -> str:
    return root or ensure_checkpoint_dir(spark).rstrip("/") + "/tables"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def _is_there(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def file_fingerprint(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Number, bytes and two order-free digests over (path, size, modification time) of all files under ``paths``.

    Spark lists the files (in tasks, once there are many folders) and adds up the digests; no file is opened. Paths that
    do not exist count as empty.
    """
    there = [p for p in paths if _is_there(spark, p)]
    if not there:
        return []
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there)
    row = files.select("path", "length", "modificationTime").agg(
        F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")),
        F.sum(F.xxhash64("modificationTime", "path", "length").cast("decimal(20,0)")),
    ).first()
    return [str(x) for x in row]


def cache_key(*parts, inputs: Iterable[str] = (), spark: SparkSession | None = None) -> str:
    """M3: md5 over the arguments and, when given, the fingerprint of the input files."""
    payload = {"args": [repr(p) for p in parts]}
    if spark is not None and inputs:
        payload["files"] = file_fingerprint(spark, inputs)
    return hashlib.md5(json.dumps(payload, sort_keys=True).encode()).hexdigest()


def exists(spark: SparkSession, key: str, root: str | None = None,
           max_age_days: float | None = None) -> bool:
    """``cache_exists``: stored, complete (``_SUCCESS``) and not older than ``max_age_days``."""
    fs, p = _hadoop_path(spark, f"{table_root(spark, root)}/{key}/_SUCCESS")
    if not fs.exists(p):
        return False
    if max_age_days is None:
        return True
    mtime_ms = fs.getFileStatus(p).getModificationTime()
    return mtime_ms >= (time.time() - max_age_days * 86400) * 1000


def location(spark: SparkSession, key: str, root: str | None = None) -> str | None:
    """The folder of the version to read, None without one."""
    fs, p = _hadoop_path(spark, f"{table_root(spark, root)}/{key}/_SUCCESS")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        version = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return f"{table_root(spark, root)}/{key}/{version}"


def _point_to(spark: SparkSession, folder: str, version: str) -> None:
    """Replace ``<folder>/_SUCCESS`` in one step: a complete file is renamed over the old one."""
    fs, new = _hadoop_path(spark, f"{folder}/_next-{version}")
    stream = fs.create(new, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    hadoop = jvm.org.apache.hadoop.fs
    over = gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    over[0] = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(new, hadoop.Path(f"{folder}/_SUCCESS"), over)


def stored_age_days(spark: SparkSession, key: str, root: str | None = None) -> DataFrame:
    """M2 as a query: age of the stored table from its files' modification times."""
    df = spark.read.parquet(location(spark, key, root))
    return df.select(F.col("_metadata.file_modification_time").alias("m")).agg(
        ((F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.max("m"))) / 86400.0).alias(
            "age_days"
        )
    )


def get(spark: SparkSession, key: str, root: str | None = None,
        max_age_days: float | None = None) -> DataFrame | None:
    if not exists(spark, key, root, max_age_days):
        return None
    return spark.read.parquet(location(spark, key, root))


def put(df: DataFrame, key: str, root: str | None = None) -> DataFrame:
    """``cache_set``: write a new version, point readers to it, then serve reads from it.

    Of two writers at once the last to finish is read; both versions are whole.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    folder = f"{table_root(spark, root)}/{key}"
    df.write.parquet(f"{folder}/{version}")
    _point_to(spark, folder, version)
    return spark.read.schema(df.schema).parquet(f"{folder}/{version}")


def forget_old(spark: SparkSession, key: str, root: str | None = None, older_than_days: float = 1.0) -> int:
    """Delete versions that are not read any more and were written over ``older_than_days`` ago; returns how many."""
    current, gone = location(spark, key, root), 0
    fs, p = _hadoop_path(spark, f"{table_root(spark, root)}/{key}")
    for st in (fs.listStatus(p) if fs.exists(p) else []):
        old = st.getModificationTime() <= (time.time() - older_than_days * 86400) * 1000
        if st.isDirectory() and old and st.getPath().getName() != (current or "").rsplit("/", 1)[-1]:
            gone += bool(fs.delete(st.getPath(), True))
    return gone


def invalidate(spark: SparkSession, key: str, root: str | None = None) -> bool:
    """M4: drop the stored table with all its versions so the next use recomputes."""
    fs, p = _hadoop_path(spark, f"{table_root(spark, root)}/{key}")
    if fs.exists(p):
        return bool(fs.delete(p, True))
    return False


def policy(params: Params) -> dict:
    """``cache_enabled`` and ``cache_max_age_days`` as arguments of ``materialize``."""
    return {"enabled": params.cache_enabled, "max_age_days": params.cache_max_age_days}


def materialize(
    spark: SparkSession,
    key: str,
    build: Callable[[], DataFrame],
    enabled: bool = True,
    root: str | None = None,
    max_age_days: float | None = None,
    refresh: bool = False,
) -> DataFrame:
    """M1 ``cache_or_compute``: stored table if present and fresh, else build and store."""
    if not enabled:
        return build()
    if not refresh:
        hit = get(spark, key, root, max_age_days)
        if hit is not None:
            return hit
    return put(build(), key, root)
