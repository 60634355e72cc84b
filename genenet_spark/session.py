"""Session construction and lineage cutting.

Cluster deployments pass their own session; the builder here is for tests and
the bench (local mode). ``spark.checkpoint.dir`` is read from the session; only
a local-mode session without one gets a fresh scratch directory.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale as much as locally: adaptive execution re-plans
# joins from runtime sizes (broadcast only when the built side is measured below
# the threshold) and splits skewed shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # Size check for broadcasts: static estimate at planning, actual size under AQE.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "genenet_spark",
    extra: dict | None = None,
) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    Uses ``spark.checkpoint.dir`` when the cluster names one. Only a local-mode
    session without a setting gets a scratch directory of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a shared "
                "checkpoint directory on a cluster"
            )
        conf_dir = tempfile.mkdtemp(prefix="genenet-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once a session, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="genenet-py-")) / f"{root.name}.zip"  # served by the driver, read by no task
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def cut_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint directory and read it back.

    Survives executor loss (unlike a local checkpoint), and, unlike an RDD
    checkpoint, the re-read table carries real file sizes, so the planner's
    broadcast decisions and adaptive execution stay size-aware after many
    iterations instead of seeing an unknown (maximal) size.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/lineage/{name or uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner see that the shuffle files of finished jobs are needed no more.

    It acts on garbage collection, which a driver with little garbage puts off while executors' disks fill up. The first
    collection finds the plans that Python has let go, the second the shuffles that only those plans held.
    """
    gc.collect()
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


class Scratch:
    """Stored tables of one run: each is written as ``cut_lineage`` does and deleted when its last reader is done."""

    def __init__(self, spark: SparkSession):
        ship_package(spark)  # iterative operators have steps in Python tasks
        self.spark, self.root, self.paths = spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/lineage", {}

    def store(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete the given tables; those that aren't of this run are left alone."""
        for table in tables:
            _, path = self.paths.pop(id(table), (None, None))
            if path:
                hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)

    def drop_all_but(self, *kept: DataFrame) -> None:
        keep = {id(t) for t in kept}
        self.drop(*[t for i, (t, _) in list(self.paths.items()) if i not in keep])
