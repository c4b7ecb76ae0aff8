"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every job in this package.  AQE re-plans joins from
# runtime sizes (broadcast only when the measured side is small), coalesces
# small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoints that nothing refers to any more leave the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture for error messages costs ~30% of plan building
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "haulkit", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one (local master only when given)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; create a local one only when unset.

    On a cluster the setting names a shared folder every executor can reach.  A
    machine-local temp folder is only acceptable for a local master; with any
    other master an unset folder raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="haulkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:      # each call would make a new sub-folder
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (never localCheckpoint).

    Used where a product is reused by several later stages, so that a lost
    executor does not force recomputation of the whole upstream plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


#: Rows of a task that holds a table as long as its rows.
TASK_ROWS = 250_000


def tasks_for(table: DataFrame) -> int:
    """Tasks of TASK_ROWS rows of an input table, or one a core if those are more
    (the count of a Parquet table is read from its footers)."""
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // TASK_ROWS))


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Tables dealt out by some keys of a join are else dealt out again by all of them.
ALL_JOIN_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the writes made inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of a write made inside go when it ends, not when the driver
    happens to collect its garbage.  Only for frames that run once."""
    return setting(spark, FREE_SHUFFLES, "true")


class Steps:
    """Tables between the steps of a long product, in the shared scratch folder.

    A chain of joins run as one query keeps the shuffle files of every join until
    its end.  Stored step by step, only one step's shuffles and the compressed
    tables still needed are on disk."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}")

    def store(self, df: DataFrame, name: str, drop: Sequence[str] = (), by_part: bool = False) -> DataFrame:
        """`df` written and read back; then the tables `drop`, which nothing reads any more, are deleted.
        `by_part`: joins of tables that were dealt out by a part of their keys leave them so."""
        path = f"{self.base}/{name}"
        with shuffles_freed(self.spark), setting(self.spark, ALL_JOIN_KEYS, str(not by_part).lower()):
            df.write.option("compression", "zstd").parquet(path)
        self.drop(*drop)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(conf).delete(path, True)
