"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the pipelines are written for.  Sizes (shuffle partitions, split bytes)
# belong to the cluster and are left to it.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # wide rows are joined without sorting them when the other side of a partition
    # has proved small enough for a hash table
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # the JVM does not compile methods beyond this size, so let Spark split them
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a listing is dealt over so many tasks; by default each folder has a task of its own, up to 10,000
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # landing files are many and of few bytes: by default a task takes as many as fit into its split with 4 MB for
    # each, which is a task, and in bronze a file, for every few of them; the driver keeps something of every one
    "spark.sql.files.openCostInBytes": "65536",
    # a listing is kept by those who read it; by default 250 MB of listings also stay on the driver that none asks for again
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
    # wide tables of doubles take a quarter less than with the default
    "spark.sql.parquet.compression.codec": "zstd",
    # stream-stream joins keep their rows on disk instead of on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may run without it (tests, trial runs); it then gets a
    fresh temporary folder.  On a cluster a machine-local folder would be lost
    with its executor, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):      # local-cluster has executors
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="swinglake-")
    return _local_roots[app]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it an execution's shuffle files go when it ends, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later passes neither
    repeat its work nor depend on the executors that did it."""
    at = scratch_dir(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)
