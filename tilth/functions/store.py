"""Where intermediate tables live: the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What Spark sends to a Python worker at a time; by itself 64 MB, held on both sides and twice by the worker.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20

# Temporary folders of local applications that name no shared folder.
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder of the session.

    On a cluster it must be configured; a machine-local folder is only used by a
    local master, where driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        # A relative path means another folder on each machine.
        if not spark.sparkContext.master.startswith("local") and ":" not in configured and not configured.startswith("/"):
            raise RuntimeError("spark.checkpoint.dir must be an absolute path or a URI")
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="tilth-")
    return _local_dirs[application]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Used where several later passes would each repeat the same shuffle.  Unlike
    cached blocks the table survives lost executors; unlike an RDD checkpoint it
    is columnar, so later passes read only the columns they use.
    """
    spark = df.sparkSession
    path = new_path(spark, "table")
    # The written table replaces the shuffles behind it, so their files can go at once.
    with brief_shuffles(spark):
        df.write.parquet(path)
    _remove_at_end(spark, path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def drop(table: DataFrame) -> None:
    """Remove a table of ``cut`` that nothing reads any more, before the application ends."""
    path = getattr(table, "_written", None)
    if path is not None:
        jvm, context = table.sparkSession._jvm, table.sparkSession.sparkContext
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames that are made and run inside drop their shuffles at the end of a job."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that start inside send at most ``BATCH_BYTES`` to a Python worker at a time; a bound that the session sets stays."""
    if spark.conf.get(BATCH, None) is not None:
        yield
        return
    spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH)


def _remove_at_end(spark: SparkSession, path: str) -> None:
    """Let the driver remove a written table when the application ends."""
    jvm, context = spark._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(target)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread a table that was read in few pieces before work that is heavy per row.

    A table with at least two scan tasks per core is returned as it is, so large
    inputs are never shuffled for this.  ``scan`` should be a plain read: asking a
    plan with shuffles for its partitions would run them.
    """
    wanted = 2 * scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= wanted:
        return scan
    return scan.repartition(wanted, *keys)
