"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs rely on; every value can be overridden by the submitter.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Overwriting a partitioned table replaces only the partitions that the job writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Old deduplication state is dropped with the next events; an empty batch just for that would
    # only leave an empty directory.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # Deduplication state outgrows the heap on a busy topic.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """Create or reuse a session with ``JOB_SETTINGS``, overridden by ``settings``.

    Master, memory, object-store endpoint and credentials belong to the submitter
    (``spark-submit --conf spark.hadoop.fs.s3a...``), so none are set here.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**JOB_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; without that it is a folder below the warehouse, which executors share
    as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job has made for itself."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let each action remove its shuffle files when it ends.

    A job is many actions that each write a table and share no shuffle, so files that wait for the driver's garbage collection only
    fill the disk.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def at_once(work: Sequence[Callable], threads: int) -> list:
    """The results of calls that do not depend on each other, ``threads`` at a time; the first failure is raised.

    Small Spark jobs leave most of a cluster idle, so several are submitted together.
    """
    with ThreadPoolExecutor(max(1, threads)) as pool:
        return [done.result() for done in [pool.submit(call) for call in work]]
