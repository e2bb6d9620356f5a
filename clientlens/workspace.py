"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Codec of what is written, whatever the session's own is.
CODEC = "zstd"

# Settings the operators are written for. Partition counts and memory stay with the caller.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Lets AQE hash-join per-client aggregates instead of sorting both sides, but only
    # where it has measured every partition to be below this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Writes of kept and rejected rows in one pass keep both files open instead of sorting.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


# Settings of a run's own jobs, whatever the session has, and what they are where the session does not say.
OF_RUNS = {
    # Shuffle files go when their job has ended, not when the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": ("true", "false"),
    "spark.sql.maxConcurrentOutputFileWriters": (RECOMMENDED["spark.sql.maxConcurrentOutputFileWriters"], "0"),
}


@contextmanager
def run_settings(spark: SparkSession) -> Iterator[None]:
    """The session with `OF_RUNS` set; as it was afterwards."""
    before = {key: spark.conf.get(key, unset) for key, (_, unset) in OF_RUNS.items()}
    for key, (value, _) in OF_RUNS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def session(app_name: str = "clientlens", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir of the session.

    Where that is unset, a folder below the warehouse of the session, which executors share as well. A
    warehouse on the driver's own disk is an error unless all runs on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_staged"


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/clientlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses, below a folder of this application."""
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has staged; results that still read from it are gone then."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
