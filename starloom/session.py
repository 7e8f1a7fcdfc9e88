"""Spark session and storage helpers.

Library functions never rely on session settings for their results; the
settings here are for throughput (AQE, skew splits) and for local runs.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every starloom session wants. Sizes are for a large cluster;
# local runs override shuffle partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys at runtime (one customer may own a third of rows).
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Overwrite only the partitions a write touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Shuffle files go when the action that made them ends, not when the driver happens to collect garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession):
    """The shuffle files of each action inside are deleted when it ends, so that steps that store
    what they work out hold disk for one of them at a time. (A plan that is run again after that
    makes its shuffles again.)"""
    kept = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if kept is None else spark.conf.set(RELEASE, kept)


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the starloom settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to shared storage and is used
    as is. Only local runs (unit tests) may leave it unset; a cluster without
    a shared folder is an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = fallback or os.path.join("/tmp", "starloom-checkpoints")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder for a written
    table; the application's scratch folder is removed when it ends."""
    return f"{application_path(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def application_path(spark: SparkSession) -> str:
    """This application's folder under the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/starloom/{spark.sparkContext.applicationId}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
    return path
