"""Spark session settings used by tests, the bench and the query catalog."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# Settings for a large cluster (~100 TB of flights), applied only where the
# cluster configuration leaves them unset. The flight scan is the one big read:
# 512 MB splits keep the task count near 200 k. Every shuffle in the plans
# carries partially aggregated or distinct rows, so AQE coalesces the initial
# 4000 partitions down to what the data needs.
CLUSTER_DEFAULTS = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "sunset_engine", conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on, UI off and a UTC session clock.

    On a cluster the master and the shuffle width come from ``spark-submit``;
    locally they default to ``local[8]`` and 8 partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.master.startswith("local"):
        submitted = spark.sparkContext.getConf()
        for key, value in CLUSTER_DEFAULTS.items():
            if not submitted.contains(key):
                spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's ``spark.checkpoint.dir`` when set.

    Only a local session without one (tests) gets a scratch folder; on a cluster
    a missing setting, or a ``file:`` path, is an error, never a driver-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if configured.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names a machine-local folder; set one shared by the cluster")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (HDFS, S3, ...)")
    local = tempfile.mkdtemp(prefix="sunset-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), "tables", name)
