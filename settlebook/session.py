"""SparkSession construction with the settings the settlement jobs rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job needs regardless of cluster size.
BASE_CONF = {
    # All timestamps are TIMESTAMP_NTZ holding UTC wall clock; pin the session
    # zone anyway so that any LTZ value that appears is interpreted the same way.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Popular events / payouts: let AQE split skewed join partitions.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what AQE has measured at runtime (shuffle statistics of
    # the materialised side), never on plan-time estimates from file sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # A close compiles several hundred generated classes; with the default
    # cache of 100 they are evicted and recompiled on every run, in the
    # driver and in every executor. Static: takes effect at session start.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Remove checkpoint files once their DataFrames are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "settlebook", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("SETTLEBOOK_LOG_LEVEL", "ERROR"))
    return spark


def cluster_conf(executors: int = 1000, cores_per_executor: int = 8) -> dict:
    """Settings for a large cluster (e.g. 1000 executors over ~100 TB).

    Shuffles start wide (three waves of tasks) and AQE coalesces them to
    ~256 MB partitions; scans split at 256 MB; a partition 4x the median and
    over 512 MB counts as skewed and is split by AQE's skew-join handling;
    runtime broadcast only for sides measured under 64 MB.
    """
    slots = executors * cores_per_executor
    return {
        "spark.sql.shuffle.partitions": str(slots * 3),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(slots * 3),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
        # coalesce by size, not by parallelism (Spark's advice for shared clusters)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
