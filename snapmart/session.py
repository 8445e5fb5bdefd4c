"""Spark session with the settings every job here relies on.

* UTC session zone: ``timestamptz`` columns are instants and dates are cut
  in UTC, as DuckDB does with its default zone.
* ANSI mode on (the 4.x default): a bad cast fails the job instead of
  silently giving NULL.
* Adaptive execution with skew-join splitting and partition coalescing, so
  a hot key is split at run time and small stages shrink.
* No web UI.

On a cluster the session already exists; :func:`configure` sets the semantic
settings and fills in tuning settings that nobody has set.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that are part of the semantics, not tuning.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Tuning that holds from local[8] to a large cluster.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that adds a shuffle above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A partition counts as skewed at 4x the median and 128 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Many small JSON documents are packed into one split.
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # VARIANT columns are stored with typed sub-columns for their common keys,
    # and reads of single keys become reads of those sub-columns.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.allowReadingShredded": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


#: What ``conf.get`` gives for a known setting that nobody has set.
_UNSET = "<undefined>"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings, and the tuning settings that are unset."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    for k, v in TUNING_CONF.items():
        if spark.conf.get(k, _UNSET) == _UNSET:
            spark.conf.set(k, v)
    return spark


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES,
                           minimum: int = 8) -> int:
    """Initial shuffle partitions for an expected shuffle volume.

    Adaptive execution can merge small partitions but never split a large
    one (except a skewed join side), so the initial count is sized for the
    largest shuffle: about 128 MB per partition keeps each reducer's sort
    and hash tables in executor memory without spilling. 30 TB of shuffle
    gives about 245,000 partitions; adaptive coalescing merges them back
    down wherever a stage is smaller.
    """
    return max(minimum, -(-int(shuffle_bytes) // int(target_bytes)))


def scale_conf(shuffle_bytes: int) -> dict[str, str]:
    """Settings for a cluster run sized by its largest expected shuffle."""
    n = shuffle_partitions_for(shuffle_bytes)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }


def build_session(
    master: str | None = None,
    app_name: str = "snapmart",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra_conf: dict | None = None,
    event_log_dir: str | None = None,
) -> SparkSession:
    """Create (or fetch) a session; used by tests, bench and local runs.

    ``event_log_dir`` writes Spark's event log there (stage and task times
    for later reading, without the web UI).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SEMANTIC_CONF)
    conf.update(TUNING_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if event_log_dir:
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = event_log_dir
        conf["spark.eventLog.compress"] = "false"
    if extra_conf:
        conf.update(extra_conf)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("SNAPMART_LOG_LEVEL", "ERROR"))
    return configure(spark)
