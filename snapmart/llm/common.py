"""Shared helpers: the scratch folder all executors see, and text buffers.

``store`` writes a frame as Parquet under ``spark.checkpoint.dir`` (see
:mod:`snapmart.sources.scratch`) and reads it back, so that later steps neither
recompute it nor depend on the executors that made it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.sources.scratch import scratch_path, scratch_scope

#: Rows of one Arrow batch: long texts stay small in a Python worker.
ARROW_ROWS = 1000


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it read back (cuts lineage)."""
    return store_at(df, scratch_path(df.sparkSession, label))


def store_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and return it read back."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_alone(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """Store what ``build`` returns and delete all that was stored on the way to it."""
    with scratch_scope(spark) as made:
        path = scratch_path(spark, label)
        out = store_at(build(), path)
        made.remove(path)
    return out


def store_by(df: DataFrame, label: str, key: str) -> DataFrame:
    """As :func:`store`, dealt by ``key`` into as many buckets as a shuffle has partitions.

    A grouping or join by ``key`` reads the copy without a further exchange.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return spark.table(table)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch for workers that hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column without copying; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def hash_bucket(n: int, *columns: str) -> F.Column:
    """Stable bucket 0..n-1 of the given columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(n).cast("bigint"))
