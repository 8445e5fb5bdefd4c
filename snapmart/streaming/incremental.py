"""Take in only new game documents, as a bounded file stream.

The file source remembers in its checkpoint which files it has read, so a
run processes exactly the documents that arrived since the last one; with
``trigger(availableNow=True)`` the query takes everything available (in
batches of ``max_files`` files) and then stops, like a scheduled batch job.
The sink writes Parquet with the game id from the path, ready for
``stg_games`` / ``stg_plays``. No state is held beyond the file list.

A document that does not parse is stored with its text in
``_corrupt_record`` and all else NULL, so it neither stops the run nor is
read again; :func:`game_documents` reads the others, :func:`ingest_counts`
counts both.

:func:`ingest_keyed` takes new files of any schema into a store by key: each
micro-batch appends only keys that the store does not hold, and the store keeps
the number of the last batch it has taken, so a batch that is run again after a
crash between the store's commit and the stream's is applied once.

Restarts are safe: the checkpoint and the sink's own log make each batch
exactly-once, so a lost executor or a killed run is simply run again.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import path_part
from ..schemas import LAYOUT, PLAY_BY_PLAY
from ..sources.documents import SOURCE_PATH
from ..sources.keyed_store import append_unseen


CORRUPT = "_corrupt_record"


def game_documents(spark: SparkSession, out_path: str) -> DataFrame:
    """The stored documents that parsed."""
    return spark.read.parquet(out_path).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def ingest_counts(spark: SparkSession, out_path: str) -> dict[str, int]:
    """How many stored documents parsed and how many failed."""
    bad = F.count_if(F.col(CORRUPT).isNotNull())
    row = spark.read.parquet(out_path).agg(F.count(F.lit(1)).alias("n"), bad.alias("failed")).first()
    return {"stored": row["n"] - row["failed"], "failed": row["failed"]}


def new_game_documents(spark: SparkSession, raw_root: str, max_files: int = 1000):
    """Streaming DataFrame of play-by-play documents not yet processed."""
    glob = posixpath.join(raw_root.rstrip("/"), LAYOUT["play_by_play"])
    docs = (
        spark.readStream.schema(f"{PLAY_BY_PLAY}, {CORRUPT} STRING")
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", max_files)
        .json(glob)
    )
    return docs.withColumn(SOURCE_PATH, F.col("_metadata.file_path")).withColumn(
        "path_game_id", path_part(F.col(SOURCE_PATH), 2).cast("bigint")
    )


def ingest_new_games(
    spark: SparkSession,
    raw_root: str,
    out_path: str,
    checkpoint_path: str,
    max_files: int = 1000,
    wait: bool = True,
) -> StreamingQuery:
    """Append the new documents to ``out_path`` and stop when caught up."""
    q = (
        new_game_documents(spark, raw_root, max_files)
        .writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        q.awaitTermination()
    return q


def ingest_keyed(
    spark: SparkSession,
    glob: str,
    schema: str,
    store_path: str,
    checkpoint_path: str,
    keys: list[str],
    shape: Callable[[DataFrame], DataFrame] | None = None,
    stream: str = "ingest",
    multi_line: bool = True,
    max_files: int = 1000,
) -> list[dict[str, int]]:
    """Take the files at ``glob`` not read before into the store by key; counts of each batch.

    ``shape`` turns the documents (``schema``, ``source_path`` and
    ``_corrupt_record``) into the stored rows; a row that keeps its corrupt
    record counts as failed.
    """
    docs = (
        spark.readStream.schema(f"{schema}, {CORRUPT} STRING")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", max_files)
        .json(glob)
        .withColumn(SOURCE_PATH, F.col("_metadata.file_path"))
    )
    counts: list[dict[str, int]] = []

    def take(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        counts.append(append_unseen(rows, store_path, keys, stream=stream, batch_id=batch_id))

    query = docs.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    query.awaitTermination()
    return counts
