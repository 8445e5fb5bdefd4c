"""Landing, re-aimed as Spark jobs: decide what to take in, and take in only
what is new.

The reference's landing loop fetches documents one by one over HTTP and
skips keys already stored. Fetching stays outside (any downloader can drop
documents into an inbox folder); what is rebuilt here is its data logic:

* R1 team list from a standings document,
* R2 newest snapshot overall,
* R3 completed game ids over all schedules,
* R4 ids still to take in (wanted minus landed),
* R5 past regular-season and playoff games,
* R6 idempotent append: only keys not yet in the store are written,
* R7 replace by key: a key's rows are overwritten each run,
* R9 run counts (new, skipped, failed), exact even when executors are lost.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.scalar import number_field, path_part
from ..operators.joins import not_yet_present
from ..operators.latest import latest_overall
from ..operators.ordering import order_by
from ..schemas import DOC_SCHEMAS
from .documents import SOURCE_PATH, doc_glob, path_key, read_documents
from .materialize import read_if_built

# Schedule states of a completed game; game types kept by R5.
COMPLETED_STATES = ("OFF", "FINAL")
REGULAR_AND_PLAYOFF = (2, 3)


def teams_from_standings(standings_docs: DataFrame) -> DataFrame:
    """``team_abbrev`` of every team listed in the standings documents."""
    return standings_docs.select(
        F.explode("standings.teamAbbrev.default").alias("team_abbrev")
    )


def newest_snapshot(docs: DataFrame, date_from_end: int = 2) -> DataFrame:
    """R2: the documents of the greatest snapshot date (taken from the path).

    On a table partitioned by ``snapshot_date`` the equality becomes a
    partition filter. An empty input gives an empty result; use
    :func:`require_rows` where the reference raises.
    """
    dated = docs.withColumn("snapshot_date", path_key(date_from_end).cast("date"))
    return latest_overall(dated, "snapshot_date")


def newest_documents(spark: SparkSession, raw_root: str, kind: str, date_from_end: int = 2) -> DataFrame:
    """R2 on the raw store: the documents of the newest date, found from file names alone.

    The listing reads no content, so an old document that does not parse does
    not matter; then only the newest date's folder is read. One value (the
    date) comes to the driver. No document at all is an error.
    """
    glob = doc_glob(raw_root, kind)
    dates = landed_keys(spark, glob, date_from_end, "snapshot_date", "date")
    newest = dates.agg(F.max("snapshot_date")).first()[0]
    if newest is None:
        raise ValueError(f"no {kind} documents under {raw_root}")
    parts = glob.split("/")
    parts[-date_from_end] = newest.isoformat()
    return read_documents(spark, "/".join(parts), DOC_SCHEMAS[kind])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when ``df`` is empty (reads at most one row)."""
    if not df.take(1):
        raise ValueError(f"no {what} found")
    return df


def completed_ids(schedule_docs: DataFrame) -> DataFrame:
    """Ids of games in a completed state, each once, in no order.

    A schedule without ``games`` contributes nothing. The distinct is a
    partial aggregate, so a game listed by both teams is deduplicated
    map-side first.
    """
    games = schedule_docs.select(F.explode("games").alias("g"))
    done = games.where(F.col("g.gameState").isin(*COMPLETED_STATES))
    return done.select(number_field(games, "g.id", "bigint").alias("game_id")).distinct()


def completed_game_ids(schedule_docs: DataFrame) -> DataFrame:
    """:func:`completed_ids`, ascending."""
    return order_by(completed_ids(schedule_docs), "game_id")


def landed_keys(spark: SparkSession, glob: str, from_end: int, name: str, cast: str = "bigint") -> DataFrame:
    """Keys of documents already in a file store, from their paths only.

    ``binaryFile`` lists the files; only ``path`` is selected, so no file
    content is read.
    """
    files = spark.read.format("binaryFile").load(glob).select("path")
    return files.select(path_part(F.col("path"), from_end).cast(cast).alias(name))


def pending_ids(wanted: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Wanted ids not yet landed. A landed id is never fetched again."""
    return not_yet_present(wanted, landed, key)


def past_games(schedule: DataFrame, as_of: dt.date | str | Column | None = None) -> DataFrame:
    """Games before ``as_of`` (default today) of type 2 or 3, oldest first.

    ``schedule`` is a flat table ``(game_id, game_date, game_type)``.
    """
    bound = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date"))
    kept = schedule.where(
        (F.col("game_date").cast("date") < bound) & F.col("game_type").isin(*REGULAR_AND_PLAYOFF)
    )
    return order_by(kept.select("game_id", "game_date", "game_type"), "game_date", "game_id")


def schedule_table(schedule_docs: DataFrame) -> DataFrame:
    """Schedule documents as the flat ``(game_id, game_date, game_type)`` table."""
    g = schedule_docs.select(F.explode("games").alias("g"))
    return g.select(
        number_field(g, "g.id", "bigint").alias("game_id"),
        F.col("g.gameDate").cast("date").alias("game_date"),
        number_field(g, "g.gameType", "bigint").alias("game_type"),
    )


def read_inbox(spark: SparkSession, inbox_root: str, kind: str) -> DataFrame:
    """Fetched documents waiting in an inbox folder (same layout as the store).

    Read permissively: a document that does not parse gets its text in
    ``_corrupt_record`` so the run can count it as failed instead of
    stopping.
    """
    schema = DOC_SCHEMAS[kind] + ", _corrupt_record STRING"
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(doc_glob(inbox_root, kind))
        .withColumn(SOURCE_PATH, F.col("_metadata.file_path"))
    )


RUN_ID = "_run_id"


def one_per_key(df: DataFrame, keys: list[str], prefer: str = SOURCE_PATH) -> DataFrame:
    """One row per key: the one with the greatest ``prefer`` (the last path).

    A partial aggregate: every task sends one row per key that it holds, so
    a key that fills an inbox gathers nowhere.
    """
    # Equal paths: the order of a hash over what can be hashed.
    plain = [c for c, t in df.dtypes if c not in keys and "variant" not in t and "map<" not in t]
    tie = F.xxhash64(*(plain or keys))
    order = F.struct(F.col(prefer), tie) if prefer in df.columns else F.struct(tie)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), order).alias("__row"))
    return best.select("__row.*")


def append_new(
    incoming: DataFrame,
    store_path: str,
    keys: list[str],
    partition_by: list[str] | None = None,
    run_id: str | None = None,
) -> dict[str, int]:
    """R6 + R9: append the incoming rows whose keys are not in the store.

    Running it twice with the same input writes nothing the second time.
    A key that the batch holds several times is written once, from the
    greatest path (:func:`one_per_key`). Counts: ``failed`` rows did not
    parse or have a NULL key, ``new`` were written, ``skipped`` were already
    present or repeat a key of the batch.

    The counts stay exact when executors are lost: ``incoming`` and
    ``failed`` come from a one-row aggregate job over the parsed inbox
    (whole results, not accumulator updates a re-run stage could apply
    twice), and ``new`` is counted in the store after the commit, by the
    run id every written row carries; Parquet statistics prune that filter
    to this run's files. ``run_id`` must be new for each run (the default is
    a fresh uuid). A failed write commits nothing, so the run can simply be
    repeated. A store that is absent is made; one that cannot be read fails.
    """
    spark = incoming.sparkSession
    run_id = run_id or uuid.uuid4().hex
    has_corrupt = "_corrupt_record" in incoming.columns
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    failed_col = (F.col("_corrupt_record").isNotNull() if has_corrupt else F.lit(False)) | no_key
    # The inbox (one run's delta) is parsed once for the counts and the
    # write; Spark also requires this before querying the corrupt-record
    # column of raw JSON. A lost cached block is recomputed from the files.
    parsed = incoming.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        totals = parsed.agg(
            F.count(F.lit(1)).alias("incoming"), F.count_if(failed_col).alias("failed")
        ).first()
        clean = parsed.where(~failed_col)
        if has_corrupt:
            clean = clean.drop("_corrupt_record")
        clean = one_per_key(clean, keys)
        present = read_if_built(spark, store_path)
        if present is not None:
            clean = clean.join(present.select(*keys), on=keys, how="left_anti")
        w = clean.withColumn(RUN_ID, F.lit(run_id)).write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(store_path)
    finally:
        parsed.unpersist()
    n_new = spark.read.parquet(store_path).where(F.col(RUN_ID) == run_id).count()
    n_in, n_failed = int(totals["incoming"]), int(totals["failed"])
    return {"new": n_new, "skipped": n_in - n_failed - n_new, "failed": n_failed}


def replace_by_key(df: DataFrame, store_path: str, key: str) -> None:
    """Overwrite only the partitions of the keys present in ``df``.

    Each run replaces those keys' rows (a team's schedule) and leaves the
    other keys untouched. The rebalance keeps a key's rows in few files and
    splits a key that holds much of the data.
    """
    (
        df.hint("rebalance", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(store_path)
    )


def land_games(spark: SparkSession, inbox_root: str, store_path: str) -> dict[str, int]:
    """One landing run over an inbox: teams, completed games, what is missing, append, counts.

    R2 + R1: the teams of the newest standings document (an error without
    one). R3: completed game ids of all schedules. R4: those not in the store.
    R6 + R9: their documents are appended and counted. A document that does
    not parse is counted as failed and stays pending for a later run.
    Returns ``teams, wanted, new, skipped, failed, pending``.
    """
    teams = teams_from_standings(newest_documents(spark, inbox_root, "standings")).distinct().count()
    schedules = read_inbox(spark, inbox_root, "schedules").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        wanted = completed_ids(schedules).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            present = read_if_built(spark, store_path)
            pending = wanted if present is None else pending_ids(wanted, present, "game_id")
            docs = read_inbox(spark, inbox_root, "play_by_play").withColumn("game_id", path_key(2).cast("bigint"))
            counts = append_new(docs.join(pending, "game_id", "left_semi"), store_path, ["game_id"])
            left = pending_ids(wanted, spark.read.parquet(store_path), "game_id").count()
            return {"teams": teams, "wanted": wanted.count(), **counts, "pending": left}
        finally:
            wanted.unpersist()
    finally:
        schedules.unpersist()
