"""The build: raw documents -> staging tables and views -> marts -> checks.

The order is a plain list. Every table is written and read back before the
next model uses it, which cuts the lineage at each step: a lost executor
recomputes from the last stored table, never from the raw documents.

``stg_games`` and ``stg_plays`` each read the play-by-play documents with
only the fields they use: the game header read skips the plays, and the
two typed tables are the columnar copies later steps read. (Writing the
raw nested documents to Parquet first was measured to cost more than the
second, pruned JSON read.) Histories are partitioned by ``snapshot_date``
so the latest-snapshot filters prune partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.documents import read_kind
from ..sources.materialize import measured, read_if_built, read_table, register_view, table_path, write_table
from ..streaming.incremental import game_documents
from . import marts, staging
from .quality import invariants, measures, run_suite

BUILD_ORDER = [
    "stg_games",
    "stg_plays",
    "stg_players_history",
    "stg_standings_history",
    "stg_players",
    "stg_standings",
    "dim_teams",
    "dim_players",
    "fct_plays",
]

TABLE_COLUMNS = {
    "stg_games": staging.GAMES_COLUMNS,
    "stg_plays": staging.PLAYS_COLUMNS,
    "stg_players_history": staging.PLAYERS_HISTORY_COLUMNS,
    "stg_standings_history": staging.STANDINGS_HISTORY_COLUMNS,
    "dim_teams": marts.DIM_TEAMS_COLUMNS,
    "dim_players": marts.DIM_PLAYERS_COLUMNS,
    "fct_plays": marts.FCT_PLAYS_COLUMNS,
}


def _history(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    df = read_table(spark, warehouse, name)
    return df.withColumn("snapshot_date", F.col("snapshot_date").cast("date")).select(*TABLE_COLUMNS[name])


def load_models(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """Stored tables plus the two current views, by model name.

    Every model is also registered as a temp view under its name, so SQL
    written against the models runs as it is through ``spark.sql`` (for
    example ``select event_type, count(*) filter (where period = 1) ...
    from stg_plays``). Two dialect differences: ``::varchar`` is written
    ``::string``, and Spark sorts NULLs first when ascending unless the SQL
    says ``NULLS LAST`` (the report functions always do).
    """
    t = {
        "stg_games": read_table(spark, warehouse, "stg_games", TABLE_COLUMNS["stg_games"]),
        "stg_plays": read_table(spark, warehouse, "stg_plays", TABLE_COLUMNS["stg_plays"]),
        "stg_players_history": _history(spark, warehouse, "stg_players_history"),
        "stg_standings_history": _history(spark, warehouse, "stg_standings_history"),
    }
    t["stg_players"] = staging.stg_players(t["stg_players_history"])
    t["stg_standings"] = staging.stg_standings(t["stg_standings_history"])
    for name in ("dim_teams", "dim_players", "fct_plays"):
        stored = read_if_built(spark, table_path(warehouse, name))
        if stored is not None:
            t[name] = stored.select(*TABLE_COLUMNS[name])
    if "fct_plays" in t:
        # A partition value is read back in the narrowest type.
        t["fct_plays"] = t["fct_plays"].withColumn("season", F.col("season").cast("bigint"))
    for name, df in t.items():
        register_view(df, name)
    return t


def build(
    spark: SparkSession,
    raw_root: str,
    warehouse: str,
    as_of: dt.date | str | None = None,
    by_id_sets: bool = False,
    pbp_store: str | None = None,
) -> dict[str, DataFrame]:
    """Build every model from the raw store at ``raw_root`` into ``warehouse``.

    ``pbp_store`` is the Parquet copy of the play-by-play documents kept by
    :func:`snapmart.streaming.incremental.ingest_new_games`; with it, the
    JSON tree is not read again (only new files were taken in).
    """
    if pbp_store is None:
        pbp = read_kind(spark, raw_root, "play_by_play")
    else:
        pbp = game_documents(spark, pbp_store)

    def store(df: DataFrame, name: str, **layout) -> None:
        write_table(df, warehouse, name, measures=measures(name), **layout)

    store(staging.stg_games(pbp), "stg_games")
    store(staging.stg_plays(pbp), "stg_plays")
    store(
        staging.stg_players_history(read_kind(spark, raw_root, "rosters")),
        "stg_players_history", partition_by=["snapshot_date"],
    )
    store(
        staging.stg_standings_history(read_kind(spark, raw_root, "standings")),
        "stg_standings_history", partition_by=["snapshot_date"],
    )
    t = load_models(spark, warehouse)
    store(marts.dim_teams(t["stg_standings"]), "dim_teams")
    store(marts.dim_players(t["stg_players"], as_of), "dim_players")
    t = load_models(spark, warehouse)
    store(
        marts.fct_plays(t["stg_plays"], t["stg_games"], t["dim_players"], by_id_sets),
        "fct_plays", partition_by=["season"],
        sort_within=["season", "event_type", "game_id", "sort_order"],
    )
    return load_models(spark, warehouse)


def build_and_test(
    spark: SparkSession, raw_root: str, warehouse: str, as_of=None, pbp_store: str | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build, then run the declared data tests; returns (models, results).

    What the writes measured is not scanned for again.

    The fact invariants (unique play keys, fact rows = plays) are written
    beside the results as ``_invariants``.
    """
    models = build(spark, raw_root, warehouse, as_of, pbp_store=pbp_store)
    known = {k: n for name in TABLE_COLUMNS for k, n in measured(spark, warehouse, name).items()}
    results = run_suite(models, measured=known)
    write_table(results, warehouse, "_test_results")
    write_table(invariants(models), warehouse, "_invariants")
    return models, read_table(spark, warehouse, "_test_results")
