"""The declared data tests of the models, as data, and a runner.

37 tests: 25 ``not_null``, 5 ``unique``, 6 ``accepted_values`` and 1
``relationships``. :func:`run_suite` returns one DataFrame with a failure
count per test; all tests of one model but relationships share one scan. What
was measured while a model was written (:func:`measures`) needs no scan again.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.checks import (
    accepted_values_failures,
    relationships_failures,
    unique_combination_failures,
    unique_failures,
)

# Accepted lists of the declared tests.
GAME_STATES = ["OFF", "FINAL", "LIVE", "PRE", "CRIT"]
EVENT_TYPES = [
    "goal", "shot-on-goal", "missed-shot", "blocked-shot", "failed-shot-attempt",
    "hit", "faceoff", "giveaway", "takeaway", "penalty", "stoppage",
    "period-start", "period-end", "game-end", "delayed-penalty", "shootout-complete",
]
POSITION_CODES = ["C", "L", "R", "D", "G"]
CONFERENCES = ["Eastern", "Western"]
DIVISIONS = ["Atlantic", "Metropolitan", "Central", "Pacific"]
POSITION_GROUPS = ["Forward", "Defenseman", "Goalie"]


@dataclass(frozen=True)
class DataTest:
    model: str
    column: str
    kind: str  # unique | not_null | accepted_values | relationships
    values: tuple = ()
    to: str | None = None
    field_name: str | None = None
    extra: dict = field(default_factory=dict)

    @property
    def test_id(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"


def _nn(model, *cols):
    return [DataTest(model, c, "not_null") for c in cols]


# The declared tests, model by model.
SUITE: list[DataTest] = [
    DataTest("stg_games", "game_id", "unique"),
    *_nn("stg_games", "game_id", "game_date", "game_state"),
    DataTest("stg_games", "game_state", "accepted_values", tuple(GAME_STATES)),
    *_nn("stg_plays", "event_id", "game_id", "event_type"),
    DataTest("stg_plays", "event_type", "accepted_values", tuple(EVENT_TYPES)),
    DataTest("stg_players", "player_id", "unique"),
    *_nn("stg_players", "player_id", "team_abbrev", "full_name", "position_code"),
    DataTest("stg_players", "position_code", "accepted_values", tuple(POSITION_CODES)),
    DataTest("stg_standings", "team_abbrev", "unique"),
    *_nn("stg_standings", "team_abbrev", "points", "games_played"),
    DataTest("dim_teams", "team_abbrev", "unique"),
    *_nn("dim_teams", "team_abbrev", "team_name", "conference_name", "division_name"),
    DataTest("dim_teams", "conference_name", "accepted_values", tuple(CONFERENCES)),
    DataTest("dim_teams", "division_name", "accepted_values", tuple(DIVISIONS)),
    DataTest("dim_players", "player_id", "unique"),
    *_nn("dim_players", "player_id", "full_name", "position_group", "team_abbrev"),
    DataTest("dim_players", "position_group", "accepted_values", tuple(POSITION_GROUPS)),
    DataTest("dim_players", "team_abbrev", "relationships", to="dim_teams", field_name="team_abbrev"),
    *_nn("fct_plays", "game_id", "event_id", "event_type", "game_date"),
]


def failures(test: DataTest, tables: dict[str, DataFrame]) -> DataFrame:
    """The failing rows of one test."""
    df = tables[test.model]
    if test.kind == "unique":
        return unique_failures(df, test.column)
    if test.kind == "not_null":
        return df.where(F.col(test.column).isNull()).select(test.column)
    if test.kind == "accepted_values":
        return accepted_values_failures(df, test.column, test.values)
    if test.kind == "relationships":
        return relationships_failures(df, test.column, tables[test.to], test.field_name)
    raise ValueError(test.kind)


def _count_row(test: DataTest, n) -> list:
    return [
        F.lit(test.test_id).alias("test_id"),
        F.lit(test.model).alias("model"),
        F.lit(test.column).alias("column_name"),
        F.lit(test.kind).alias("test"),
        n.cast("bigint").alias("failures"),
    ]


def _model_pass(df: DataFrame, model: str, tests: list[DataTest]) -> DataFrame:
    """All unique, accepted_values and not_null tests of one model from one
    scan: a ``groupingSets`` aggregate with one set per tested column (the
    values and their counts) and the empty set (the table's NULL counts),
    partially aggregated map-side. A second aggregate over its groups (a
    few per distinct tested value) reads off each test's failures."""
    set_cols = list(dict.fromkeys(t.column for t in tests if t.kind != "not_null"))
    nn_cols = list(dict.fromkeys(t.column for t in tests if t.kind == "not_null"))
    sets = [[F.col(c)] for c in set_cols] + [[]]
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"__null{i}") for i, c in enumerate(nn_cols)]
    aggs += [F.grouping(c).alias(f"__g{j}") for j, c in enumerate(set_cols)]
    if set_cols:
        groups = df.groupingSets(sets, *set_cols).agg(*aggs)
        in_set = {c: F.col(f"__g{j}") == 0 for j, c in enumerate(set_cols)}
        total_row = F.lit(True)
        for j in range(len(set_cols)):
            total_row = total_row & (F.col(f"__g{j}") == 1)
    else:
        groups = df.agg(*aggs)
        in_set, total_row = {}, F.lit(True)
    counts = []
    for t in tests:
        c = F.col(t.column)
        if t.kind == "unique":
            n = F.count_if(in_set[t.column] & c.isNotNull() & (F.col("__n") > 1))
        elif t.kind == "accepted_values":
            n = F.count_if(in_set[t.column] & c.isNotNull() & ~c.isin(list(t.values)))
        else:
            i = nn_cols.index(t.column)
            n = F.sum(F.when(total_row, F.col(f"__null{i}")).otherwise(F.lit(0)))
        counts.append(F.coalesce(n.cast("bigint"), F.lit(0).cast("bigint")).alias(t.test_id))
    wide = groups.agg(*counts)
    info = F.create_map(*[
        x for t in tests for x in (F.lit(t.test_id), F.array(F.lit(t.column), F.lit(t.kind)))
    ])
    long = wide.unpivot([], [t.test_id for t in tests], "test_id", "failures")
    return long.select(
        "test_id",
        F.lit(model).alias("model"),
        info[F.col("test_id")][0].alias("column_name"),
        info[F.col("test_id")][1].alias("test"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def measures(model: str, suite: list[DataTest] = SUITE) -> dict[str, Column]:
    """Aggregates for the write of ``model``, by test id: failing rows of its
    not_null and accepted_values tests. (``unique`` needs its groups.)"""
    out = {}
    for t in suite:
        if t.model == model and t.kind == "not_null":
            out[t.test_id] = F.count_if(F.col(t.column).isNull())
        elif t.model == model and t.kind == "accepted_values":
            out[t.test_id] = F.count_if(~F.col(t.column).isin(list(t.values)))
    return out


def _known(test: DataTest, measured: dict[str, int]) -> int | None:
    """Failures of a test as far as its measure tells: an accepted_values test
    counts values, of which the measure only knows that there are none."""
    n = measured.get(test.test_id)
    return n if test.kind == "not_null" or n == 0 else None


def run_suite(
    tables: dict[str, DataFrame], suite: list[DataTest] = SUITE, measured: dict[str, int] | None = None
) -> DataFrame:
    """One row per test: ``test_id, model, column_name, test, failures``.

    Grouped tests count their failing values (unique, accepted_values) and
    not_null counts failing rows, as the published tests do. Each model is
    scanned once for all of those (:func:`_model_pass`), which matters most
    for the current views, recomputed at every scan; a relationships test
    is one anti join. Tests that ``measured`` answers (failing rows by test id,
    from the writes of exactly these tables) are not run again, and a model
    with no other test is not scanned.
    """
    parts: list[DataFrame] = []
    known: list[tuple] = []
    by_model: dict[str, list[DataTest]] = {}
    for t in suite:
        n = _known(t, measured or {})
        if n is not None:
            known.append((t.test_id, t.model, t.column, t.kind, n))
        elif t.kind == "relationships":
            parts.append(failures(t, tables).agg(*_count_row(t, F.count(F.lit(1)))))
        else:
            by_model.setdefault(t.model, []).append(t)
    for model, tests in by_model.items():
        parts.append(_model_pass(tables[model], model, tests))
    if known:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(known, "test_id string, model string, column_name string, test string, failures bigint"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def invariants(tables: dict[str, DataFrame]) -> DataFrame:
    """Checks the declared tests leave out: one row per check with
    ``check_name, failures`` (0 = holds).

    * ``(game_id, event_id)`` is unique in ``stg_plays`` and in ``fct_plays``;
    * the histories hold one row per ``(player_id, team_abbrev,
      snapshot_date)`` and per ``(team_abbrev, snapshot_date)``;
    * ``fct_plays`` has exactly as many rows as ``stg_plays`` (a player
      listed twice on the latest date multiplies plays; the difference is
      reported as failures).
    """
    key = ["game_id", "event_id"]
    parts = [
        unique_combination_failures(tables["stg_plays"], key)
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit("unique_stg_plays_game_event").alias("check_name"), "failures"),
        unique_combination_failures(tables["fct_plays"], key)
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit("unique_fct_plays_game_event").alias("check_name"), "failures"),
    ]
    for model, cols, name in (
        ("stg_players_history", ["player_id", "team_abbrev", "snapshot_date"], "unique_players_history_key"),
        ("stg_standings_history", ["team_abbrev", "snapshot_date"], "unique_standings_history_key"),
    ):
        parts.append(
            unique_combination_failures(tables[model], cols)
            .agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit(name).alias("check_name"), "failures")
        )
    # +1 per play, -1 per fact row: one partial-aggregated pass over both.
    signed = tables["stg_plays"].select(F.lit(1).alias("side")).unionByName(
        tables["fct_plays"].select(F.lit(-1).alias("side"))
    )
    parts.append(
        signed.agg(F.abs(F.sum("side")).cast("bigint").alias("failures")).select(
            F.lit("fct_rows_equal_plays").alias("check_name"), "failures"
        )
    )
    return reduce(lambda a, b: a.unionByName(b), parts)
