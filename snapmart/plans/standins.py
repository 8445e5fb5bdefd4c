"""Stand-in queries: the models, reports and landing selections run
unchanged on frames and documents built row by row from the driver's tables.

One document or row per order or line item, never a grouping, so no
document gathers a hot key; ids that the models type as INTEGER stay in
INTEGER range at any scale. Each query has a DuckDB oracle written against
the tables directly.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators.joins import role_join
from ..schemas import DOC_SCHEMAS
from ..sources import keyed_store, landing
from ..sources.by_name import read_json_by_name, read_parquet_by_name
from ..sources.documents import path_key, read_documents
from ..sources.materialize import measured, read_table, register_view, write_table
from ..sources.scratch import scratch_path
from ..streaming import incremental
from ..tables import load
from . import marts, reports, staging
from .quality import measures, run_suite

AS_OF = _dt.date(2026, 6, 30)


# The reports (B1-B11) run unchanged on stand-ins with the models' column
# names: orders as games, events as plays and as roster history.

def _games_from_orders(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("game_id"),
        X.as_date("o_orderdate").alias("game_date"),
        F.col("o_orderpriority").alias("away_team_abbrev"),
        X.int_half_even(F.col("o_totalprice") / F.lit(100000)).alias("away_score"),
        F.dayofweek("o_orderdate").alias("home_score"),
        F.col("o_orderstatus").alias("home_team_abbrev"),
        F.when(status == "F", "REG").when(status == "O", "OT").when(status == "P", "SO")
        .alias("last_period_type"),
        F.col("o_orderstatus").alias("game_state"),
    )


def _plays_from_events(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("user_id") % 3
    return load(spark, sf, "events").select(
        "event_type",
        F.when(u == 1, 1).when(u == 2, 2).otherwise(3).alias("period"),
    )


def q_report_newest_games(spark: SparkSession, sf: str) -> DataFrame:
    return reports.newest_games(_games_from_orders(spark, sf))


def q_report_game_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.game_summary(_games_from_orders(spark, sf))


def q_report_event_types(spark: SparkSession, sf: str) -> DataFrame:
    return reports.event_type_breakdown(_plays_from_events(spark, sf))


def q_report_snapshot_summary(spark: SparkSession, sf: str) -> DataFrame:
    history = load(spark, sf, "events").select(
        X.as_date("ts").alias("snapshot_date"), F.col("event_type").alias("team_abbrev")
    )
    return reports.snapshot_summary(history)


def q_report_fact_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return reports.fact_breakdown(_plays_from_events(spark, sf))


def q_report_unknown_types(spark: SparkSession, sf: str) -> DataFrame:
    return reports.unknown_event_types(_plays_from_events(spark, sf))


# The mart models run unchanged on stand-ins with the staged columns.
# Market segment -> position code of the stand-in players.
SEGMENT_POSITION = [
    ("AUTOMOBILE", "C"), ("BUILDING", "L"), ("FURNITURE", "R"),
    ("HOUSEHOLD", "G"), ("MACHINERY", "D"),
]


def _player_history(spark: SparkSession, sf: str) -> DataFrame:
    """stg_players_history-shaped: one row per order, the customer as the
    player, the order priority as the team, the order date as snapshot.
    A customer with two orders of different priority on its latest date is
    a tie, kept by the current view as in the reference."""
    seg = F.col("c_mktsegment")
    pos = None
    for segment, code in SEGMENT_POSITION:
        pos = (F.when(seg == segment, code) if pos is None else pos.when(seg == segment, code))
    pos = F.when(F.col("c_acctbal") >= 0, pos)          # negative balance: no position
    group = (
        F.when(pos == "G", "goalie").when(pos == "D", "defenseman").otherwise("forward")
    )
    o = load(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderdate")
    c = load(spark, sf, "customer")
    h = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    return h.select(
        F.col("c_custkey").alias("player_id"),
        F.col("o_orderpriority").alias("team_abbrev"),
        X.as_date("o_orderdate").alias("snapshot_date"),
        group.alias("player_group"),
        F.col("c_name").alias("first_name"),
        seg.alias("last_name"),
        X.concat_strict("c_name", F.lit(" "), seg).alias("full_name"),
        F.col("c_nationkey").alias("sweater_number"),
        pos.alias("position_code"),
        F.lit("L").alias("shoots_catches"),
        (F.lit(60) + F.col("c_nationkey")).alias("height_inches"),
        (F.lit(150) + F.col("c_nationkey")).alias("weight_pounds"),
        F.date_add(F.lit("1985-12-31").cast("date"), F.col("c_nationkey")).alias("birth_date"),
        seg.alias("birth_city"),
        X.text(F.col("c_nationkey")).alias("birth_country"),
        F.concat(F.lit("https://img/"), X.text(F.col("c_custkey"))).alias("headshot_url"),
    )


def q_model_dim_players(spark: SparkSession, sf: str) -> DataFrame:
    """M2 + M7: the current view (latest per player, ties kept) and the
    player dimension with age, position group and height display."""
    return marts.dim_players(staging.stg_players(_player_history(spark, sf)), AS_OF)


def _plays_from_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """stg_plays-shaped: one play per line item; ``details`` is a VARIANT
    object built from the row (keys of roles the event does not have hold
    JSON null, which reads as NULL like an absent key)."""
    li = load(spark, sf, "lineitem")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    goal, hit = rf == "R", rf == "A"
    faceoff = (rf == "N") & (ls == "O")
    penalty = (rf == "N") & (ls != "O")
    event = F.when(goal, "goal").when(hit, "hit").when(faceoff, "faceoff").otherwise("penalty")
    # Role ids stay in INTEGER range at any scale: supplier keys, supplier
    # key + 1 (the last one finds nobody) and negated keys (never found).
    sk, ln = F.col("l_suppkey"), F.col("l_linenumber")
    nxt, gone = sk + F.lit(1), -sk
    details = F.to_variant_object(F.struct(
        F.when(ls == "O", 1).otherwise(2).alias("eventOwnerTeamId"),
        X.int_half_even("l_quantity").alias("xCoord"),
        ln.alias("yCoord"),
        F.when(ls == "O", "O").otherwise("D").alias("zoneCode"),
        F.when(goal, "wrist").alias("shotType"),
        F.when(goal, sk).alias("scoringPlayerId"),
        F.when(goal, nxt).alias("assist1PlayerId"),
        F.when(goal, ln).alias("assist2PlayerId"),
        F.when(goal, F.lit(0)).alias("awayScore"),
        F.when(goal, ln).alias("homeScore"),
        F.when(goal, ln).alias("goalieInNetId"),
        F.when(goal, F.concat(F.lit("https://clip/"), X.text(F.col("l_orderkey")))).alias("highlightClipSharingUrl"),
        F.when(goal, sk).alias("shootingPlayerId"),
        F.when(penalty, ln).alias("blockingPlayerId"),
        F.when(faceoff, sk).alias("winningPlayerId"),
        F.when(faceoff, gone).alias("losingPlayerId"),
        F.when(hit, sk).alias("hittingPlayerId"),
        F.when(hit, ln).alias("hitteePlayerId"),
        F.when(penalty, sk).alias("committedByPlayerId"),
        F.when(penalty, nxt).alias("drawnByPlayerId"),
        F.when(penalty, "tripping").alias("descKey"),
        F.when(penalty, F.lit(2)).alias("duration"),
        F.when(hit, -ln).alias("playerId"),
    ))
    d = F.col("l_discount")
    return li.select(
        F.col("l_orderkey").alias("game_id"),
        ln.alias("event_id"),
        F.when(d < 0.03, 1).when(d < 0.07, 2).otherwise(3).alias("period"),
        F.lit("REG").alias("period_type"),
        F.lit("10:00").alias("time_in_period"),
        F.lit("10:00").alias("time_remaining"),
        event.alias("event_type"),
        (ln * F.lit(10)).alias("sort_order"),
        F.lit("1551").alias("situation_code"),
        details.alias("details"),
    )


def q_model_fct_plays(spark: SparkSession, sf: str) -> DataFrame:
    """M8: the 54-column fact. Line items as plays, orders as games, and
    suppliers as the player dimension in all 12 roles (ids that find no
    supplier keep the id with a NULL name)."""
    return _fct_plays(spark, sf)


def _fct_plays(spark: SparkSession, sf: str, by_id_sets: bool = False, plays: DataFrame | None = None) -> DataFrame:
    games = _games_from_orders(spark, sf).select(
        "game_id", "game_date",
        F.year("game_date").cast("bigint").alias("season"),
        "home_team_abbrev", "away_team_abbrev", "home_score", "away_score", "last_period_type",
    )
    players = load(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("player_id"), F.col("s_name").alias("full_name")
    )
    if plays is None:
        return marts.fct_plays(_plays_from_lineitem(spark, sf), games, players, by_id_sets, stored=False)
    return marts.fct_plays(plays, games, players, by_id_sets)


def _game_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Play-by-play-shaped documents, one per order, without plays: the
    columns the game header read gives (no grouping, one row each)."""
    o = load(spark, sf, "orders")
    st, day = F.col("o_orderstatus"), F.col("o_orderdate")

    def team(tid, abbrev, name, score, sog):
        return F.struct(
            tid.cast("int").alias("id"), abbrev.alias("abbrev"),
            F.struct(name.alias("default")).alias("commonName"),
            score.cast("int").alias("score"), sog.cast("int").alias("sog"),
        )

    return o.select(
        F.col("o_orderkey").alias("id"),
        F.year(day).cast("bigint").alias("season"),
        F.when(st == "F", 2).when(st == "O", 3).otherwise(1).cast("bigint").alias("gameType"),
        F.date_format(day, "yyyy-MM-dd").alias("gameDate"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("startTimeUTC"),
        F.when(st == "F", "OFF").when(st == "O", "LIVE").otherwise("PRE").alias("gameState"),
        F.lit("OK").alias("gameScheduleState"),
        F.struct(F.col("o_orderpriority").alias("default")).alias("venue"),
        F.lit(None).cast("struct<default:string>").alias("venueLocation"),
        team(F.dayofweek(day), st, F.col("o_orderpriority"),
             X.int_half_even(F.col("o_totalprice") / F.lit(100000)), F.dayofmonth(day)).alias("awayTeam"),
        team(F.month(day), F.col("o_orderpriority"), st, F.dayofweek(day), F.lit(30)).alias("homeTeam"),
        F.struct(
            F.when(st == "F", "REG").when(st == "O", "OT").when(st == "P", "SO").alias("lastPeriodType")
        ).alias("gameOutcome"),
        F.lit(3).cast("bigint").alias("regPeriods"),
        (st != "P").alias("otInUse"),
        F.lit(None).cast("boolean").alias("shootoutInUse"),
    )


def q_model_games(spark: SparkSession, sf: str) -> DataFrame:
    """M4: the game header typing and the derived win / margin columns, on
    order rows shaped as game documents (the start time compared as text)."""
    g = staging.stg_games(_game_documents(spark, sf))
    return g.withColumn("start_time_utc", F.date_format("start_time_utc", "yyyy-MM-dd HH:mm:ss"))


def _roster_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Roster-shaped documents, one per line item: the supplier as the only
    player, the return flag as the team and the ship date as the snapshot,
    both only in the path. A goalie list is absent (not empty) unless the
    player is a goalie."""
    li = load(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_shipdate", "l_linenumber")
    su = load(spark, sf, "supplier")
    d = li.join(su, li["l_suppkey"] == su["s_suppkey"], "inner")
    nk = F.col("s_nationkey")
    pos = (F.when(nk < 5, "G").when(nk < 10, "D").when(nk < 15, "C").when(nk < 20, "L")
           .otherwise("R"))
    player = F.struct(
        F.col("s_suppkey").cast("int").alias("id"),
        F.struct(F.col("s_name").alias("default")).alias("firstName"),
        F.struct(F.concat(F.lit("N"), X.text(nk)).alias("default")).alias("lastName"),
        nk.alias("sweaterNumber"),
        pos.alias("positionCode"),
        F.when(F.col("s_acctbal") >= 0, "L").otherwise("R").alias("shootsCatches"),
        (F.lit(60) + nk).alias("heightInInches"),
        (F.lit(150) + F.col("l_linenumber")).alias("weightInPounds"),
        F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), nk), "yyyy-MM-dd").alias("birthDate"),
        F.struct(F.concat(F.lit("C"), X.text(nk)).alias("default")).alias("birthCity"),
        F.lit("CAN").alias("birthCountry"),
        F.concat(F.lit("https://img/"), X.text(F.col("s_suppkey"))).alias("headshot"),
    )
    one = F.array(player)
    none = F.array()                                   # [], widened to the list type
    return d.select(
        F.when(pos.isin("C", "L", "R"), one).otherwise(none).alias("forwards"),
        F.when(pos == "D", one).otherwise(none).alias("defensemen"),
        F.when(pos == "G", one).alias("goalies"),
        F.concat(
            F.lit("rosters/"), F.col("l_returnflag"), F.lit("/"),
            F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("/roster.json"),
        ).alias("source_path"),
    )


def q_model_player_history(spark: SparkSession, sf: str) -> DataFrame:
    """M3 with S2/S3: team and snapshot date cut from the end of each
    document's path, the three position lists tagged and unnested in one
    scan (an absent or empty list gives no row), the player typed."""
    return staging.stg_players_history(_roster_documents(spark, sf))


def _standings_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Standings-shaped documents, one per order with one team entry: the
    order priority as the team, the order date only in the path. The
    counting fields take day-of-month based values."""
    o = load(spark, sf, "orders")
    day = F.dayofmonth("o_orderdate")
    fields = []
    int_fields = [
        src for _, src, cast in staging.STANDINGS_COLUMNS if cast == "int" and src != "seasonId"
    ]
    for i, src in enumerate(int_fields):
        fields.append((day + F.lit(i)).alias(src))
    entry = F.struct(
        F.struct(F.col("o_orderpriority").alias("default")).alias("teamAbbrev"),
        F.year("o_orderdate").cast("bigint").alias("seasonId"),
        F.struct(F.concat(F.lit("Team "), F.col("o_orderpriority")).alias("default")).alias("teamName"),
        F.struct(F.col("o_orderstatus").alias("default")).alias("teamCommonName"),
        F.when(F.col("o_orderstatus") == "F", "Eastern").otherwise("Western").alias("conferenceName"),
        F.col("o_orderstatus").alias("conferenceAbbrev"),
        F.lit("Atlantic").alias("divisionName"),
        F.lit("A").alias("divisionAbbrev"),
        (F.col("o_totalprice") / F.lit(1000000)).alias("pointPctg"),
        F.col("o_orderstatus").alias("streakCode"),
        F.concat(F.lit("https://logo/"), F.col("o_orderpriority")).alias("teamLogo"),
        *fields,
    )
    return o.select(
        F.array(entry).alias("standings"),
        F.concat(F.lit("standings/"), F.date_format("o_orderdate", "yyyy-MM-dd"),
                 F.lit("/standings.json")).alias("source_path"),
    )


def q_model_standings_history(spark: SparkSession, sf: str) -> DataFrame:
    """M1: the snapshot date from the path, one row per listed team, 39
    typed columns."""
    return staging.stg_standings_history(_standings_documents(spark, sf))


def _schedule_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Schedule-shaped documents, one per order with one listed game."""
    o = load(spark, sf, "orders")
    st = F.col("o_orderstatus")
    game = F.struct(
        F.col("o_orderkey").alias("id"),
        F.when(st == "F", "FINAL").when(st == "P", "OFF").otherwise("LIVE").alias("gameState"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("gameDate"),
        F.when(st == "F", 2).when(st == "O", 3).otherwise(1).cast("bigint").alias("gameType"),
    )
    return o.select(F.array(game).alias("games"))


def q_landing_completed_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Completed games over all schedules, each id once, ascending."""
    return landing.completed_game_ids(_schedule_documents(spark, sf))


def q_landing_past_games(spark: SparkSession, sf: str) -> DataFrame:
    """Games before a date, regular season or playoff, oldest first."""
    return landing.past_games(landing.schedule_table(_schedule_documents(spark, sf)), "1996-01-01")


def q_landing_newest_teams(spark: SparkSession, sf: str) -> DataFrame:
    """R2 + R1: the teams listed in the newest standings snapshot."""
    return landing.teams_from_standings(landing.newest_snapshot(_standings_documents(spark, sf)))


def _play_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Play-by-play-shaped documents, one per line item, with the supplier
    key as the game id in the path (INTEGER range at any scale) and one
    play; items returned and still open carry an empty play list."""
    li = load(spark, sf, "lineitem")
    rf, ls, ln = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    play = F.struct(
        ln.alias("eventId"),
        F.struct(
            F.when(F.col("l_discount") < 0.05, 1).otherwise(2).alias("number"),
            F.lit("REG").alias("periodType"),
        ).alias("periodDescriptor"),
        F.lit("05:00").alias("timeInPeriod"),
        F.lit("15:00").alias("timeRemaining"),
        F.when(ls == "O", "1551").otherwise("1451").alias("situationCode"),
        F.when(rf == "R", "goal").when(rf == "A", "hit").otherwise("faceoff").alias("typeDescKey"),
        (ln * F.lit(10)).alias("sortOrder"),
        F.to_variant_object(F.struct(
            X.int_half_even("l_quantity").alias("xCoord"),
            F.when(rf == "R", F.col("l_suppkey")).alias("scoringPlayerId"),
        )).alias("details"),
    )
    empty = (rf == "A") & (ls == "O")
    return li.select(
        F.when(empty, F.array()).otherwise(F.array(play)).alias("plays"),
        F.concat(F.lit("play-by-play/"), X.text(F.col("l_suppkey")),
                 F.lit("/play-by-play.json")).alias("source_path"),
    )


def q_model_plays(spark: SparkSession, sf: str) -> DataFrame:
    """M5: game id cut from the path, one row per play (an empty play list
    gives none), the play typed; ``details`` stays VARIANT and is shown here
    through two of its keys."""
    p = staging.stg_plays(_play_documents(spark, sf))
    return p.select(
        *[c for c in p.columns if c != "details"],
        F.variant_get("details", "$.xCoord", "int").alias("x_coord"),
        F.variant_get("details", "$.scoringPlayerId", "int").alias("scoring_player_id"),
    )


def _through_json(docs: DataFrame, kind: str) -> DataFrame:
    """The documents written as JSON text and parsed again under the declared schema."""
    names = [c for c in docs.columns if c != "source_path"]
    keep = [c for c in ("source_path",) if c in docs.columns]
    text = docs.select(*keep, F.to_json(F.struct(*names)).alias("doc"))
    parsed = F.from_json("doc", DOC_SCHEMAS[kind], {"mode": "FAILFAST"})
    return text.select(*keep, parsed.alias("doc")).select(*keep, "doc.*")


def q_json_games(spark: SparkSession, sf: str) -> DataFrame:
    """M4 from JSON text."""
    g = staging.stg_games(_through_json(_game_documents(spark, sf), "play_by_play"))
    return g.withColumn("start_time_utc", F.date_format("start_time_utc", "yyyy-MM-dd HH:mm:ss"))


def q_json_plays(spark: SparkSession, sf: str) -> DataFrame:
    """M5 from JSON text."""
    p = staging.stg_plays(_through_json(_play_documents(spark, sf), "play_by_play"))
    return p.select(
        *[c for c in p.columns if c != "details"],
        F.variant_get("details", "$.xCoord", "int").alias("x_coord"),
        F.variant_get("details", "$.scoringPlayerId", "int").alias("scoring_player_id"),
    )


def q_json_rosters(spark: SparkSession, sf: str) -> DataFrame:
    """M3 from JSON text."""
    return staging.stg_players_history(_through_json(_roster_documents(spark, sf), "rosters"))


def q_json_standings(spark: SparkSession, sf: str) -> DataFrame:
    """M1 from JSON text."""
    return staging.stg_standings_history(_through_json(_standings_documents(spark, sf), "standings"))


def q_age_today(spark: SparkSession, sf: str) -> DataFrame:
    """New Years crossed up to today."""
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", X.year_crossings(X.as_date("o_orderdate"), F.current_date()).alias("age"))


def q_model_fct_plays_past_bound(spark: SparkSession, sf: str) -> DataFrame:
    """M8 by id sets, the plan for a player dimension too large to broadcast; same oracle."""
    return _fct_plays(spark, sf, by_id_sets=True)


def q_model_fct_plays_stored(spark: SparkSession, sf: str) -> DataFrame:
    """M5 -> S6 -> M8: the plays stored as a table, ``details`` shredded into typed
    sub-columns, and the fact read from them; same oracle."""
    root = _scratch(spark, "plays")
    write_table(_plays_from_lineitem(spark, sf), root, "stg_plays")
    return _fct_plays(spark, sf, plays=read_table(spark, root, "stg_plays"))


def _scratch(spark: SparkSession, label: str) -> str:
    """A new folder that all executors see."""
    return scratch_path(spark, f"_standins-{label}")


def _orders_as_inbox(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("orders/"), F.lpad(X.text(F.col("o_orderkey")), 12, "0"))
    return load(spark, sf, "orders").select(F.col("o_custkey").alias("key"), path.alias("source_path"), "o_orderstatus")


def q_landing_append(spark: SparkSession, sf: str) -> DataFrame:
    """R6 + R9: finished orders land first, then all of them; a customer is
    a key and lands once, from the greatest path of the first batch that
    holds it. The counts of both runs stand beside the rows."""
    inbox, store = _orders_as_inbox(spark, sf), _scratch(spark, "append")
    first = landing.append_new(inbox.where("o_orderstatus = 'F'").drop("o_orderstatus"), store, ["key"])
    second = landing.append_new(inbox.drop("o_orderstatus"), store, ["key"])
    counts = {"first_new": first["new"], "second_new": second["new"], "second_skipped": second["skipped"]}
    return spark.read.parquet(store).select(
        "key", "source_path", *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()]
    )


def q_landing_replace(spark: SparkSession, sf: str) -> DataFrame:
    """All orders by status, then the pending ones again under another path."""
    orders, store = _orders_as_inbox(spark, sf), _scratch(spark, "replace")
    landing.replace_by_key(orders, store, "o_orderstatus")
    again = orders.where("o_orderstatus = 'P'").withColumn("source_path", F.concat("source_path", F.lit("/2")))
    landing.replace_by_key(again, store, "o_orderstatus")
    return spark.read.parquet(store).select("key", "source_path", "o_orderstatus")


def q_keyed_append(spark: SparkSession, sf: str) -> DataFrame:
    """R4 + R6 + R9 on the store by key: as ``q_landing_append``, in hash buckets; same oracle."""
    inbox, store = _orders_as_inbox(spark, sf), _scratch(spark, "keyed-append")
    first = keyed_store.append_unseen(inbox.where("o_orderstatus = 'F'").drop("o_orderstatus"), store, ["key"])
    second = keyed_store.append_unseen(inbox.drop("o_orderstatus"), store, ["key"])
    counts = {"first_new": first["new"], "second_new": second["new"], "second_skipped": second["skipped"]}
    return keyed_store.read_keyed(spark, store).select(
        "key", "source_path", *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()]
    )


def q_keyed_replace(spark: SparkSession, sf: str) -> DataFrame:
    """R7 by customer: all orders, then the pending ones again; a customer with
    a pending order keeps only these. As many folders as buckets."""
    orders, store = _orders_as_inbox(spark, sf), _scratch(spark, "keyed-replace")
    keyed_store.replace_keys(orders, store, ["key"])
    again = orders.where("o_orderstatus = 'P'").withColumn("source_path", F.concat("source_path", F.lit("/2")))
    keyed_store.replace_keys(again, store, ["key"])
    return keyed_store.read_keyed(spark, store)


def q_current_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """M2 kept as state: the event history merged in three snapshots, the last
    one late and older in part and delivered twice; no merge reads history."""
    store = _scratch(spark, "current")
    history = load(spark, sf, "events").select("user_id", X.as_date("ts").alias("snapshot_date"), "event_id", "event_type")
    late, early = F.col("event_type") == "error", F.dayofmonth("snapshot_date") <= 15
    waves = [history.where(~late & early), history.where(~late & ~early), history.where(late)]
    for batch, wave in [*enumerate(waves), (2, waves[2])]:
        keyed_store.merge_latest(wave, store, ["user_id"], "snapshot_date", stream="events", batch_id=batch)
    return keyed_store.read_keyed(spark, store)


#: Documents of the file queries: one order each.
_ORDER_DOC = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE"


def _write_order_files(orders: DataFrame, folder: str) -> None:
    """Orders as JSON files, one document per line, in one folder per month."""
    fields = F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice"))
    month = F.date_format("o_orderdate", "yyyy-MM")
    rows = orders.select(fields.alias("value"), month.alias("month")).hint("rebalance", "month")
    rows.write.partitionBy("month").mode("append").text(folder)


def q_scan_documents(spark: SparkSession, sf: str) -> DataFrame:
    """S1 + S2 + S3: orders written as JSON files by month, read back by a glob;
    the month comes from each file's path."""
    root = _scratch(spark, "documents")
    _write_order_files(load(spark, sf, "orders"), root)
    docs = read_documents(spark, f"{root}/month=*/*", _ORDER_DOC, multi_line=False)
    month = X.split_part(path_key(2), "=", 2)
    return docs.select("o_orderkey", "o_custkey", "o_totalprice", month.alias("month"))


def q_dq_measured(spark: SparkSession, sf: str) -> DataFrame:
    """Q1-Q4 over tables that are stored with measures: NULL counts and clean
    value lists come from the writes, the rest from one scan per table."""
    from .proofs import DRIVER_SUITE

    root, tables, known = _scratch(spark, "measured"), {}, {}
    for name in ("orders", "lineitem", "customer"):
        columns = {c for t in DRIVER_SUITE for c, m in ((t.column, t.model), (t.field_name, t.to)) if m == name}
        write_table(load(spark, sf, name).select(*sorted(columns)), root, name, measures=measures(name, DRIVER_SUITE))
        tables[name], known = read_table(spark, root, name), known | measured(spark, root, name)
    return run_suite(tables, DRIVER_SUITE, known)


def _vintages(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Customers in four shapes by nation: the balance absent, as INTEGER, as
    DOUBLE and as text; the nation as INTEGER, BIGINT and DOUBLE; a struct that
    grows a field."""
    c = load(spark, sf, "customer")
    kind, cents = F.pmod("c_nationkey", F.lit(4)), F.round(F.col("c_acctbal") * 100).cast("int")
    name = F.col("c_name").alias("name")
    return [
        c.where(kind == 0).select("c_custkey", F.col("c_nationkey").cast("int").alias("nation"), F.struct(name).alias("who")),
        c.where(kind == 1).select("c_custkey", F.col("c_nationkey").cast("bigint").alias("nation"), cents.alias("balance")),
        c.where(kind == 2).select("c_custkey", F.col("c_nationkey").cast("double").alias("nation"), (cents / 100.0).alias("balance"), F.struct(name, F.col("c_mktsegment").alias("segment")).alias("who")),
        c.where(kind == 3).select("c_custkey", F.col("c_nationkey").cast("int").alias("nation"), F.concat(F.lit("about "), cents.cast("string")).alias("balance")),
    ]


def q_parquet_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """S4 + S1 over Parquet files whose types differ, read as one table by name."""
    root = _scratch(spark, "vintages")
    for i, df in enumerate(_vintages(spark, sf)):
        df.write.parquet(f"{root}/vintage={i}")
    rows = read_parquet_by_name(spark, root)
    return rows.select("c_custkey", "nation", "balance", F.col("who.name").alias("name"), F.col("who.segment").alias("segment"))


def q_json_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """S4 + S1 over JSON files whose types differ, read as one table by name."""
    root = _scratch(spark, "vintages-json")
    for i, df in enumerate(_vintages(spark, sf)):
        df.write.json(f"{root}/vintage={i}")
    rows = read_json_by_name(spark, f"{root}/vintage=*/*")
    return rows.select("c_custkey", "nation", "balance", F.col("who.name").alias("name"), F.col("who.segment").alias("segment"))


def q_stream_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """R8 + R6 + R9: files of the finished orders, taken in by the stream, then
    files of all orders, then nothing new. A customer comes in once, from the
    greatest order of the first run that holds it; counts of the runs beside."""
    root = _scratch(spark, "stream")
    orders, sources = load(spark, sf, "orders"), f"{root}/files"

    def shape(docs: DataFrame) -> DataFrame:
        path = F.concat(F.lit("orders/"), F.lpad(X.text(F.col("o_orderkey")), 12, "0"))
        return docs.select(F.col("o_custkey").alias("key"), path.alias("source_path"), "_corrupt_record")

    def run() -> dict[str, int]:
        counts = incremental.ingest_keyed(
            spark, f"{sources}/wave=*/month=*/*", _ORDER_DOC, f"{root}/store", f"{root}/checkpoint", ["key"],
            shape=shape, multi_line=False, max_files=1_000_000,
        )
        return {k: sum(c[k] for c in counts) for k in ("new", "skipped")}

    _write_order_files(orders.where("o_orderstatus = 'F'"), f"{sources}/wave=1")
    first = run()
    _write_order_files(orders, f"{sources}/wave=2")
    second, third = run(), run()
    if any(third.values()):
        raise RuntimeError("files were taken in twice")
    counts = {"first_new": first["new"], "second_new": second["new"], "second_skipped": second["skipped"]}
    return keyed_store.read_keyed(spark, f"{root}/store").select(
        "key", "source_path", *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()]
    )


def q_table_and_view(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table under a given root, read by name, and a view over it."""
    root = _scratch(spark, "tables")
    write_table(load(spark, sf, "customer").select("c_custkey", "c_nationkey"), root, "cust", partition_by=["c_nationkey"])
    register_view(read_table(spark, root, "cust", ["c_custkey", "c_nationkey"]), "q_table_and_view_cust")
    return spark.sql("select c_nationkey, count(*) as n, min(c_custkey) as least from q_table_and_view_cust group by 1")


def q_model_dim_teams(spark: SparkSession, sf: str) -> DataFrame:
    """M1 -> M2 -> M6: the standings history, its current view (latest
    snapshot per team, ties kept) and the team dimension."""
    history = staging.stg_standings_history(_standings_documents(spark, sf))
    return marts.dim_teams(staging.stg_standings(history))


def q_report_player_history_sample(spark: SparkSession, sf: str) -> DataFrame:
    """B4 on the roster documents' history (ties are identical rows)."""
    return reports.player_history_sample(staging.stg_players_history(_roster_documents(spark, sf)))


def q_report_current_players(spark: SparkSession, sf: str) -> DataFrame:
    """B6 on the current view of the customer-by-order history."""
    return reports.current_players_sample(staging.stg_players(_player_history(spark, sf)))


def q_report_current_standings(spark: SparkSession, sf: str) -> DataFrame:
    """Current standings with the binary-rounded pct and the streak text."""
    history = staging.stg_standings_history(_standings_documents(spark, sf))
    return reports.current_standings(staging.stg_standings(history))


def q_report_teams_per_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Teams listed per standings snapshot, newest first."""
    return reports.teams_per_snapshot(staging.stg_standings_history(_standings_documents(spark, sf)))


def q_report_first_goals(spark: SparkSession, sf: str) -> DataFrame:
    """B10 on a fact-shaped frame from events: each event its own game (so
    the report's order is total), purchases as goals, the user and the next
    user id as scorer and first assist, names by a role join to customers."""
    ev = load(spark, sf, "events")
    hour = F.hour("ts")
    fact = ev.select(
        F.col("event_id").alias("game_id"),
        X.as_date("ts").alias("game_date"),
        F.lit(10).alias("sort_order"),
        F.when(F.col("event_type") == "purchase", "goal").otherwise(F.col("event_type")).alias("event_type"),
        F.lit("H").alias("home_team_abbrev"),
        F.lit("A").alias("away_team_abbrev"),
        F.when(hour < 8, 1).when(hour < 16, 2).otherwise(3).alias("period"),
        F.date_format("ts", "mm:ss").alias("time_in_period"),
        F.col("user_id").alias("scoring_player_id"),
        (F.col("user_id") + F.lit(1)).alias("assist1_player_id"),
        F.lit(None).cast("bigint").alias("assist2_player_id"),
        F.lit(None).cast("bigint").alias("goalie_player_id"),
        F.lit("wrist").alias("shot_type"),
        F.lit(1).alias("home_score_at_goal"),
        F.lit(0).alias("away_score_at_goal"),
    )
    named = role_join(
        fact, load(spark, sf, "customer"), "c_custkey", "c_name",
        [("scoring_player_id", "scoring_player_name"), ("assist1_player_id", "assist1_player_name"),
         ("assist2_player_id", "assist2_player_name"), ("goalie_player_id", "goalie_player_name")],
    )
    return reports.first_goals(named)


STANDIN_QUERIES = {
    "q_report_first_goals": q_report_first_goals,
    "q_report_player_history_sample": q_report_player_history_sample,
    "q_report_current_players": q_report_current_players,
    "q_report_current_standings": q_report_current_standings,
    "q_report_teams_per_snapshot": q_report_teams_per_snapshot,
    "q_model_dim_teams": q_model_dim_teams,
    "q_model_plays": q_model_plays,
    "q_report_newest_games": q_report_newest_games,
    "q_report_game_summary": q_report_game_summary,
    "q_report_event_types": q_report_event_types,
    "q_report_snapshot_summary": q_report_snapshot_summary,
    "q_report_fact_breakdown": q_report_fact_breakdown,
    "q_report_unknown_types": q_report_unknown_types,
    "q_model_games": q_model_games,
    "q_model_player_history": q_model_player_history,
    "q_model_standings_history": q_model_standings_history,
    "q_model_dim_players": q_model_dim_players,
    "q_json_games": q_json_games,
    "q_json_plays": q_json_plays,
    "q_json_rosters": q_json_rosters,
    "q_json_standings": q_json_standings,
    "q_age_today": q_age_today,
    "q_model_fct_plays_past_bound": q_model_fct_plays_past_bound,
    "q_model_fct_plays_stored": q_model_fct_plays_stored,
    "q_landing_append": q_landing_append,
    "q_landing_replace": q_landing_replace,
    "q_keyed_append": q_keyed_append,
    "q_keyed_replace": q_keyed_replace,
    "q_current_incremental": q_current_incremental,
    "q_scan_documents": q_scan_documents,
    "q_dq_measured": q_dq_measured,
    "q_parquet_by_name": q_parquet_by_name,
    "q_json_by_name": q_json_by_name,
    "q_stream_keyed": q_stream_keyed,
    "q_table_and_view": q_table_and_view,
    "q_landing_completed_ids": q_landing_completed_ids,
    "q_landing_past_games": q_landing_past_games,
    "q_landing_newest_teams": q_landing_newest_teams,
    "q_model_fct_plays": q_model_fct_plays,
}

STANDIN_ORACLE_SQL = {
    "q_report_first_goals": "select cast(e.ts as date) as game_date, 'H' as home_team_abbrev, 'A' as away_team_abbrev, case when hour(e.ts) < 8 then 1 when hour(e.ts) < 16 then 2 else 3 end as period, strftime(e.ts, '%M:%S') as time_in_period, c1.c_name as scoring_player_name, c2.c_name as assist1_player_name, cast(null as varchar) as assist2_player_name, cast(null as varchar) as goalie_player_name, 'wrist' as shot_type, 1 as home_score_at_goal, 0 as away_score_at_goal from events e left join customer c1 on e.user_id = c1.c_custkey left join customer c2 on e.user_id + 1 = c2.c_custkey where e.event_type = 'purchase' order by game_date, e.event_id limit 10",
    "q_report_player_history_sample": "select player_id, team_abbrev, snapshot_date, full_name, position_code, player_group, sweater_number from (with d as (select l.l_returnflag as team_abbrev, cast(l.l_shipdate as date) as snapshot_date, s.s_suppkey, s.s_name, s.s_nationkey as nk, s.s_acctbal, l.l_linenumber, case when s.s_nationkey < 5 then 'G' when s.s_nationkey < 10 then 'D' when s.s_nationkey < 15 then 'C' when s.s_nationkey < 20 then 'L' else 'R' end as pos from lineitem l join supplier s on l.l_suppkey = s.s_suppkey) select cast(s_suppkey as integer) as player_id, team_abbrev, snapshot_date, case when pos in ('C', 'L', 'R') then 'forward' when pos = 'D' then 'defenseman' else 'goalie' end as player_group, s_name as first_name, 'N' || cast(nk as varchar) as last_name, s_name || ' ' || 'N' || cast(nk as varchar) as full_name, nk as sweater_number, pos as position_code, case when s_acctbal >= 0 then 'L' else 'R' end as shoots_catches, 60 + nk as height_inches, 150 + l_linenumber as weight_pounds, cast(date '1990-01-01' + nk as date) as birth_date, 'C' || cast(nk as varchar) as birth_city, 'CAN' as birth_country, 'https://img/' || cast(s_suppkey as varchar) as headshot_url from d) order by snapshot_date desc, team_abbrev, full_name, player_id limit 20",
    "q_report_current_players": "with h as (select c.c_custkey as player_id, o.o_orderpriority as team_abbrev, cast(o.o_orderdate as date) as snapshot_date, case when c.c_acctbal >= 0 then case c.c_mktsegment when 'AUTOMOBILE' then 'C' when 'BUILDING' then 'L' when 'FURNITURE' then 'R' when 'HOUSEHOLD' then 'G' when 'MACHINERY' then 'D' end end as position_code, c.c_name as first_name, c.c_mktsegment as last_name, c.c_name || ' ' || c.c_mktsegment as full_name, c.c_nationkey as sweater_number, 'L' as shoots_catches, 60 + c.c_nationkey as height_inches, 150 + c.c_nationkey as weight_pounds, cast(date '1985-12-31' + c.c_nationkey as date) as birth_date, c.c_mktsegment as birth_city, cast(c.c_nationkey as varchar) as birth_country, 'https://img/' || cast(c.c_custkey as varchar) as headshot_url from orders o join customer c on o.o_custkey = c.c_custkey), g as (select *, case when position_code = 'G' then 'goalie' when position_code = 'D' then 'defenseman' else 'forward' end as player_group from h), s as (select player_id, max(snapshot_date) as latest_date from g group by player_id), cur as (select g.* from g join s on g.player_id = s.player_id and g.snapshot_date = s.latest_date) select player_id, team_abbrev, full_name, position_code, sweater_number, birth_country from cur order by team_abbrev, full_name, player_id limit 20",
    "q_report_current_standings": "with h as (select o_orderpriority as team_abbrev, cast(o_orderdate as date) as snapshot_date, 'Team ' || o_orderpriority as team_name, o_orderstatus as conference_abbrev, 'A' as division_abbrev, cast(dayofmonth(o_orderdate) + 0 as integer) as league_rank, cast(dayofmonth(o_orderdate) + 3 as integer) as games_played, cast(dayofmonth(o_orderdate) + 4 as integer) as wins, cast(dayofmonth(o_orderdate) + 5 as integer) as losses, cast(dayofmonth(o_orderdate) + 6 as integer) as ot_losses, cast(dayofmonth(o_orderdate) + 7 as integer) as points, o_totalprice / 1000000 as point_pct, cast(dayofmonth(o_orderdate) + 12 as integer) as goal_differential, o_orderstatus as streak_code, cast(dayofmonth(o_orderdate) + 25 as integer) as streak_count from orders), s as (select team_abbrev, max(snapshot_date) as latest_date from h group by team_abbrev) select h.league_rank, h.team_abbrev, h.team_name, h.conference_abbrev, h.division_abbrev, h.games_played, h.wins, h.losses, h.ot_losses, h.points, round(h.point_pct, 3) as point_pct, h.goal_differential, h.streak_code || cast(h.streak_count as varchar) as streak from h join s on h.team_abbrev = s.team_abbrev and h.snapshot_date = s.latest_date order by h.league_rank, h.team_abbrev",
    "q_report_teams_per_snapshot": "select cast(o_orderdate as date) as snapshot_date, count(*) as teams from orders group by 1 order by snapshot_date desc",
    "q_model_dim_teams": "with h as (select o_orderpriority as team_abbrev, cast(o_orderdate as date) as snapshot_date, 'Team ' || o_orderpriority as team_name, o_orderstatus as team_common_name, case when o_orderstatus = 'F' then 'Eastern' else 'Western' end as conference_name, o_orderstatus as conference_abbrev, 'Atlantic' as division_name, 'A' as division_abbrev, 'https://logo/' || o_orderpriority as team_logo_url from orders), s as (select team_abbrev, max(snapshot_date) as latest_date from h group by team_abbrev) select h.team_abbrev, h.team_name, h.team_common_name, h.conference_name, h.conference_abbrev, h.division_name, h.division_abbrev, h.team_logo_url from h join s on h.team_abbrev = s.team_abbrev and h.snapshot_date = s.latest_date",
    "q_model_plays": "select cast(l_suppkey as integer) as game_id, l_linenumber as event_id, case when l_discount < 0.05 then 1 else 2 end as period, 'REG' as period_type, '05:00' as time_in_period, '15:00' as time_remaining, case when l_returnflag = 'R' then 'goal' when l_returnflag = 'A' then 'hit' else 'faceoff' end as event_type, l_linenumber * 10 as sort_order, case when l_linestatus = 'O' then '1551' else '1451' end as situation_code, cast(l_quantity as integer) as x_coord, case when l_returnflag = 'R' then cast(l_suppkey as integer) end as scoring_player_id from lineitem where not (l_returnflag = 'A' and l_linestatus = 'O')",
    "q_report_newest_games": "select o_orderkey as game_id, cast(o_orderdate as date) as game_date, o_orderpriority as away_team_abbrev, cast(o_totalprice / 100000 as integer) as away_score, cast(dayofweek(o_orderdate) + 1 as integer) as home_score, o_orderstatus as home_team_abbrev, case o_orderstatus when 'F' then 'REG' when 'O' then 'OT' when 'P' then 'SO' end as last_period_type, o_orderstatus as game_state from orders order by game_date desc, game_id limit 10",
    "q_report_game_summary": "select count(*) as total_games, min(cast(o_orderdate as date)) as earliest_game, max(cast(o_orderdate as date)) as latest_game, count(*) filter (where o_orderstatus = 'F') as reg, count(*) filter (where o_orderstatus = 'O') as ot, count(*) filter (where o_orderstatus = 'P') as so from orders",
    "q_report_event_types": "select event_type, count(*) as total_events, count(*) filter (where user_id % 3 = 1) as p1, count(*) filter (where user_id % 3 = 2) as p2, count(*) filter (where user_id % 3 = 0) as p3 from events group by event_type order by total_events desc, event_type",
    "q_report_snapshot_summary": "select cast(ts as date) as snapshot_date, event_type as team_abbrev, count(*) as player_count from events group by 1, 2 order by snapshot_date desc, team_abbrev limit 20",
    "q_report_fact_breakdown": "select event_type, count(*) as total from events group by event_type order by total desc, event_type",
    "q_report_unknown_types": "select distinct event_type from events where event_type not in ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot', 'hit', 'faceoff', 'giveaway', 'takeaway', 'penalty', 'stoppage', 'period-start', 'period-end', 'game-end', 'delayed-penalty')",
    "q_model_games": "with g as (select o_orderkey as game_id, year(o_orderdate) as season, case when o_orderstatus = 'F' then 2 when o_orderstatus = 'O' then 3 else 1 end::bigint as game_type, cast(o_orderdate as date) as game_date, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as start_time_utc, case when o_orderstatus = 'F' then 'OFF' when o_orderstatus = 'O' then 'LIVE' else 'PRE' end as game_state, 'OK' as game_schedule_state, o_orderpriority as venue, cast(null as varchar) as venue_location, cast(dayofweek(o_orderdate) + 1 as integer) as away_team_id, o_orderstatus as away_team_abbrev, o_orderpriority as away_team_name, cast(o_totalprice / 100000 as integer) as away_score, cast(dayofmonth(o_orderdate) as integer) as away_sog, cast(month(o_orderdate) as integer) as home_team_id, o_orderpriority as home_team_abbrev, o_orderstatus as home_team_name, cast(dayofweek(o_orderdate) + 1 as integer) as home_score, 30 as home_sog, case o_orderstatus when 'F' then 'REG' when 'O' then 'OT' when 'P' then 'SO' end as last_period_type, cast(3 as bigint) as reg_periods, o_orderstatus <> 'P' as ot_in_use, cast(null as boolean) as shootout_in_use from orders) select *, away_score > home_score as away_win, home_score > away_score as home_win, abs(home_score - away_score) as goal_diff from g",
    "q_model_player_history": "with d as (select l.l_returnflag as team_abbrev, cast(l.l_shipdate as date) as snapshot_date, s.s_suppkey, s.s_name, s.s_nationkey as nk, s.s_acctbal, l.l_linenumber, case when s.s_nationkey < 5 then 'G' when s.s_nationkey < 10 then 'D' when s.s_nationkey < 15 then 'C' when s.s_nationkey < 20 then 'L' else 'R' end as pos from lineitem l join supplier s on l.l_suppkey = s.s_suppkey) select cast(s_suppkey as integer) as player_id, team_abbrev, snapshot_date, case when pos in ('C', 'L', 'R') then 'forward' when pos = 'D' then 'defenseman' else 'goalie' end as player_group, s_name as first_name, 'N' || cast(nk as varchar) as last_name, s_name || ' ' || 'N' || cast(nk as varchar) as full_name, nk as sweater_number, pos as position_code, case when s_acctbal >= 0 then 'L' else 'R' end as shoots_catches, 60 + nk as height_inches, 150 + l_linenumber as weight_pounds, cast(date '1990-01-01' + nk as date) as birth_date, 'C' || cast(nk as varchar) as birth_city, 'CAN' as birth_country, 'https://img/' || cast(s_suppkey as varchar) as headshot_url from d",
    "q_model_standings_history": "select o_orderpriority as team_abbrev, cast(o_orderdate as date) as snapshot_date, cast(year(o_orderdate) as integer) as season_id, 'Team ' || o_orderpriority as team_name, o_orderstatus as team_common_name, case when o_orderstatus = 'F' then 'Eastern' else 'Western' end as conference_name, o_orderstatus as conference_abbrev, 'Atlantic' as division_name, 'A' as division_abbrev, cast(dayofmonth(o_orderdate) + 0 as integer) as league_rank, cast(dayofmonth(o_orderdate) + 1 as integer) as conference_rank, cast(dayofmonth(o_orderdate) + 2 as integer) as division_rank, cast(dayofmonth(o_orderdate) + 3 as integer) as games_played, cast(dayofmonth(o_orderdate) + 4 as integer) as wins, cast(dayofmonth(o_orderdate) + 5 as integer) as losses, cast(dayofmonth(o_orderdate) + 6 as integer) as ot_losses, cast(dayofmonth(o_orderdate) + 7 as integer) as points, o_totalprice / 1000000 as point_pct, cast(dayofmonth(o_orderdate) + 8 as integer) as regulation_wins, cast(dayofmonth(o_orderdate) + 9 as integer) as regulation_ot_wins, cast(dayofmonth(o_orderdate) + 10 as integer) as goals_for, cast(dayofmonth(o_orderdate) + 11 as integer) as goals_against, cast(dayofmonth(o_orderdate) + 12 as integer) as goal_differential, cast(dayofmonth(o_orderdate) + 13 as integer) as home_wins, cast(dayofmonth(o_orderdate) + 14 as integer) as home_losses, cast(dayofmonth(o_orderdate) + 15 as integer) as home_ot_losses, cast(dayofmonth(o_orderdate) + 16 as integer) as home_points, cast(dayofmonth(o_orderdate) + 17 as integer) as road_wins, cast(dayofmonth(o_orderdate) + 18 as integer) as road_losses, cast(dayofmonth(o_orderdate) + 19 as integer) as road_ot_losses, cast(dayofmonth(o_orderdate) + 20 as integer) as road_points, cast(dayofmonth(o_orderdate) + 21 as integer) as l10_wins, cast(dayofmonth(o_orderdate) + 22 as integer) as l10_losses, cast(dayofmonth(o_orderdate) + 23 as integer) as l10_ot_losses, cast(dayofmonth(o_orderdate) + 24 as integer) as l10_points, o_orderstatus as streak_code, cast(dayofmonth(o_orderdate) + 25 as integer) as streak_count, cast(dayofmonth(o_orderdate) + 26 as integer) as wildcard_sequence, 'https://logo/' || o_orderpriority as team_logo_url from orders",
    "q_model_dim_players": "with h as (select c.c_custkey as player_id, o.o_orderpriority as team_abbrev, cast(o.o_orderdate as date) as snapshot_date, case when c.c_acctbal >= 0 then case c.c_mktsegment when 'AUTOMOBILE' then 'C' when 'BUILDING' then 'L' when 'FURNITURE' then 'R' when 'HOUSEHOLD' then 'G' when 'MACHINERY' then 'D' end end as position_code, c.c_name as first_name, c.c_mktsegment as last_name, c.c_name || ' ' || c.c_mktsegment as full_name, c.c_nationkey as sweater_number, 'L' as shoots_catches, 60 + c.c_nationkey as height_inches, 150 + c.c_nationkey as weight_pounds, cast(date '1985-12-31' + c.c_nationkey as date) as birth_date, c.c_mktsegment as birth_city, cast(c.c_nationkey as varchar) as birth_country, 'https://img/' || cast(c.c_custkey as varchar) as headshot_url from orders o join customer c on o.o_custkey = c.c_custkey), g as (select *, case when position_code = 'G' then 'goalie' when position_code = 'D' then 'defenseman' else 'forward' end as player_group from h), s as (select player_id, max(snapshot_date) as latest_date from g group by player_id), cur as (select g.* from g join s on g.player_id = s.player_id and g.snapshot_date = s.latest_date) select player_id, team_abbrev, full_name, first_name, last_name, position_code, player_group, sweater_number, shoots_catches, height_inches, weight_pounds, birth_date, birth_city, birth_country, headshot_url, date_diff('year', birth_date, date '2026-06-30') as age, case when position_code = 'G' then 'Goalie' when position_code in ('L', 'R', 'C') then 'Forward' when position_code = 'D' then 'Defenseman' else 'Unknown' end as position_group, case when height_inches is not null then cast(height_inches / 12 as integer) || '''' || cast(height_inches % 12 as integer) || '\"' end as height_display, case when height_inches is not null then cast(floor(height_inches / 12) as integer) || '''' || cast(height_inches % 12 as integer) || '\"' end as height_display_floor from cur",
    "q_landing_completed_ids": "select distinct o_orderkey as game_id from orders where o_orderstatus in ('F', 'P') order by game_id",
    "q_landing_past_games": "select o_orderkey as game_id, cast(o_orderdate as date) as game_date, case when o_orderstatus = 'F' then 2 when o_orderstatus = 'O' then 3 else 1 end::bigint as game_type from orders where cast(o_orderdate as date) < date '1996-01-01' and o_orderstatus in ('F', 'O') order by game_date, game_id",
    "q_landing_newest_teams": "select o_orderpriority as team_abbrev from orders where cast(o_orderdate as date) = (select max(cast(o_orderdate as date)) from orders)",
    "q_model_fct_plays": "with p as (select l_orderkey as game_id, l_linenumber as event_id, case when l_returnflag = 'R' then 'goal' when l_returnflag = 'A' then 'hit' when l_returnflag = 'N' and l_linestatus = 'O' then 'faceoff' else 'penalty' end as event_type, l_linenumber * 10 as sort_order, case when l_discount < 0.03 then 1 when l_discount < 0.07 then 2 else 3 end as period, 'REG' as period_type, '10:00' as time_in_period, '10:00' as time_remaining, '1551' as situation_code, case when l_linestatus = 'O' then 1 else 2 end as event_team_id, cast(l_quantity as integer) as x_coord, l_linenumber as y_coord, case when l_linestatus = 'O' then 'O' else 'D' end as zone_code, case when l_returnflag = 'R' then 'wrist' end as shot_type, case when l_returnflag = 'R' then cast(l_suppkey as integer) end as scoring_player_id, case when l_returnflag = 'R' then cast(l_suppkey + 1 as integer) end as assist1_player_id, case when l_returnflag = 'R' then l_linenumber end as assist2_player_id, cast(null as integer) as scoring_player_total, cast(null as integer) as assist1_player_total, cast(null as integer) as assist2_player_total, case when l_returnflag = 'R' then 0 end as away_score_at_goal, case when l_returnflag = 'R' then l_linenumber end as home_score_at_goal, case when l_returnflag = 'R' then l_linenumber end as goalie_player_id, case when l_returnflag = 'R' then 'https://clip/' || cast(l_orderkey as varchar) end as highlight_url, case when l_returnflag = 'R' then cast(l_suppkey as integer) end as shooting_player_id, case when l_returnflag = 'N' and l_linestatus <> 'O' then l_linenumber end as blocking_player_id, case when l_returnflag = 'N' and l_linestatus = 'O' then cast(l_suppkey as integer) end as faceoff_winning_player_id, case when l_returnflag = 'N' and l_linestatus = 'O' then cast(-l_suppkey as integer) end as faceoff_losing_player_id, case when l_returnflag = 'A' then cast(l_suppkey as integer) end as hitting_player_id, case when l_returnflag = 'A' then l_linenumber end as hittee_player_id, case when l_returnflag = 'N' and l_linestatus <> 'O' then cast(l_suppkey as integer) end as penalty_committed_by_player_id, case when l_returnflag = 'N' and l_linestatus <> 'O' then cast(l_suppkey + 1 as integer) end as penalty_drawn_by_player_id, case when l_returnflag = 'N' and l_linestatus <> 'O' then 'tripping' end as penalty_desc, case when l_returnflag = 'N' and l_linestatus <> 'O' then 2 end as penalty_duration_minutes, case when l_returnflag = 'A' then cast(-l_linenumber as integer) end as player_id from lineitem), d as (select cast(s_suppkey as integer) as pid, s_name as full_name from supplier), g as (select o_orderkey as gid, cast(o_orderdate as date) as game_date, year(o_orderdate) as season, o_orderstatus as home_team_abbrev, o_orderpriority as away_team_abbrev, cast(dayofweek(o_orderdate) + 1 as integer) as final_home_score, cast(o_totalprice / 100000 as integer) as final_away_score, case o_orderstatus when 'F' then 'REG' when 'O' then 'OT' when 'P' then 'SO' end as last_period_type from orders) select p.*, g.game_date, g.season, g.home_team_abbrev, g.away_team_abbrev, g.final_home_score, g.final_away_score, g.last_period_type, r0.full_name as scoring_player_name, r1.full_name as assist1_player_name, r2.full_name as assist2_player_name, r3.full_name as goalie_player_name, r4.full_name as shooting_player_name, r5.full_name as faceoff_winning_player_name, r6.full_name as faceoff_losing_player_name, r7.full_name as hitting_player_name, r8.full_name as hittee_player_name, r9.full_name as penalty_committed_by_player_name, r10.full_name as penalty_drawn_by_player_name, r11.full_name as player_name from p left join g on p.game_id = g.gid left join d r0 on p.scoring_player_id = r0.pid left join d r1 on p.assist1_player_id = r1.pid left join d r2 on p.assist2_player_id = r2.pid left join d r3 on p.goalie_player_id = r3.pid left join d r4 on p.shooting_player_id = r4.pid left join d r5 on p.faceoff_winning_player_id = r5.pid left join d r6 on p.faceoff_losing_player_id = r6.pid left join d r7 on p.hitting_player_id = r7.pid left join d r8 on p.hittee_player_id = r8.pid left join d r9 on p.penalty_committed_by_player_id = r9.pid left join d r10 on p.penalty_drawn_by_player_id = r10.pid left join d r11 on p.player_id = r11.pid",
}
STANDIN_ORACLE_SQL["q_json_games"] = STANDIN_ORACLE_SQL["q_model_games"]
STANDIN_ORACLE_SQL["q_json_plays"] = STANDIN_ORACLE_SQL["q_model_plays"]
STANDIN_ORACLE_SQL["q_json_rosters"] = STANDIN_ORACLE_SQL["q_model_player_history"]
STANDIN_ORACLE_SQL["q_json_standings"] = STANDIN_ORACLE_SQL["q_model_standings_history"]
STANDIN_ORACLE_SQL["q_model_fct_plays_past_bound"] = STANDIN_ORACLE_SQL["q_model_fct_plays"]
STANDIN_ORACLE_SQL["q_model_fct_plays_stored"] = STANDIN_ORACLE_SQL["q_model_fct_plays"]
STANDIN_ORACLE_SQL["q_age_today"] = "select o_orderkey, date_diff('year', cast(o_orderdate as date), current_date) as age from orders"
STANDIN_ORACLE_SQL["q_landing_append"] = (
    "with o as (select o_custkey as key, 'orders/' || lpad(cast(o_orderkey as varchar), 12, '0') as source_path, o_orderstatus from orders),"
    " a as (select key, max(source_path) as source_path from o where o_orderstatus = 'F' group by key),"
    " b as (select key, max(source_path) as source_path from o where key not in (select key from a) group by key)"
    " select key, source_path, (select count(*) from a) as first_new, (select count(*) from b) as second_new,"
    " (select count(*) from o) - (select count(*) from b) as second_skipped from (select * from a union all select * from b)"
)
STANDIN_ORACLE_SQL["q_landing_replace"] = (
    "select o_custkey as key, 'orders/' || lpad(cast(o_orderkey as varchar), 12, '0') || case when o_orderstatus = 'P' then '/2' else '' end as source_path,"
    " o_orderstatus from orders"
)
STANDIN_ORACLE_SQL["q_table_and_view"] = "select c_nationkey, count(*) as n, min(c_custkey) as least from customer group by 1"
STANDIN_ORACLE_SQL["q_keyed_append"] = STANDIN_ORACLE_SQL["q_landing_append"]
STANDIN_ORACLE_SQL["q_stream_keyed"] = STANDIN_ORACLE_SQL["q_landing_append"]
STANDIN_ORACLE_SQL["q_keyed_replace"] = (
    "select o_custkey as key, 'orders/' || lpad(cast(o_orderkey as varchar), 12, '0') || case when o_orderstatus = 'P' then '/2' else '' end as source_path,"
    " o_orderstatus from orders where o_orderstatus = 'P' or o_custkey not in (select o_custkey from orders where o_orderstatus = 'P')"
)
STANDIN_ORACLE_SQL["q_current_incremental"] = (
    "with h as (select user_id, cast(ts as date) as snapshot_date, event_id, event_type from events)"
    " select h.* from h join (select user_id, max(snapshot_date) as latest from h group by user_id) s"
    " on h.user_id = s.user_id and h.snapshot_date = s.latest"
)
STANDIN_ORACLE_SQL["q_parquet_by_name"] = STANDIN_ORACLE_SQL["q_json_by_name"] = (
    "with c as (select *, c_nationkey % 4 as kind, cast(round(c_acctbal * 100) as integer) as cents from customer)"
    " select c_custkey, cast(c_nationkey as double) as nation,"
    " case kind when 1 then cast(cents as varchar) when 2 then cast(cents / 100.0 as varchar) when 3 then 'about ' || cents end as balance,"
    " case when kind in (0, 2) then c_name end as name, case when kind = 2 then c_mktsegment end as segment from c"
)
STANDIN_ORACLE_SQL["q_scan_documents"] = (
    "select o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m') as month from orders"
)
