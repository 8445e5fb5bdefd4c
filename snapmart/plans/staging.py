"""Staging models: typed, unnested history tables and the two current views.

Inputs are DataFrames of raw documents (see :mod:`snapmart.sources.documents`)
carrying ``source_path``; the path keys are cut from its end.

* ``stg_standings_history``: one row per team and snapshot date.
* ``stg_players_history``: one row per player, team and snapshot date; the
  three position lists are unnested in one scan.
* ``stg_games``: one row per game document.
* ``stg_plays``: one row per play; ``details`` stays VARIANT.
* ``stg_players`` / ``stg_standings``: latest snapshot per key (ties kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import as_date, concat_strict, number_field
from ..operators.latest import latest_per_key
from ..operators.unnest import unnest_tagged
from ..sources.documents import path_key

# Output column, source field in the standings entry, cast.
STANDINGS_COLUMNS = [
    ("team_abbrev", "teamAbbrev.default", None),
    ("season_id", "seasonId", "int"),
    ("team_name", "teamName.default", None),
    ("team_common_name", "teamCommonName.default", None),
    ("conference_name", "conferenceName", None),
    ("conference_abbrev", "conferenceAbbrev", None),
    ("division_name", "divisionName", None),
    ("division_abbrev", "divisionAbbrev", None),
    ("league_rank", "leagueSequence", "int"),
    ("conference_rank", "conferenceSequence", "int"),
    ("division_rank", "divisionSequence", "int"),
    ("games_played", "gamesPlayed", "int"),
    ("wins", "wins", "int"),
    ("losses", "losses", "int"),
    ("ot_losses", "otLosses", "int"),
    ("points", "points", "int"),
    ("point_pct", "pointPctg", "double"),
    ("regulation_wins", "regulationWins", "int"),
    ("regulation_ot_wins", "regulationPlusOtWins", "int"),
    ("goals_for", "goalFor", "int"),
    ("goals_against", "goalAgainst", "int"),
    ("goal_differential", "goalDifferential", "int"),
    ("home_wins", "homeWins", "int"),
    ("home_losses", "homeLosses", "int"),
    ("home_ot_losses", "homeOtLosses", "int"),
    ("home_points", "homePoints", "int"),
    ("road_wins", "roadWins", "int"),
    ("road_losses", "roadLosses", "int"),
    ("road_ot_losses", "roadOtLosses", "int"),
    ("road_points", "roadPoints", "int"),
    ("l10_wins", "l10Wins", "int"),
    ("l10_losses", "l10Losses", "int"),
    ("l10_ot_losses", "l10OtLosses", "int"),
    ("l10_points", "l10Points", "int"),
    ("streak_code", "streakCode", None),
    ("streak_count", "streakCount", "int"),
    ("wildcard_sequence", "wildcardSequence", "int"),
    ("team_logo_url", "teamLogo", None),
]


def stg_standings_history(standings_docs: DataFrame) -> DataFrame:
    """``standings/{date}/standings.json`` -> one row per team and date."""
    raw = standings_docs.select(
        as_date(path_key(2)).alias("snapshot_date"),
        F.explode("standings").alias("team"),
    )
    cols = [(number_field(raw, f"team.{p}", c) if c else F.col(f"team.{p}")).alias(n) for n, p, c in STANDINGS_COLUMNS]
    return raw.select(cols[0], "snapshot_date", *cols[1:])


STANDINGS_HISTORY_COLUMNS = ["team_abbrev", "snapshot_date"] + [n for n, _, _ in STANDINGS_COLUMNS[1:]]

# Position list -> player group tag.
PLAYER_GROUPS = [("forward", "forwards"), ("defenseman", "defensemen"), ("goalie", "goalies")]

# Output columns of the player history, in order.
PLAYERS_HISTORY_COLUMNS = [
    "player_id", "team_abbrev", "snapshot_date", "player_group", "first_name", "last_name",
    "full_name", "sweater_number", "position_code", "shoots_catches", "height_inches",
    "weight_pounds", "birth_date", "birth_city", "birth_country", "headshot_url",
]


def stg_players_history(roster_docs: DataFrame) -> DataFrame:
    """``rosters/{team}/{date}/roster.json`` -> one row per listed player.

    The three lists are tagged and exploded together: one scan of the
    documents instead of three, and a missing or empty list gives no row.
    """
    keyed = roster_docs.select(
        path_key(3).alias("team_abbrev"),
        as_date(path_key(2)).alias("snapshot_date"),
        *[F.col(lst) for _, lst in PLAYER_GROUPS],
    )
    players = unnest_tagged(
        keyed,
        [(tag, F.col(lst)) for tag, lst in PLAYER_GROUPS],
        item="player", tag_col="player_group",
        keep=["team_abbrev", "snapshot_date"],
    )
    p = "player"
    return players.select(
        number_field(players, f"{p}.id", "int").alias("player_id"),
        "team_abbrev",
        "snapshot_date",
        "player_group",
        F.col(f"{p}.firstName.default").alias("first_name"),
        F.col(f"{p}.lastName.default").alias("last_name"),
        concat_strict(
            F.col(f"{p}.firstName.default"), F.lit(" "), F.col(f"{p}.lastName.default")
        ).alias("full_name"),
        number_field(players, f"{p}.sweaterNumber", "int").alias("sweater_number"),
        F.col(f"{p}.positionCode").alias("position_code"),
        F.col(f"{p}.shootsCatches").alias("shoots_catches"),
        number_field(players, f"{p}.heightInInches", "int").alias("height_inches"),
        number_field(players, f"{p}.weightInPounds", "int").alias("weight_pounds"),
        as_date(F.col(f"{p}.birthDate")).alias("birth_date"),
        F.col(f"{p}.birthCity.default").alias("birth_city"),
        F.col(f"{p}.birthCountry").alias("birth_country"),
        F.col(f"{p}.headshot").alias("headshot_url"),
    )


# Output columns of the games table, in order.
GAMES_COLUMNS = [
    "game_id", "season", "game_type", "game_date", "start_time_utc", "game_state",
    "game_schedule_state", "venue", "venue_location", "away_team_id", "away_team_abbrev",
    "away_team_name", "away_score", "away_sog", "home_team_id", "home_team_abbrev",
    "home_team_name", "home_score", "home_sog", "last_period_type", "reg_periods",
    "ot_in_use", "shootout_in_use", "away_win", "home_win", "goal_diff",
]


def stg_games(pbp_docs: DataFrame) -> DataFrame:
    """``play-by-play/{id}/play-by-play.json`` -> one row per game.

    ``game_id`` is the document's own ``id`` (plays take it from the path).
    The three derived columns reuse the typed scores (a lateral alias).
    """
    typed = pbp_docs.select(
        number_field(pbp_docs, "id", "bigint").alias("game_id"),
        number_field(pbp_docs, "season", "bigint").alias("season"),
        number_field(pbp_docs, "gameType", "bigint").alias("game_type"),
        as_date("gameDate").alias("game_date"),
        F.col("startTimeUTC").cast("timestamp").alias("start_time_utc"),
        F.col("gameState").alias("game_state"),
        F.col("gameScheduleState").alias("game_schedule_state"),
        F.col("venue.default").alias("venue"),
        F.col("venueLocation.default").alias("venue_location"),
        number_field(pbp_docs, "awayTeam.id", "int").alias("away_team_id"),
        F.col("awayTeam.abbrev").alias("away_team_abbrev"),
        F.col("awayTeam.commonName.default").alias("away_team_name"),
        number_field(pbp_docs, "awayTeam.score", "int").alias("away_score"),
        number_field(pbp_docs, "awayTeam.sog", "int").alias("away_sog"),
        number_field(pbp_docs, "homeTeam.id", "int").alias("home_team_id"),
        F.col("homeTeam.abbrev").alias("home_team_abbrev"),
        F.col("homeTeam.commonName.default").alias("home_team_name"),
        number_field(pbp_docs, "homeTeam.score", "int").alias("home_score"),
        number_field(pbp_docs, "homeTeam.sog", "int").alias("home_sog"),
        F.col("gameOutcome.lastPeriodType").alias("last_period_type"),
        number_field(pbp_docs, "regPeriods", "bigint").alias("reg_periods"),
        F.col("otInUse").alias("ot_in_use"),
        F.col("shootoutInUse").alias("shootout_in_use"),
    )
    return typed.select(
        "*",
        (F.col("away_score") > F.col("home_score")).alias("away_win"),
        (F.col("home_score") > F.col("away_score")).alias("home_win"),
        F.abs(F.col("home_score") - F.col("away_score")).alias("goal_diff"),
    )


# Output columns of the plays table, in order.
PLAYS_COLUMNS = [
    "game_id", "event_id", "period", "period_type", "time_in_period", "time_remaining",
    "event_type", "sort_order", "situation_code", "details",
]


def stg_plays(pbp_docs: DataFrame) -> DataFrame:
    """One row per play; ``game_id`` from the path, ``details`` as VARIANT.

    A game with an empty or missing ``plays`` list gives no row.
    """
    raw = pbp_docs.select(
        path_key(2).cast("int").alias("game_id"),
        F.explode("plays").alias("play"),
    )
    return raw.select(
        "game_id",
        number_field(raw, "play.eventId", "int").alias("event_id"),
        number_field(raw, "play.periodDescriptor.number", "int").alias("period"),
        F.col("play.periodDescriptor.periodType").alias("period_type"),
        F.col("play.timeInPeriod").alias("time_in_period"),
        F.col("play.timeRemaining").alias("time_remaining"),
        F.col("play.typeDescKey").alias("event_type"),
        number_field(raw, "play.sortOrder", "int").alias("sort_order"),
        F.col("play.situationCode").alias("situation_code"),
        F.col("play.details").alias("details"),
    )


def stg_players(players_history: DataFrame) -> DataFrame:
    """Current players: the latest snapshot per ``player_id`` (ties kept)."""
    return latest_per_key(players_history, "player_id", "snapshot_date")


def stg_standings(standings_history: DataFrame) -> DataFrame:
    """Current standings: the latest snapshot per ``team_abbrev`` (ties kept)."""
    return latest_per_key(standings_history, "team_abbrev", "snapshot_date")


