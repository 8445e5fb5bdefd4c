"""Mart models: ``dim_teams``, ``dim_players`` and the wide ``fct_plays``.

``fct_plays`` is one row per play: the game's context by a left join, 26
values read from the play's ``details`` (VARIANT, parsed once at read), and
a player name for 12 roles, each a left join to the same ``dim_players``.
Names come from the *current* roster, not from the roster at game time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions.scalar import height_display, height_display_floor, position_group, year_crossings
from ..operators.joins import left_lookup, role_join

# Output columns of the team dimension, in order.
DIM_TEAMS_COLUMNS = [
    "team_abbrev", "team_name", "team_common_name", "conference_name",
    "conference_abbrev", "division_name", "division_abbrev", "team_logo_url",
]


def dim_teams(stg_standings: DataFrame) -> DataFrame:
    return stg_standings.select(*DIM_TEAMS_COLUMNS)


# Player dimension columns taken over from the current view.
DIM_PLAYERS_BASE = [
    "player_id", "team_abbrev", "full_name", "first_name", "last_name", "position_code",
    "player_group", "sweater_number", "shoots_catches", "height_inches", "weight_pounds",
    "birth_date", "birth_city", "birth_country", "headshot_url",
]
# The reference's 18 columns, plus height_display_floor (survey decision D1).
DIM_PLAYERS_COLUMNS = DIM_PLAYERS_BASE + [
    "age", "position_group", "height_display", "height_display_floor",
]


def _as_of(as_of: dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def dim_players(stg_players: DataFrame, as_of: dt.date | str | Column | None = None) -> DataFrame:
    """Current players with ``age`` (New Years crossed up to ``as_of``, by
    default today), ``position_group`` and ``height_display``.

    ``height_display`` keeps the reference's half-even feet (71 inches shows
    ``6'11"``); ``height_display_floor`` beside it is the arithmetically
    right one (``5'11"``).
    """
    return stg_players.select(
        *DIM_PLAYERS_BASE,
        year_crossings("birth_date", _as_of(as_of)).alias("age"),
        position_group("position_code").alias("position_group"),
        height_display("height_inches").alias("height_display"),
        height_display_floor("height_inches").alias("height_display_floor"),
    )


# Details key -> fact column, with type, in fact order.
DETAIL_FIELDS = [
    ("eventOwnerTeamId", "event_team_id", "int"),
    ("xCoord", "x_coord", "int"),
    ("yCoord", "y_coord", "int"),
    ("zoneCode", "zone_code", "string"),
    ("shotType", "shot_type", "string"),
    ("scoringPlayerId", "scoring_player_id", "int"),
    ("assist1PlayerId", "assist1_player_id", "int"),
    ("assist2PlayerId", "assist2_player_id", "int"),
    ("scoringPlayerTotal", "scoring_player_total", "int"),
    ("assist1PlayerTotal", "assist1_player_total", "int"),
    ("assist2PlayerTotal", "assist2_player_total", "int"),
    ("awayScore", "away_score_at_goal", "int"),
    ("homeScore", "home_score_at_goal", "int"),
    ("goalieInNetId", "goalie_player_id", "int"),
    ("highlightClipSharingUrl", "highlight_url", "string"),
    ("shootingPlayerId", "shooting_player_id", "int"),
    ("blockingPlayerId", "blocking_player_id", "int"),
    ("winningPlayerId", "faceoff_winning_player_id", "int"),
    ("losingPlayerId", "faceoff_losing_player_id", "int"),
    ("hittingPlayerId", "hitting_player_id", "int"),
    ("hitteePlayerId", "hittee_player_id", "int"),
    ("committedByPlayerId", "penalty_committed_by_player_id", "int"),
    ("drawnByPlayerId", "penalty_drawn_by_player_id", "int"),
    ("descKey", "penalty_desc", "string"),
    ("duration", "penalty_duration_minutes", "int"),
    ("playerId", "player_id", "int"),
]

# Role id column -> name column, in fact order.
PLAYER_ROLES = [
    ("scoring_player_id", "scoring_player_name"),
    ("assist1_player_id", "assist1_player_name"),
    ("assist2_player_id", "assist2_player_name"),
    ("goalie_player_id", "goalie_player_name"),
    ("shooting_player_id", "shooting_player_name"),
    ("faceoff_winning_player_id", "faceoff_winning_player_name"),
    ("faceoff_losing_player_id", "faceoff_losing_player_name"),
    ("hitting_player_id", "hitting_player_name"),
    ("hittee_player_id", "hittee_player_name"),
    ("penalty_committed_by_player_id", "penalty_committed_by_player_name"),
    ("penalty_drawn_by_player_id", "penalty_drawn_by_player_name"),
    ("player_id", "player_name"),
]

# Game column -> fact column.
GAME_CONTEXT = {
    "game_date": "game_date",
    "season": "season",
    "home_team_abbrev": "home_team_abbrev",
    "away_team_abbrev": "away_team_abbrev",
    "home_score": "final_home_score",
    "away_score": "final_away_score",
    "last_period_type": "last_period_type",
}

FCT_PLAYS_COLUMNS = (
    ["game_id", "event_id", "event_type", "sort_order"]
    + list(GAME_CONTEXT.values())
    + ["period", "period_type", "time_in_period", "time_remaining", "situation_code"]
    + [name for _, name, _ in DETAIL_FIELDS]
    + [name for _, name in PLAYER_ROLES]
)


def fct_plays(
    stg_plays: DataFrame,
    stg_games: DataFrame,
    dim_players: DataFrame,
    by_id_sets: bool = False,
    stored: bool = True,
) -> DataFrame:
    """The wide play fact, 54 columns.

    * games: left join on ``game_id`` (INTEGER from the path against the
      document's BIGINT id; Spark widens).
    * details: the 26 typed values are read from the sub-columns of the
      stored VARIANT, or in one pass where ``stored`` is false and the plays are
      no stored table (:func:`snapmart.functions.json.get_fields`); absent keys
      and JSON nulls are NULL.
    * names: :func:`role_join`, one ``(player_id, full_name)`` build side
      reused by all 12 roles. ``by_id_sets=True``, for a player dimension
      known to be too large to broadcast, resolves the roles once per
      distinct tuple of role ids, so the fact is shuffled once, not twelve
      times; the rows are the same. A player listed twice on the
      latest date multiplies the play rows, exactly as the reference's
      joins do; the ``unique`` test on ``stg_players`` reports it. Games come
      first, so that a shuffle for them carries no names and parts the reading
      of the details from the twelve lookups; by id sets they come last, as the
      distinct tuples are taken from the plays alone.
    """
    plays = stg_plays.select(
        "game_id", "event_id", "event_type", "sort_order",
        "period", "period_type", "time_in_period", "time_remaining", "situation_code",
        J.get_fields(F.col("details"), [(key, t) for key, _, t in DETAIL_FIELDS], stored).alias("__d"),
    ).select(
        "game_id", "event_id", "event_type", "sort_order",
        "period", "period_type", "time_in_period", "time_remaining", "situation_code",
        *[J.typed_field(F.col("__d")[key], t, stored).alias(name) for key, name, t in DETAIL_FIELDS],
    )
    if by_id_sets:
        named = role_join(plays, dim_players, "player_id", "full_name", PLAYER_ROLES, by_id_sets)
        return left_lookup(named, stg_games, "game_id", "game_id", GAME_CONTEXT).select(*FCT_PLAYS_COLUMNS)
    in_games = left_lookup(plays, stg_games, "game_id", "game_id", GAME_CONTEXT)
    return role_join(in_games, dim_players, "player_id", "full_name", PLAYER_ROLES).select(*FCT_PLAYS_COLUMNS)
