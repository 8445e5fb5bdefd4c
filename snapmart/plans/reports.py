"""The eleven ad-hoc reports over the built models, as DataFrames.

Where the reference's ORDER BY ... LIMIT can tie, a row key is added as the
last sort key so every run returns the same rows. NULLs sort last in both
directions, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import concat_strict, round_scaled, text
from ..operators.aggregates import count_by, filtered_counts
from ..operators.ordering import order_by, top_k

# The event types the last report treats as known.
KNOWN_EVENT_TYPES = [
    "goal", "shot-on-goal", "missed-shot", "blocked-shot",
    "hit", "faceoff", "giveaway", "takeaway", "penalty",
    "stoppage", "period-start", "period-end", "game-end",
    "delayed-penalty",
]


def newest_games(stg_games: DataFrame) -> DataFrame:
    """B1: ten newest games."""
    g = stg_games.select(
        "game_id", "game_date", "away_team_abbrev", "away_score", "home_score",
        "home_team_abbrev", "last_period_type", "game_state",
    )
    return top_k(g, 10, ("game_date", "desc"), "game_id")


def game_summary(stg_games: DataFrame) -> DataFrame:
    """B2: count, date range, games by last period type."""
    lpt = F.col("last_period_type")
    return filtered_counts(
        stg_games, [], "total_games",
        {"reg": lpt == "REG", "ot": lpt == "OT", "so": lpt == "SO"},
        extra=[F.min("game_date").alias("earliest_game"), F.max("game_date").alias("latest_game")],
    ).select("total_games", "earliest_game", "latest_game", "reg", "ot", "so")


def event_type_breakdown(stg_plays: DataFrame) -> DataFrame:
    """Plays by type, and by period 1-3."""
    p = F.col("period")
    res = filtered_counts(
        stg_plays, ["event_type"], "total_events", {"p1": p == 1, "p2": p == 2, "p3": p == 3}
    )
    return order_by(res, ("total_events", "desc"), "event_type")


def player_history_sample(stg_players_history: DataFrame) -> DataFrame:
    """Twenty history rows, newest snapshot first."""
    h = stg_players_history.select(
        "player_id", "team_abbrev", "snapshot_date", "full_name", "position_code",
        "player_group", "sweater_number",
    )
    return top_k(h, 20, ("snapshot_date", "desc"), "team_abbrev", "full_name", "player_id")


def snapshot_summary(stg_players_history: DataFrame) -> DataFrame:
    """Players per snapshot date and team."""
    res = count_by(stg_players_history, ["snapshot_date", "team_abbrev"], "player_count")
    return top_k(res, 20, ("snapshot_date", "desc"), "team_abbrev")


def current_players_sample(stg_players: DataFrame) -> DataFrame:
    """Twenty current players by team and name."""
    p = stg_players.select(
        "player_id", "team_abbrev", "full_name", "position_code", "sweater_number", "birth_country"
    )
    return top_k(p, 20, "team_abbrev", "full_name", "player_id")


def current_standings(stg_standings: DataFrame) -> DataFrame:
    """The standings table, pct rounded to 3 digits, streak as text."""
    s = stg_standings.select(
        "league_rank", "team_abbrev", "team_name", "conference_abbrev", "division_abbrev",
        "games_played", "wins", "losses", "ot_losses", "points",
        round_scaled(F.col("point_pct"), 3).alias("point_pct"),
        "goal_differential",
        concat_strict("streak_code", text(F.col("streak_count"))).alias("streak"),
    )
    return order_by(s, "league_rank", "team_abbrev")


def teams_per_snapshot(stg_standings_history: DataFrame) -> DataFrame:
    """Teams per snapshot date, newest first."""
    return order_by(count_by(stg_standings_history, ["snapshot_date"], "teams"), ("snapshot_date", "desc"))


def fact_breakdown(fct_plays: DataFrame) -> DataFrame:
    """Fact rows by event type."""
    return order_by(count_by(fct_plays, ["event_type"], "total"), ("total", "desc"), "event_type")


def first_goals(fct_plays: DataFrame) -> DataFrame:
    """First ten goals in game order (the filter reaches the scan)."""
    g = fct_plays.where(F.col("event_type") == "goal").select(
        "game_date", "game_id", "sort_order", "home_team_abbrev", "away_team_abbrev",
        "period", "time_in_period", "scoring_player_name", "assist1_player_name",
        "assist2_player_name", "goalie_player_name", "shot_type",
        "home_score_at_goal", "away_score_at_goal",
    )
    return top_k(g, 10, "game_date", "game_id", "sort_order").drop("game_id", "sort_order")


def unknown_event_types(stg_plays: DataFrame) -> DataFrame:
    """Event types off the known list; NULL is dropped by NOT IN."""
    return (
        stg_plays.select("event_type")
        .where(~F.col("event_type").isin(KNOWN_EVENT_TYPES))
        .distinct()
    )


REPORTS = {
    "newest_games": ("stg_games", newest_games),
    "game_summary": ("stg_games", game_summary),
    "event_type_breakdown": ("stg_plays", event_type_breakdown),
    "player_history_sample": ("stg_players_history", player_history_sample),
    "snapshot_summary": ("stg_players_history", snapshot_summary),
    "current_players_sample": ("stg_players", current_players_sample),
    "current_standings": ("stg_standings", current_standings),
    "teams_per_snapshot": ("stg_standings_history", teams_per_snapshot),
    "fact_breakdown": ("fct_plays", fact_breakdown),
    "first_goals": ("fct_plays", first_goals),
    "unknown_event_types": ("stg_plays", unknown_event_types),
}


def run_report(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    model, fn = REPORTS[name]
    return fn(tables[model])
