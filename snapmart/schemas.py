"""Explicit read schemas for the four raw document kinds (Spark DDL).

Declaring the schema means no inference pass over the data, a key absent
from every file reads as NULL instead of failing to bind. Numbers are read
as their text, so that ``84``, ``84.0`` and ``"84"`` all reach the models'
casts, which fail on a text that is no number. Only fields the models read are declared, so nested
columns below the exploded arrays are pruned at the scan.
"""

from __future__ import annotations

_NAME = "STRUCT<default STRING>"

STANDINGS = (
    "standings ARRAY<STRUCT<"
    f"teamAbbrev {_NAME}, seasonId STRING, teamName {_NAME}, teamCommonName {_NAME}, "
    "conferenceName STRING, conferenceAbbrev STRING, divisionName STRING, divisionAbbrev STRING, "
    "leagueSequence STRING, conferenceSequence STRING, divisionSequence STRING, "
    "gamesPlayed STRING, wins STRING, losses STRING, otLosses STRING, points STRING, pointPctg STRING, "
    "regulationWins STRING, regulationPlusOtWins STRING, goalFor STRING, goalAgainst STRING, goalDifferential STRING, "
    "homeWins STRING, homeLosses STRING, homeOtLosses STRING, homePoints STRING, "
    "roadWins STRING, roadLosses STRING, roadOtLosses STRING, roadPoints STRING, "
    "l10Wins STRING, l10Losses STRING, l10OtLosses STRING, l10Points STRING, "
    "streakCode STRING, streakCount STRING, wildcardSequence STRING, teamLogo STRING>>"
)

PLAYER = (
    f"STRUCT<id STRING, firstName {_NAME}, lastName {_NAME}, sweaterNumber STRING, "
    "positionCode STRING, shootsCatches STRING, heightInInches STRING, weightInPounds STRING, "
    f"birthDate STRING, birthCity {_NAME}, birthCountry STRING, headshot STRING>"
)

ROSTER = f"forwards ARRAY<{PLAYER}>, defensemen ARRAY<{PLAYER}>, goalies ARRAY<{PLAYER}>"

_TEAM = f"STRUCT<id STRING, abbrev STRING, commonName {_NAME}, score STRING, sog STRING>"

PLAY = (
    "STRUCT<eventId STRING, periodDescriptor STRUCT<number STRING, periodType STRING>, "
    "timeInPeriod STRING, timeRemaining STRING, situationCode STRING, "
    "typeDescKey STRING, sortOrder STRING, details VARIANT>"
)

PLAY_BY_PLAY = (
    "id STRING, season STRING, gameType STRING, gameDate STRING, startTimeUTC STRING, "
    "gameState STRING, gameScheduleState STRING, "
    f"venue {_NAME}, venueLocation {_NAME}, awayTeam {_TEAM}, homeTeam {_TEAM}, "
    "gameOutcome STRUCT<lastPeriodType STRING>, "
    "regPeriods STRING, otInUse BOOLEAN, shootoutInUse BOOLEAN, "
    f"plays ARRAY<{PLAY}>"
)

SCHEDULE = "games ARRAY<STRUCT<id STRING, gameState STRING, gameDate STRING, gameType STRING>>"

# Relative layout of the raw store (fixed values: the landing paths).
LAYOUT = {
    "standings": "standings/*/standings.json",
    "rosters": "rosters/*/*/roster.json",
    "play_by_play": "play-by-play/*/play-by-play.json",
    "schedules": "schedules/*/schedule.json",
}

DOC_SCHEMAS = {
    "standings": STANDINGS,
    "rosters": ROSTER,
    "play_by_play": PLAY_BY_PLAY,
    "schedules": SCHEDULE,
}
