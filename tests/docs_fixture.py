"""Small raw stores of JSON documents with the edge rows of FIXTURES.md §2.

Layout: standings/{date}/standings.json, rosters/{team}/{date}/roster.json,
play-by-play/{game}/play-by-play.json, schedules/{team}/schedule.json.
"""

from __future__ import annotations

import json
import os


def _write(root, rel, doc, indent=None):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, indent=indent)
    return path


def _team(abbrev, name, conf, div, points, rank, gp=10, pct=0.55):
    return {
        "teamAbbrev": {"default": abbrev}, "seasonId": 20242025,
        "teamName": {"default": f"{name} Club"}, "teamCommonName": {"default": name},
        "conferenceName": conf, "conferenceAbbrev": conf[0], "divisionName": div,
        "divisionAbbrev": div[0], "leagueSequence": rank, "conferenceSequence": rank,
        "divisionSequence": rank, "gamesPlayed": gp, "wins": 5, "losses": 3, "otLosses": 2,
        "points": points, "pointPctg": pct, "regulationWins": 4, "regulationPlusOtWins": 5,
        "goalFor": 30, "goalAgainst": 25, "goalDifferential": 5, "homeWins": 3,
        "homeLosses": 1, "homeOtLosses": 1, "homePoints": 7, "roadWins": 2, "roadLosses": 2,
        "roadOtLosses": 1, "roadPoints": 5, "l10Wins": 5, "l10Losses": 3, "l10OtLosses": 2,
        "l10Points": 12, "streakCode": "W", "streakCount": 2, "wildcardSequence": rank,
        "teamLogo": f"https://logo/{abbrev}.svg",
    }


def _player(pid, first, last, pos, height, birth="1995-05-05", number=None):
    return {
        "id": pid,
        "firstName": None if first is None else {"default": first},
        "lastName": {"default": last},
        "sweaterNumber": number if number is not None else pid % 100,
        "positionCode": pos, "shootsCatches": "L", "heightInInches": height,
        "weightInPounds": 190, "birthDate": birth, "birthCity": {"default": "Town"},
        "birthCountry": "CAN", "headshot": f"https://img/{pid}.png",
    }


# Players: id -> (first, last, position, height, birth date)
P = {
    1: ("Ann", "One", "C", 71, "2000-12-31"),    # E3, E11 71 -> 6'11"
    2: ("Bob", "Two", "L", 72, "1990-01-01"),    # E11 72 -> 6'0"
    3: ("Cid", "Three", "D", 65, "1995-06-15"),  # E11 65 -> 5'5"
    4: ("Dan", "Four", "G", 77, "1988-03-03"),   # E11 77 -> 6'5"
    5: ("Eve", "Five", "R", 66, "1999-09-09"),   # E1 moves AAA -> BBB; 66 -> 6'6"
    6: ("Fay", "Six", "X", 78, "1997-07-07"),    # E2 two rosters same day; E13 X
    7: ("Gus", "Seven", None, None, "1996-02-02"),  # E13 NULL pos, E11 NULL height, E21 team ZZZ
    8: (None, "Eight", "C", 70, "1994-04-04"),   # E14 NULL first name
}


def _p(pid):
    first, last, pos, height, birth = P[pid]
    return _player(pid, first, last, pos, height, birth)


def write_store(root: str) -> str:
    """The main fixture store; returns ``root``."""
    # Standings: two dates, the second pretty-printed.
    _write(root, "standings/2024-10-01/standings.json", {"standings": [
        _team("AAA", "Alphas", "Eastern", "Atlantic", 10, 1),
        _team("BBB", "Betas", "Western", "Central", 8, 2),
    ]})
    _write(root, "standings/2024-10-02/standings.json", {"standings": [
        _team("AAA", "Alphas", "Eastern", "Atlantic", 12, 1, gp=11, pct=0.5455),
        _team("BBB", "Betas", "Western", "Central", 9, 3, gp=11, pct=4.0005),
        _team("CCC", "Gammas", "Western", "Pacific", 11, 2, gp=11, pct=0.5),
    ]}, indent=2)

    # Rosters.
    _write(root, "rosters/AAA/2024-10-01/roster.json", {
        "forwards": [_p(1), _p(2), _p(5)], "defensemen": [_p(3)], "goalies": [_p(4)],
    })
    _write(root, "rosters/AAA/2024-10-02/roster.json", {   # E4 goalies: []
        "forwards": [_p(2), _p(8)], "defensemen": [_p(3)], "goalies": [],
    })
    _write(root, "rosters/BBB/2024-10-02/roster.json", {   # E4 no goalies key; E1, E2
        "forwards": [_p(5), _p(6)], "defensemen": [],
    })
    _write(root, "rosters/CCC/2024-10-02/roster.json", {   # E2
        "forwards": [_p(6)], "defensemen": [], "goalies": [],
    }, indent=4)
    _write(root, "rosters/ZZZ/2024-10-02/roster.json", {   # E21
        "forwards": [_p(7)],
    })

    # Play-by-play.
    def play(eid, kind, order, period=1, details=None, **extra):
        d = {"eventId": eid, "periodDescriptor": {"number": period, "periodType": "REG"},
             "timeInPeriod": "01:00", "timeRemaining": "19:00", "situationCode": "1551",
             "typeDescKey": kind, "sortOrder": order}
        if details is not None:
            d["details"] = details
        d.update(extra)
        return d

    game1 = {
        "id": 2024020001, "season": 20242025, "gameType": 2, "gameDate": "2024-10-08",
        "startTimeUTC": "2024-10-08T23:00:00Z", "gameState": "OFF", "gameScheduleState": "OK",
        "venue": {"default": "Arena"}, "venueLocation": {"default": "City"},
        "awayTeam": {"id": 2, "abbrev": "BBB", "commonName": {"default": "Betas"}, "score": 2, "sog": 25},
        "homeTeam": {"id": 1, "abbrev": "AAA", "commonName": {"default": "Alphas"}, "score": 3, "sog": 30},
        "gameOutcome": {"lastPeriodType": "REG"}, "regPeriods": 3, "otInUse": True,
        "plays": [
            play(1, "faceoff", 10, details={"eventOwnerTeamId": 1, "winningPlayerId": 2,
                                            "losingPlayerId": 6, "xCoord": 0, "yCoord": 0,
                                            "zoneCode": "N"}),
            play(2, "goal", 20, details={"eventOwnerTeamId": 1, "scoringPlayerId": 2,
                                         "assist1PlayerId": 3, "assist2PlayerId": 999,  # E7
                                         "goalieInNetId": 4, "scoringPlayerTotal": 1,
                                         "assist1PlayerTotal": 1, "assist2PlayerTotal": 1,
                                         "awayScore": 0, "homeScore": 1, "shotType": "wrist",
                                         "highlightClipSharingUrl": "https://clip/1",
                                         "xCoord": -70, "yCoord": 5, "zoneCode": "O"}),
            play(3, "shot-on-goal", 30, period=2, details={"shootingPlayerId": 6,  # E2
                                                           "goalieInNetId": 4}),
            play(4, "hit", 40, period=2, details={"hittingPlayerId": None,  # E8
                                                  "hitteePlayerId": 5}),
            play(5, "penalty", 50, period=3, details={"committedByPlayerId": 8,
                                                      "drawnByPlayerId": 1,
                                                      "descKey": "tripping", "duration": 2}),
            play(6, "weird-event", 60, period=3),   # E18 off both lists
            play(7, None, 70, period=3),            # E18 NULL type
            play(8, "giveaway", 80, period=3, details={"playerId": 7}),
            play(9, "period-end", 90, period=3),    # E6 no details
        ],
    }
    _write(root, "play-by-play/2024020001/play-by-play.json", game1)
    game2 = {   # E5 no plays; E10 equal scores; E16 shootoutInUse only here
        "id": 2024020002, "season": 20242025, "gameType": 2, "gameDate": "2024-10-09",
        "startTimeUTC": "2024-10-09T00:30:00Z", "gameState": "FINAL",
        "awayTeam": {"id": 3, "abbrev": "CCC", "score": 1},
        "homeTeam": {"id": 1, "abbrev": "AAA", "score": 1},
        "gameOutcome": {"lastPeriodType": "SO"}, "shootoutInUse": True, "plays": [],
    }
    _write(root, "play-by-play/2024020002/play-by-play.json", game2, indent=2)
    game3 = {   # E9 path id differs from JSON id; E10 NULL home score
        "id": 2024029999, "season": 20242025, "gameType": 3, "gameDate": "2024-10-10",
        "startTimeUTC": "2024-10-10T01:00:00Z", "gameState": "LIVE",
        "awayTeam": {"id": 2, "abbrev": "BBB", "score": 4},
        "homeTeam": {"id": 3, "abbrev": "CCC"},
        "gameOutcome": {"lastPeriodType": "OT"},
        "plays": [play(1, "goal", 5, details={"scoringPlayerId": 5})],
    }
    _write(root, "play-by-play/2024020003/play-by-play.json", game3)

    # Schedules.
    _write(root, "schedules/AAA/schedule.json", {"games": [
        {"id": 1, "gameState": "OFF", "gameDate": "2024-10-01", "gameType": 2},
        {"id": 2, "gameState": "FINAL", "gameDate": "2024-10-03", "gameType": 3},
        {"id": 3, "gameState": "LIVE", "gameDate": "2024-10-05", "gameType": 2},
        {"id": 4, "gameState": "FUT", "gameDate": "2024-12-01", "gameType": 2},
    ]})
    _write(root, "schedules/BBB/schedule.json", {"games": [
        {"id": 2, "gameState": "FINAL", "gameDate": "2024-10-03", "gameType": 3},
        {"id": 5, "gameState": "OFF", "gameDate": "2024-09-20", "gameType": 1},
    ]})
    _write(root, "schedules/CCC/schedule.json", {})
    return root


def write_bad_date_store(root: str) -> str:
    """A game date that is not a date."""
    _write(root, "play-by-play/1/play-by-play.json", {
        "id": 1, "gameDate": "not-a-date", "plays": [],
    })
    return root


def write_bad_id_store(root: str, bad_id) -> str:
    """A roster id that does not fit INTEGER."""
    doc = {"forwards": [dict(_p(1), id=bad_id)]}
    _write(root, "rosters/AAA/2024-10-01/roster.json", doc)
    return root
