"""A season-sized raw store for timing the pipeline (generated, not committed).

32 teams, daily standings and rosters over ``days`` days, ``games`` game
documents with ``plays_per_game`` plays each; players move between teams now
and then, so the history has real latest-per-key work. Deterministic for a
seed.
"""

from __future__ import annotations

import json
import os
import random

EVENTS = ["faceoff", "shot-on-goal", "missed-shot", "blocked-shot", "hit", "giveaway",
          "takeaway", "goal", "penalty", "stoppage"]


def _w(root, rel, doc):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f)


def write_season(root: str, games: int = 1312, plays_per_game: int = 320, days: int = 60,
                 seed: int = 7) -> dict:
    rng = random.Random(seed)
    teams = [f"T{i:02d}" for i in range(32)]
    conf = {t: ("Eastern" if i < 16 else "Western") for i, t in enumerate(teams)}
    div = {t: ["Atlantic", "Metropolitan", "Central", "Pacific"][i // 8] for i, t in enumerate(teams)}
    players = {}
    roster = {t: [] for t in teams}
    pid = 8470000
    for t in teams:
        for j in range(26):
            pos = "G" if j < 2 else ("D" if j < 10 else rng.choice("CLR"))
            players[pid] = dict(
                id=pid, firstName={"default": f"F{pid}"}, lastName={"default": f"L{pid}"},
                sweaterNumber=j + 1, positionCode=pos, shootsCatches=rng.choice("LR"),
                heightInInches=rng.randint(68, 79), weightInPounds=rng.randint(170, 235),
                birthDate=f"{rng.randint(1988, 2005)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}",
                birthCity={"default": "City"}, birthCountry="CAN", headshot=f"https://img/{pid}.png",
            )
            roster[t].append(pid)
            pid += 1
    dates = [f"2024-{10 + d // 30:02d}-{d % 30 + 1:02d}" for d in range(days)]
    for d in dates:
        # a trade now and then
        a, b = rng.sample(teams, 2)
        if roster[a] and roster[b]:
            pa, pb = rng.choice(roster[a]), rng.choice(roster[b])
            roster[a].remove(pa), roster[b].remove(pb)
            roster[a].append(pb), roster[b].append(pa)
        for t in teams:
            groups = {"forwards": [], "defensemen": [], "goalies": []}
            for p in roster[t]:
                key = {"G": "goalies", "D": "defensemen"}.get(players[p]["positionCode"], "forwards")
                groups[key].append(players[p])
            _w(root, f"rosters/{t}/{d}/roster.json", groups)
        _w(root, f"standings/{d}/standings.json", {"standings": [
            {"teamAbbrev": {"default": t}, "seasonId": 20242025, "teamName": {"default": t},
             "teamCommonName": {"default": t}, "conferenceName": conf[t], "conferenceAbbrev": conf[t][0],
             "divisionName": div[t], "divisionAbbrev": div[t][0], "leagueSequence": i + 1,
             "conferenceSequence": i % 16 + 1, "divisionSequence": i % 8 + 1, "gamesPlayed": 10,
             "wins": 5, "losses": 4, "otLosses": 1, "points": 11, "pointPctg": rng.random(),
             "goalFor": 30, "goalAgainst": 28, "goalDifferential": 2, "streakCode": "W", "streakCount": 1,
             "teamLogo": f"https://logo/{t}.svg"}
            for i, t in enumerate(teams)]})
    for g in range(games):
        home, away = rng.sample(teams, 2)
        gid = 2024020001 + g
        plays = []
        for e in range(plays_per_game):
            kind = rng.choice(EVENTS)
            shooter, other = rng.choice(roster[home]), rng.choice(roster[away])
            det = {"eventOwnerTeamId": 1, "xCoord": rng.randint(-99, 99), "yCoord": rng.randint(-42, 42),
                   "zoneCode": rng.choice("ODN")}
            if kind == "goal":
                det.update(scoringPlayerId=shooter, assist1PlayerId=rng.choice(roster[home]),
                           goalieInNetId=roster[away][0], shotType="wrist", awayScore=0, homeScore=1,
                           scoringPlayerTotal=1, assist1PlayerTotal=1)
            elif kind in ("shot-on-goal", "missed-shot"):
                det.update(shootingPlayerId=shooter, goalieInNetId=roster[away][0], shotType="snap")
            elif kind == "blocked-shot":
                det.update(shootingPlayerId=shooter, blockingPlayerId=other)
            elif kind == "faceoff":
                det.update(winningPlayerId=shooter, losingPlayerId=other)
            elif kind == "hit":
                det.update(hittingPlayerId=shooter, hitteePlayerId=other)
            elif kind in ("giveaway", "takeaway"):
                det.update(playerId=shooter)
            elif kind == "penalty":
                det.update(committedByPlayerId=shooter, drawnByPlayerId=other, descKey="hooking", duration=2)
            play = {"eventId": e + 1, "periodDescriptor": {"number": e * 3 // plays_per_game + 1,
                                                           "periodType": "REG"},
                    "timeInPeriod": "05:00", "timeRemaining": "15:00", "situationCode": "1551",
                    "typeDescKey": kind, "sortOrder": (e + 1) * 10}
            if kind != "stoppage":
                play["details"] = det
            plays.append(play)
        _w(root, f"play-by-play/{gid}/play-by-play.json", {
            "id": gid, "season": 20242025, "gameType": 2, "gameDate": dates[g % days],
            "startTimeUTC": f"{dates[g % days]}T23:00:00Z", "gameState": "OFF",
            "gameScheduleState": "OK", "venue": {"default": "Arena"},
            "awayTeam": {"id": 2, "abbrev": away, "commonName": {"default": away}, "score": 2, "sog": 30},
            "homeTeam": {"id": 1, "abbrev": home, "commonName": {"default": home}, "score": 3, "sog": 31},
            "gameOutcome": {"lastPeriodType": "REG"}, "regPeriods": 3, "otInUse": True,
            "shootoutInUse": True, "plays": plays,
        })
    return {"games": games, "plays": games * plays_per_game, "roster_files": days * len(teams),
            "players": len(players)}
