"""Time the whole pipeline (JSON -> staging -> marts -> data tests) on a
generated season-sized store in a fresh temporary folder.

    python tools/time_build.py [games] [plays_per_game] [days]

Prints one JSON line with the store size and the seconds per build step.
The store is generated, so this is a timing aid, not a correctness check.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    games = int(sys.argv[1]) if len(sys.argv) > 1 else 1312
    plays = int(sys.argv[2]) if len(sys.argv) > 2 else 320
    days = int(sys.argv[3]) if len(sys.argv) > 3 else 60
    from snapmart.plans import build as B
    from snapmart.plans.quality import invariants, run_suite
    from snapmart.session import build_session
    from tests.season_fixture import write_season

    scratch = tempfile.mkdtemp(prefix="snapmart-season-")
    raw, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    t0 = time.perf_counter()
    size = write_season(raw, games, plays, days)
    gen = time.perf_counter() - t0

    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=2 * cpus, driver_memory="16g")
    steps: dict[str, float] = {}

    def step(name, fn):
        t = time.perf_counter()
        out = fn()
        steps[name] = round(time.perf_counter() - t, 3)
        return out

    models = step("build", lambda: B.build(spark, raw, wh, as_of="2026-06-30"))
    step("data_tests", lambda: run_suite(models).collect())
    step("invariants", lambda: invariants(models).collect())
    counts = {k: models[k].count() for k in ("stg_plays", "fct_plays", "dim_players", "stg_players_history")}
    print(json.dumps({"store": size, "generate_sec": round(gen, 2), "steps_sec": steps,
                      "rows": counts, "scratch": scratch}))
    spark.stop()


if __name__ == "__main__":
    main()
