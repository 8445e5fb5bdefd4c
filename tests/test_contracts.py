"""The driver's contracts: bench.py's one JSON line and __spark_entry__."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(sf_small):
    env = dict(os.environ, BENCH_SF_DIR=sf_small, BENCH_RUNS="1",
               BENCH_QUERIES="q_case_group,q_fact_star", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
        text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and "metric" in d
    assert set(d["queries"]) == {"q_case_group", "q_fact_star"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-3


def test_entry_contract(spark):
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    core = {n for n in q if n.startswith("q_")}
    assert core == {n for n in o if n.startswith("q_")} and len(core) >= 60 and set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip().lower().startswith(("select", "with")) for s in o.values())
    df = e.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                          "order_date", "customer_name", "supplier_name", "customer_nation",
                          "supplier_nation"]


def test_command_line_build_test_report(tmp_path):
    from .docs_fixture import write_store

    raw = write_store(str(tmp_path / "raw"))
    wh = str(tmp_path / "wh")

    def run(*args, check=True):
        return subprocess.run(
            [sys.executable, "-m", "snapmart", "--master", "local[2]", *args], cwd=ROOT,
            capture_output=True, text=True, timeout=600, check=check,
        )

    out = run("build", "--raw-root", raw, "--warehouse", wh, "--as-of", "2026-06-30").stdout
    assert "fct_plays: 12 rows" in out
    res = run("test", "--warehouse", wh, "--show-failures", check=False)
    assert res.returncode == 1                      # the fixture's edge rows fail some tests
    assert "25 passed, 12 failed" in res.stdout
    assert "weird-event" in res.stdout              # a failing accepted_values row
    rep = run("report", "--warehouse", wh, "unknown_event_types").stdout
    assert "weird-event" in rep


def test_plans_doc_lists_every_registered_query():
    import re

    import __spark_entry__ as e

    with open(os.path.join(ROOT, "PLANS.md"), encoding="utf-8") as f:
        listed = set(re.findall(r"^(q_\w+):", f.read(), flags=re.M))
    # The training-data operators are described in the README.
    assert listed == {n for n in e.queries() if n.startswith("q_")}
