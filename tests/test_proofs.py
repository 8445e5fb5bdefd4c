"""Every proof query against its DuckDB oracle, by value, at sf0.01."""

import pytest

from snapmart.plans.proofs import ORACLE_SQL, QUERIES

from .oracle import compare, duck


@pytest.fixture(scope="module")
def con(sf_check):
    c = duck(sf_check)
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_check, con, name):
    df = QUERIES[name](spark, sf_check)
    diff = compare(df, con, ORACLE_SQL[name])
    assert diff is None, f"{name}: {diff}"


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert "customer_nation" in df.columns
    # Queries without SQL are those of the training-data operators.
    assert set(e.oracle_sql()) <= set(e.queries())
    assert {n for n in e.queries() if n.startswith("q_")} == {n for n in e.oracle_sql() if n.startswith("q_")}


def test_fact_star_past_the_bound_plan_and_result(spark, sf_check, con):
    """With every build side past the bound (as at scale), line items are
    shuffled only on their own two keys, and the result is unchanged."""
    import contextlib
    import io
    import re

    import snapmart.plans.proofs as P

    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        df = P.q_fact_star(spark, sf_check)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        keys = set(re.findall(r"Exchange hashpartitioning\((l_\w+)#", buf.getvalue()))
        assert keys == {"l_orderkey", "l_suppkey"}
        assert "BroadcastHashJoin" not in buf.getvalue()
        assert compare(df, con, ORACLE_SQL["q_fact_star"]) is None
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
