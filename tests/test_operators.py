"""Operator invariants, checked against brute force and in executed plans."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from snapmart.functions import scalar as X
from snapmart.operators.checks import null_counts
from snapmart.operators.joins import left_lookup, role_join
from snapmart.operators.latest import latest_overall, latest_per_key
from snapmart.operators.ordering import top_k
from snapmart.operators.unnest import unnest_tagged


def final_plan(df) -> str:
    """Executed (adaptive, final) plan text of ``df`` after running it."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def brute_latest(rows):
    best = {}
    for k, d, _ in rows:
        if k is not None and d is not None:
            best[k] = max(best.get(k, d), d)
    return sorted(r for r in rows if r[0] is not None and r[1] is not None and best.get(r[0]) == r[1])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_latest_per_key_equals_self_join(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        k = rng.choice([None, 1, 2, 3, 4, 5, 6, 7])
        d = rng.choice([None, 1, 2, 3, 3, 4])          # repeated dates make ties
        rows.append((k, d, i))
    df = spark.createDataFrame(rows, "k int, d int, v int")
    got = sorted(tuple(r) for r in latest_per_key(df, "k", "d").collect())
    assert got == brute_latest(rows)


def test_latest_overall(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 7), (4, None)], "v int, d int")
    assert sorted(r.v for r in latest_overall(df, "d").collect()) == [2, 3]


def test_unnest_tagged_null_branch_keeps_others(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b"], None), (2, [], ["c"]), (3, None, None)],
        "id int, xs array<string>, ys array<string>",
    )
    out = unnest_tagged(df, [("x", F.col("xs")), ("y", F.col("ys"))], "item", "tag", keep=["id"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "x"), (1, "b", "x"), (2, "c", "y")]


def test_top_k_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "a")], "id int, t string")
    assert [r.id for r in top_k(df, 3, "t").collect()] == [3, 2, 1]
    assert [r.id for r in top_k(df, 3, ("t", "desc")).collect()] == [2, 3, 1]


def test_null_counts_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.column_name: r.n_null for r in null_counts(df, ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 2}


def test_scalar_semantics(spark):
    df = spark.createDataFrame([(12.5, 13.5, 4.0005, "a/b/c")], "x double, y double, r double, p string")
    r = df.select(
        X.int_half_even("x").alias("x"), X.int_half_even("y").alias("y"),
        X.round_scaled(F.col("r"), 3).alias("r"),
        X.split_part("p", "/", 5).alias("beyond"), X.path_part("p", 2).alias("folder"),
        X.year_crossings(F.lit("2000-12-31").cast("date"), F.lit("2001-01-01").cast("date")).alias("age"),
    ).first()
    assert (r.x, r.y, r.r, r.beyond, r.folder, r.age) == (12, 14, 4.0, "", "b", 1)


def test_role_join_broadcasts_once_and_reuses(spark):
    dim = spark.range(100).select(F.col("id").alias("pid"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    fact = spark.range(1000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 100).alias("a"),
        F.when(F.col("id") % 5 == 0, F.col("id") % 100).alias("b"),
        (F.col("id") % 7).alias("c"),
    )
    out = role_join(fact, dim, "pid", "name", [("a", "a_name"), ("b", "b_name"), ("c", "c_name")])
    plan = final_plan(out)
    assert plan.count("BroadcastHashJoin") >= 3
    assert "ReusedExchange" in plan
    assert "SortMergeJoin" not in plan
    assert out.count() == 1000
    assert out.where("a is null and a_name is not null").count() == 0


def test_unbounded_dimension_is_not_broadcast_and_skew_is_split(spark):
    n = 60000
    # A third of the fact keys are NULL and a third are one hot key.
    fact = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(None))
        .when(F.col("id") % 3 == 1, F.lit(7))
        .otherwise(F.col("id") % 5000).cast("bigint").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    dim = spark.range(5000).select(F.col("id").alias("dk"), F.col("id").cast("string").alias("name"))
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16",
        },
    ):
        out = left_lookup(fact, dim, "k", "dk", {"name": "name"})
        plan = final_plan(out)
        assert "SortMergeJoin(skew=true)" in plan
        assert out.count() == n
        assert out.where("k is null").where("name is not null").count() == 0
        assert out.where("k = 7").where("name = '7'").count() == fact.where("k = 7").count()


def test_partition_sizing_and_store_conf():
    from snapmart.session import scale_conf, shuffle_partitions_for
    from snapmart.sources.documents import object_store_conf

    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(30 * 1024**4) == 30 * 1024**4 // (128 * 1024**2)
    assert scale_conf(1024**4)["spark.sql.shuffle.partitions"] == "8192"
    c = object_store_conf("http://store:9000", "k", "s")
    assert c["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert c["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert c["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"


def _canon(rows):
    return sorted(tuple(rows), key=lambda t: tuple("" if x is None else str(x) for x in t))


@pytest.mark.parametrize("seed", [5, 6])
def test_role_join_by_id_sets_equals_chained_left_joins(spark, seed):
    from snapmart.operators.joins import role_join_by_id_sets

    rng = random.Random(seed)
    dim_rows = [(k, f"n{k}") for k in range(1, 30)] + [(3, "n3b"), (7, "n7b"), (7, "n7c")]
    fact_rows = [
        (i, rng.choice([None, None, 1, 3, 7, 50]), rng.choice([None, 2, 3, 7]), rng.choice([None, 7, 99]))
        for i in range(300)
    ]
    dim = spark.createDataFrame(dim_rows, "pid int, name string")
    fact = spark.createDataFrame(fact_rows, "rk int, a int, b int, c int")
    roles = [("a", "a_name"), ("b", "b_name"), ("c", "c_name")]
    out = role_join_by_id_sets(fact, dim, "pid", "name", roles)
    got = [tuple(r) for r in out.select("rk", "a", "b", "c", "a_name", "b_name", "c_name").collect()]
    names = {}
    for k, v in dim_rows:
        names.setdefault(k, []).append(v)

    def matches(x):
        return names.get(x, [None]) if x is not None else [None]

    want = [
        (rk, a, b, c, an, bn, cn)
        for rk, a, b, c in fact_rows
        for an in matches(a) for bn in matches(b) for cn in matches(c)
    ]
    assert _canon(got) == _canon(want)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_both_role_plans_give_the_same_rows(spark, seed):
    """Repeated keys, NULL names, fractional ids and rows without any id."""
    rng = random.Random(seed)
    dim_rows = [(rng.randrange(12), rng.choice([None, "x", "y", "z"])) for _ in range(40)] + [(None, "never")]
    fact_rows = [
        (i, rng.choice([None, None, 1.0, 2.5, 3.0, 50.0]), rng.choice([None, None, 2, 3, 99]), rng.choice([None, "4", "7"]))
        for i in range(200)
    ]
    dim = spark.createDataFrame(dim_rows, "pid int, name string")
    fact = spark.createDataFrame(fact_rows, "rk int, a double, b bigint, c string")
    roles = [("a", "a_name"), ("b", "b_name"), ("c", "c_name")]
    one = role_join(fact, dim, "pid", "name", roles)
    two = role_join(fact, dim, "pid", "name", roles, by_id_sets=True)
    assert one.columns == two.columns
    assert _canon(map(tuple, one.collect())) == _canon(map(tuple, two.collect()))
    names = {}
    for k, v in dim_rows:
        names.setdefault(k, []).append(v)
    copies = lambda x: 1 if x is None else len(names.get(int(x), [0])) if float(x).is_integer() else 1
    assert two.count() == sum(copies(a) * copies(b) * copies(c) for _, a, b, c in fact_rows)


def test_building_a_join_starts_no_job(spark):
    from snapmart.plans.proofs import QUERIES
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "frames only")
    for name in ("q_fact_star", "q_role_joins_many", "q_role_joins_past_bound", "q_join_widening",
                 "q_model_fct_plays", "q_model_fct_plays_past_bound"):
        QUERIES[name](spark, "/root/testdata/sf0.001").schema
    # Reading a Parquet footer for the schema is the only job Spark starts itself.
    jobs = [j for j in tracker.getJobIdsForGroup("building")]
    stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
    assert all((tracker.getStageInfo(s) is None) or tracker.getStageInfo(s).name.startswith("parquet at") for s in stages)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_latest_per_key_splits_a_hot_key(spark):
    n = 60000
    # A third of all rows belong to key 0, all on its latest date (ties).
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 4000).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 50).alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16",
        },
    ):
        out = latest_per_key(df, "k", "d")
        plan = final_plan(out)
        assert "SortMergeJoin(skew=true)" in plan and "LeftSemi" in plan
        assert "Window" not in plan
        rows = [(r.k, r.d) for r in df.select("k", "d").collect()]
        best = {}
        for k, d in rows:
            best[k] = max(best.get(k, d), d)
        assert out.count() == sum(1 for k, d in rows if best[k] == d)
        assert out.where("k = 0").count() == n // 3


def test_role_join_by_id_sets_splits_the_all_null_tuple(spark):
    from snapmart.operators.joins import role_join_by_id_sets

    n = 60000
    # Most rows have no role id at all: the all-NULL tuple is a hot join key.
    fact = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 1, F.col("id") % 500).alias("a"),
        F.when(F.col("id") % 3 == 2, F.col("id") % 700).alias("b"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    dim = spark.range(600).select(F.col("id").alias("pid"), F.col("id").cast("string").alias("name"))
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16",
        },
    ):
        out = role_join_by_id_sets(fact, dim, "pid", "name", [("a", "a_name"), ("b", "b_name")])
        plan = final_plan(out)
        # Rows without ids are spread by their own hash: nothing is left to split.
        assert "SortMergeJoin" in plan and "skew=true" not in plan
        assert out.count() == n
        assert out.where("a is null and b is null and (a_name is not null or b_name is not null)").count() == 0
        assert out.where("a is not null and a < 600").where("a_name is null").count() == 0
        assert out.where("b >= 600").where("b_name is not null").count() == 0


@pytest.mark.parametrize("seed", [21, 22])
def test_unnest_tagged_and_top_k_against_python(spark, seed):
    rng = random.Random(seed)

    def lst():
        r = rng.random()
        if r < 0.15:
            return None
        if r < 0.3:
            return []
        return [rng.choice(["a", "b", None, "c"]) for _ in range(rng.randint(1, 4))]

    rows = [(i, lst(), lst(), lst()) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x array<string>, y array<string>, z array<string>")
    out = unnest_tagged(df, [("x", F.col("x")), ("y", F.col("y")), ("z", F.col("z"))],
                        "item", "tag", keep=["id"])
    want = [(i, v, t) for i, *ls in rows for t, l in zip("xyz", ls) for v in (l or [])]
    assert _canon([tuple(r) for r in out.collect()]) == _canon(want)

    vals = [(i, rng.choice([None, 1, 2, 2, 3, 5, 8])) for i in range(300)]
    tdf = spark.createDataFrame(vals, "id int, v int")
    asc = [(v, i) for i, v in sorted(vals, key=lambda p: (p[1] is None, p[1] if p[1] is not None else 0, p[0]))][:40]
    got = [(r.v, r.id) for r in top_k(tdf, 40, "v", "id").collect()]
    assert got == asc
    desc = [(v, i) for i, v in sorted(vals, key=lambda p: (p[1] is None, -(p[1] or 0), p[0]))][:40]
    got = [(r.v, r.id) for r in top_k(tdf, 40, ("v", "desc"), "id").collect()]
    assert got == desc
