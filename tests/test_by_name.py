"""Files with differing columns and types, read as one table by name."""

import os

import pytest
from pyspark.sql import types as T

from snapmart.sources import by_name as B


def t(ddl):
    return T._parse_datatype_string(ddl)


@pytest.mark.parametrize("a, b, want", [
    ("int", "int", "int"), ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("int", "double", "double"),
    ("float", "bigint", "double"), ("int", "string", "string"), ("decimal(10,2)", "int", "decimal(12,2)"),
    ("decimal(38,0)", "decimal(38,10)", "double"), ("decimal(5,1)", "double", "double"), ("boolean", "int", "int"),
    ("boolean", "string", "string"), ("date", "timestamp_ntz", "timestamp_ntz"), ("timestamp", "date", "timestamp"),
    ("timestamp", "int", "string"), ("void", "date", "date"), ("array<int>", "array<double>", "array<double>"),
    ("array<int>", "int", "string"), ("struct<a: int>", "struct<A: string, b: int>", "struct<a: string, b: int>"),
])
def test_common_types_both_ways(spark, a, b, want):
    assert B.common_type(t(a), t(b)).simpleString() == t(want).simpleString()
    assert B.common_type(t(b), t(a)).simpleString().lower() == t(want).simpleString()


def test_union_fills_and_casts(spark):
    one = spark.createDataFrame([(1, [1, None], (5,)), (2, None, None)], "id int, xs array<int>, s struct<p: int>")
    two = spark.createDataFrame([("x", ("q", 1.5), [0.5])], "ID string, s struct<P: string, r: double>, XS array<double>")
    three = spark.createDataFrame([(None,)], "`odd.name` int")
    rows = B.union_by_name([one, two, three]).collect()
    assert [(r.id, r.xs, None if r.s is None else tuple(r.s), r["odd.name"]) for r in rows] == [
        ("1", [1.0, None], ("5", None), None), ("2", None, None, None), ("x", [0.5], ("q", 1.5), None), (None, None, None, None)]


def test_files_with_alternating_types(spark, scratch):
    """Every file is read once, whatever the order of types along the list."""
    root = os.path.join(scratch, "files")
    want = []
    for i in range(9):
        value = [f"{i}", f"cast({i} as string)", f"{i}.5D"][i % 3]
        spark.sql(f"select {i} as id, {value} as v" + (", true as extra" if i == 4 else "")).coalesce(1).write.parquet(f"{root}/part={i}")
        want.append((i, f"{i}.5" if i % 3 == 2 else f"{i}", True if i == 4 else None))
    df = B.read_parquet_by_name(spark, root)
    assert sorted(tuple(r) for r in df.select("id", "v", "extra").collect()) == want
    paths = [p for p, _ in B.files_of(spark, root, ".parquet")]
    groups = B.schema_groups(spark, paths)
    assert sorted(p for _, g in groups for p in g) == paths and len(groups) <= 4
    assert len(B.schema_groups(spark, [p for p in paths if "part=0" in p or "part=3" in p])) == 1


def test_filters_reach_the_scans(spark, scratch):
    root = os.path.join(scratch, "files")
    spark.sql("select 1 as id, 1 as v, 'a' as w").write.parquet(f"{root}/a")
    spark.sql("select 2 as id, 'x' as v, 'b' as w").write.parquet(f"{root}/b")
    plan = B.read_parquet_by_name(spark, root).where("id = 2").select("id", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(id,2)") == 2 and "w:string" not in plan


def test_nothing_to_read(spark, scratch):
    os.makedirs(os.path.join(scratch, "none"))
    with pytest.raises(FileNotFoundError):
        B.read_parquet_by_name(spark, os.path.join(scratch, "none"))
    assert B.schema_groups(spark, []) == []
