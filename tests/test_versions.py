"""Versioned tables: atomic rebuilds, conflicts, collected versions; shredded VARIANT columns."""

import os

import pytest

from snapmart.plans import marts, standins
from snapmart.sources import versions
from snapmart.sources.materialize import read_if_built, read_table, table_path, write_table


def rows(df):
    return sorted(r.n for r in df.collect())


def test_a_rebuild_that_is_killed_leaves_the_old_table(spark, scratch, monkeypatch):
    write_table(spark.range(3).selectExpr("id as n"), scratch, "t")
    broken = spark.range(5).selectExpr("if(id = 4, raise_error('killed'), id) as n").selectExpr("cast(n as bigint) as n")
    with pytest.raises(Exception, match="killed"):
        write_table(broken, scratch, "t")
    assert rows(read_table(spark, scratch, "t")) == [0, 1, 2]
    # Killed after the files are written, before they are published.
    monkeypatch.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        write_table(spark.range(9).selectExpr("id as n"), scratch, "t")
    monkeypatch.undo()
    assert rows(read_table(spark, scratch, "t")) == [0, 1, 2]
    # Killed while the manifest is written: an unfinished one is not followed.
    with open(os.path.join(scratch, "t", versions.VERSIONS, f"{2:012d}.json"), "w") as f:
        f.write('{"folders": ["da')
    assert rows(read_table(spark, scratch, "t")) == [0, 1, 2]
    write_table(spark.range(2).selectExpr("id as n"), scratch, "t")
    assert rows(read_table(spark, scratch, "t")) == [0, 1]
    assert versions.head(spark, table_path(scratch, "t"))[0] == 3


def test_a_table_may_be_rebuilt_from_itself_and_old_versions_go(spark, scratch):
    write_table(spark.range(2).selectExpr("id as n"), scratch, "t")
    early = read_table(spark, scratch, "t")
    for _ in range(5):
        t = read_table(spark, scratch, "t")
        assert rows(early) == rows(early.limit(1000)) if versions.head(spark, table_path(scratch, "t"))[0] < 2 else True
        write_table(t.selectExpr("n + 10 as n"), scratch, "t")
    assert rows(read_table(spark, scratch, "t")) == [50, 51]
    assert len(os.listdir(os.path.join(scratch, "t", versions.DATA))) == versions.KEEP
    assert len([f for f in os.listdir(os.path.join(scratch, "t", versions.VERSIONS)) if f.endswith(".json")]) == versions.KEEP


def test_a_frame_read_before_a_rebuild_keeps_its_files(spark, scratch):
    write_table(spark.range(2).selectExpr("id as n"), scratch, "t")
    before = read_table(spark, scratch, "t")
    write_table(spark.range(7).selectExpr("id as n"), scratch, "t")
    assert rows(before) == [0, 1] and len(rows(read_table(spark, scratch, "t"))) == 7


def test_two_writers_cannot_publish_one_version(spark, scratch):
    root = table_path(scratch, "t")
    versions.publish(spark, root, {"folders": []}, 0)
    with pytest.raises(versions.VersionConflict):
        versions.publish(spark, root, {"folders": []}, 0)
    assert versions.publish(spark, root, {"folders": []}, 1) == 2


def test_plain_folders_and_absent_tables(spark, scratch):
    spark.range(3).selectExpr("id as n").write.parquet(os.path.join(scratch, "plain"))
    assert rows(read_if_built(spark, os.path.join(scratch, "plain"))) == [0, 1, 2]
    assert read_if_built(spark, os.path.join(scratch, "nothing")) is None


def test_partitions_of_a_versioned_table_are_pruned(spark, scratch):
    import contextlib
    import io

    write_table(spark.range(20).selectExpr("id as n", "id % 4 as k"), scratch, "t", partition_by=["k"])
    out = read_table(spark, scratch, "t").where("k = 2")
    assert rows(out) == [2, 6, 10, 14, 18]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    assert "PartitionFilters: [isnotnull(k" in buf.getvalue()


def test_details_are_stored_with_typed_sub_columns(spark, sf_small, scratch):
    """The scan reads only the sub-columns a query needs, and no VARIANT is rebuilt."""
    import contextlib
    import glob
    import io

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from snapmart.functions import json as J

    write_table(standins._plays_from_lineitem(spark, sf_small), scratch, "stg_plays")
    (file,) = glob.glob(f"{scratch}/stg_plays/data/*/*.parquet")
    paths = {c.path for c in map(pq.ParquetFile(file).schema.column, range(len(pq.ParquetFile(file).schema)))}
    assert {"details.typed_value.scoringPlayerId.typed_value", "details.typed_value.zoneCode.typed_value"} <= paths
    plays = read_table(spark, scratch, "stg_plays")
    d = plays.select(J.get_fields(F.col("details"), [("scoringPlayerId", "int"), ("shotType", "string")]).alias("d"))
    out = d.select(J.typed_field(F.col("d.scoringPlayerId"), "int").alias("a"), F.col("d.shotType").alias("b"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    (read,) = [x for x in buf.getvalue().splitlines() if "ReadSchema" in x]
    assert read.endswith("ReadSchema: struct<details:struct<0:double,1:string>>") and "variant_get" not in buf.getvalue()
    live = standins._plays_from_lineitem(spark, sf_small)
    want = live.select(J.get_fields(F.col("details"), [("scoringPlayerId", "int"), ("shotType", "string")]).alias("d"))
    want = want.select(J.typed_field(F.col("d.scoringPlayerId"), "int").alias("a"), F.col("d.shotType").alias("b"))
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()


def test_shredding_keeps_odd_values(spark, scratch):
    """Keys with mixed types, absent keys, nested values and no object at all read back as written."""
    texts = ['{"playerId": 1}', '{"playerId": "84"}', '{"playerId": 84.5}', '{"playerId": null, "x": {"y": [1, "a"]}}', "[1]", "7", "{}", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").selectExpr("n", "parse_json(t) as details")
    write_table(df, scratch, "odd")
    back = read_table(spark, scratch, "odd")
    text = lambda d: sorted((r.n, r.t) for r in d.selectExpr("n", "to_json(details) as t").collect() if r.t is not None)
    assert text(back) == text(df)
    from pyspark.sql import functions as F

    from snapmart.functions import json as J

    fields = [(k, t) for k, _, t in marts.DETAIL_FIELDS if k == "playerId"]
    got = back.select("n", J.get_fields(F.col("details"), fields).alias("d")).select("n", J.typed_field(F.col("d.playerId"), "int").alias("p"))
    assert {r.n: r.p for r in got.collect()} == {0: 1, 1: 84, 2: 85, 3: None, 4: None, 5: None, 6: None, 7: None}
