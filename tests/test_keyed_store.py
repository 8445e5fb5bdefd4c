"""The store by key: appends, replacements, conflicts, skew, and the exactly-once stream."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from snapmart.sources import keyed_store as K
from snapmart.sources import versions
from snapmart.streaming import incremental


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, day int, source_path string, v double")


def held(spark, root):
    return sorted(tuple(r) for r in K.read_keyed(spark, root).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_appends_and_replacements_against_a_dict(spark, scratch, seed):
    rnd = random.Random(seed)
    root, want = os.path.join(scratch, "s"), {}

    def rows(n):
        return [(rnd.choice(["a", "b", "c", "dé", "e", ""]), rnd.randrange(6), f"p{i:03d}", rnd.random()) for i in range(n)]

    for step in range(6):
        batch = rows(rnd.choice([1, 5, 20]))
        if step % 2 == 0:
            counts = K.append_unseen(frame(spark, batch), root, ["k", "day"], n_buckets=8)
            new = {}
            for r in sorted(batch, key=lambda r: r[2]):
                if (r[0], r[1]) not in want:
                    new[r[0], r[1]] = [r]
            want |= new
            assert counts == {"new": len(new), "skipped": len(batch) - len(new), "failed": 0}
        else:
            K.replace_keys(frame(spark, batch), root, ["k", "day"], n_buckets=8)
            for key in {(r[0], r[1]) for r in batch}:
                want[key] = [r for r in batch if (r[0], r[1]) == key]
        assert held(spark, root) == sorted(r for rs in want.values() for r in rs)


def test_null_keys(spark, scratch):
    root = os.path.join(scratch, "s")
    assert K.append_unseen(frame(spark, [("a", 1, "p", 1.0), (None, 1, "q", 1.0)]), root, ["k"]) == {"new": 1, "skipped": 0, "failed": 1}
    K.replace_keys(frame(spark, [(None, 1, "x", 1.0)]), root, ["k"])
    K.replace_keys(frame(spark, [(None, 2, "y", 1.0), (None, 3, "z", 1.0)]), root, ["k"])
    assert sorted(r.source_path for r in K.read_keyed(spark, root).collect()) == ["p", "y", "z"]


def test_empty_batches_and_other_schemas(spark, scratch):
    root = os.path.join(scratch, "s")
    assert K.append_unseen(frame(spark, []), root, ["k"]) == {"new": 0, "skipped": 0, "failed": 0}
    assert K.read_keyed(spark, root) is None
    K.replace_keys(frame(spark, []), root, ["k"])
    K.append_unseen(frame(spark, [("a", 1, "p", 1.0)]), root, ["k"])
    with pytest.raises(ValueError, match="holds"):
        K.append_unseen(spark.createDataFrame([("a", "p")], "k string, source_path string"), root, ["k"])


def test_many_keys_share_a_fixed_number_of_folders(spark, scratch):
    root = os.path.join(scratch, "s")
    df = spark.range(20_000).selectExpr("cast(id as string) as k", "1 as day", "cast(id as string) as source_path", "1.0D as v")
    K.replace_keys(df, root, ["k"], n_buckets=8)
    (folder,) = os.listdir(os.path.join(root, "data"))
    assert len([d for d in os.listdir(os.path.join(root, "data", folder)) if d.startswith(K.BUCKET)]) == 8
    assert K.read_keyed(spark, root).count() == 20_000


def test_only_touched_buckets_are_read_and_rewritten(spark, scratch):
    root = os.path.join(scratch, "s")
    K.replace_keys(spark.range(400).selectExpr("cast(id as string) as k", "1 as day", "'p' as source_path", "1.0D as v"), root, ["k"], n_buckets=16)
    before = versions.head(spark, root)[1]["buckets"]
    one = frame(spark, [("7", 2, "q", 2.0)])
    (bucket,) = K._touched(one, ["k"], 16)
    K.replace_keys(one, root, ["k"])
    after = versions.head(spark, root)[1]["buckets"]
    assert {b for b in before if before[b] != after[b]} == {str(bucket)}
    # The key read of an append: the files of one bucket, the key column alone.
    keys = K.rows_of_keys(spark, root, one, ["k"])
    assert {f.split("_bucket=")[1].split("/")[0] for f in keys.inputFiles()} == {str(bucket)}
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:string>" in plan


def test_a_change_that_is_killed_changes_nothing(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "s")
    K.append_unseen(frame(spark, [("a", 1, "p", 1.0)]), root, ["k"])
    monkeypatch.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        K.replace_keys(frame(spark, [("a", 9, "q", 9.0), ("b", 9, "q", 9.0)]), root, ["k"])
    monkeypatch.undo()
    assert held(spark, root) == [("a", 1, "p", 1.0)]
    assert K.append_unseen(frame(spark, [("b", 2, "q", 2.0)]), root, ["k"])["new"] == 1


def test_two_appends_from_one_version_conflict(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "s")
    K.append_unseen(frame(spark, [("a", 1, "p", 1.0)]), root, ["k"])
    base, manifest = versions.head(spark, root)
    K.append_unseen(frame(spark, [("b", 1, "p", 1.0)]), root, ["k"])
    monkeypatch.setattr(versions, "head", lambda *a: (base, manifest))
    with pytest.raises(versions.VersionConflict):
        K.append_unseen(frame(spark, [("b", 1, "late", 1.0)]), root, ["k"])
    monkeypatch.undo()
    assert sorted(r.k for r in K.read_keyed(spark, root).collect()) == ["a", "b"]


def test_a_hot_key_of_an_inbox_is_aggregated_in_its_tasks(spark):
    from snapmart.sources.landing import one_per_key

    df = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "cast(id as string) as source_path")
    out = one_per_key(df, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan
    assert out.where("k = 'hot'").first().source_path == max(str(i) for i in range(0, 40_000, 3))


def test_compaction_keeps_the_rows(spark, scratch):
    root = os.path.join(scratch, "s")
    for i in range(6):
        K.append_unseen(frame(spark, [(f"k{i}", 1, "p", 1.0), ("same", i, "p", 1.0)]), root, ["k"], n_buckets=1)
    rows = held(spark, root)
    assert K.compact(spark, root, ["k"], most=3) == 1
    assert held(spark, root) == rows and len(versions.head(spark, root)[1]["buckets"]["0"]) == 1
    assert K.compact(spark, root, ["k"], most=3) == 0


def write_docs(folder, docs):
    os.makedirs(folder, exist_ok=True)
    for name, text in docs.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)


def test_stream_takes_each_file_and_each_key_once(spark, scratch):
    inbox, store, checkpoint = (os.path.join(scratch, n) for n in ("in", "store", "cp"))

    def run():
        return incremental.ingest_keyed(spark, f"{inbox}/*/*", "id BIGINT, v STRING", store, checkpoint, ["id"], max_files=2)

    write_docs(f"{inbox}/1", {"a.json": json.dumps({"id": 1, "v": "x"}), "b.json": "{broken", "c.json": json.dumps({"id": 1, "v": "y"})})
    first = run()
    assert len(first) == 2 and sum(c["new"] for c in first) == 1 and sum(c["failed"] for c in first) == 1
    write_docs(f"{inbox}/2", {"d.json": json.dumps({"id": 1, "v": "late"}), "e.json": json.dumps({"id": 2, "v": "z"})})
    assert run() == [{"new": 1, "skipped": 1, "failed": 0}]
    assert run() == []
    assert sorted((r.id) for r in K.read_keyed(spark, store).collect()) == [1, 2]


def test_a_batch_delivered_twice_is_applied_once(spark, scratch):
    """The store commits, then the stream dies before its own commit and delivers the batch again."""
    root = os.path.join(scratch, "s")
    batch = frame(spark, [("a", 1, "p", 1.0)])
    first = K.append_unseen(batch, root, ["k"], stream="s", batch_id=4)
    version = versions.head(spark, root)[0]
    assert K.append_unseen(batch, root, ["k"], stream="s", batch_id=4) == first
    assert K.append_unseen(batch, root, ["k"], stream="s", batch_id=3) == {"new": 0, "skipped": 0, "failed": 0}
    assert versions.head(spark, root)[0] == version
    assert K.append_unseen(batch, root, ["k"], stream="other", batch_id=0) == {"new": 0, "skipped": 1, "failed": 0}


def test_a_crash_between_the_two_commits(spark, scratch, monkeypatch):
    inbox, store, checkpoint = (os.path.join(scratch, n) for n in ("in", "store", "cp"))
    write_docs(f"{inbox}/1", {"a.json": json.dumps({"id": 1}), "b.json": json.dumps({"id": 2})})
    real = incremental.append_unseen

    def dies(*args, **kw):
        real(*args, **kw)
        raise RuntimeError("killed after the store's commit")

    monkeypatch.setattr(incremental, "append_unseen", dies)
    with pytest.raises(Exception, match="killed"):
        incremental.ingest_keyed(spark, f"{inbox}/*/*", "id BIGINT", store, checkpoint, ["id"])
    monkeypatch.undo()
    assert incremental.ingest_keyed(spark, f"{inbox}/*/*", "id BIGINT", store, checkpoint, ["id"]) == [{"new": 2, "skipped": 0, "failed": 0}]
    assert K.read_keyed(spark, store).count() == 2


def test_buckets_of_nulls_and_of_strings_differ(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(F.countDistinct(F.xxhash64("x", "y", F.isnull("x"), F.isnull("y")))).first()[0] == 2


@pytest.mark.parametrize("seed", [3, 4])
def test_merged_snapshots_equal_the_full_current_view(spark, scratch, seed):
    """Random ties, NULL keys, NULL dates, late snapshots and repeated rows."""
    from snapmart.operators.latest import latest_per_key

    rnd = random.Random(seed)
    root, history = os.path.join(scratch, "s"), []
    for batch in range(5):
        rows = [(rnd.choice(["a", "b", "c", "d", "", None]), rnd.choice([1, 2, 3, 4, None]), f"p{rnd.randrange(3)}", 1.0) for _ in range(rnd.choice([0, 3, 12]))]
        assert K.merge_latest(frame(spark, rows), root, ["k"], "day", n_buckets=4, stream="s", batch_id=batch)
        assert not K.merge_latest(frame(spark, rows), root, ["k"], "day", stream="s", batch_id=batch)
        history += rows
        want = sorted(tuple(r) for r in latest_per_key(frame(spark, history), "k", "day").collect())
        state = K.read_keyed(spark, root)
        assert (sorted(tuple(r) for r in state.collect()) if state is not None else []) == want


def test_a_merge_reads_and_rewrites_only_its_buckets(spark, scratch):
    root = os.path.join(scratch, "s")
    K.merge_latest(spark.range(400).selectExpr("cast(id as string) as k", "1 as day", "'p' as source_path", "1.0D as v"), root, ["k"], "day", n_buckets=16)
    before = versions.head(spark, root)[1]["buckets"]
    one = frame(spark, [("7", 2, "q", 2.0), ("7", 2, "r", 2.0), ("8", 0, "late", 0.0)])
    touched = {str(b) for b in K._touched(one, ["k"], 16)}
    K.merge_latest(one, root, ["k"], "day")
    after = versions.head(spark, root)[1]["buckets"]
    assert {b for b in before if before[b] != after[b]} == touched and len(before) == 16
    rows = held(spark, root)
    assert len(rows) == 401 and [r for r in rows if r[0] in ("7", "8")] == [("7", 2, "q", 2.0), ("7", 2, "r", 2.0), ("8", 1, "p", 1.0)]
