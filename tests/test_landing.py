"""Landing (R1-R7, R9) and the incremental file stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from snapmart.sources import landing as L
from snapmart.sources.documents import doc_glob, path_key, read_kind
from snapmart.streaming.incremental import ingest_new_games

from .docs_fixture import write_store


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return write_store(str(tmp_path_factory.mktemp("raw")))


def test_teams_from_standings(spark, raw):
    teams = L.teams_from_standings(read_kind(spark, raw, "standings"))
    assert teams.count() == 5
    assert sorted(r[0] for r in teams.distinct().collect()) == ["AAA", "BBB", "CCC"]


def test_newest_snapshot(spark, raw):
    newest = L.newest_snapshot(read_kind(spark, raw, "standings"))
    assert [str(r.snapshot_date) for r in newest.collect()] == ["2024-10-02"]
    assert L.teams_from_standings(newest).count() == 3
    with pytest.raises(ValueError):
        L.require_rows(newest.where("false"), "standings")


def test_completed_game_ids(spark, raw):
    ids = L.completed_game_ids(read_kind(spark, raw, "schedules"))
    assert [r.game_id for r in ids.collect()] == [1, 2, 5]          # E19


def test_pending_ids(spark, raw):
    landed = L.landed_keys(spark, doc_glob(raw, "play_by_play"), 2, "game_id")
    assert sorted(r.game_id for r in landed.collect()) == [2024020001, 2024020002, 2024020003]
    wanted = spark.createDataFrame([(2024020001,), (2024020004,), (2024020005,)], "game_id bigint")
    got = L.pending_ids(wanted, landed, "game_id")
    assert sorted(r.game_id for r in got.collect()) == [2024020004, 2024020005]


def test_past_games(spark, raw):
    sched = L.schedule_table(read_kind(spark, raw, "schedules"))
    got = L.past_games(sched, as_of="2024-10-04")
    assert [r.game_id for r in got.collect()] == [1, 2, 2]


def test_append_new_is_idempotent(spark, raw, tmp_path):
    inbox = str(tmp_path / "inbox")
    os.makedirs(os.path.join(inbox, "play-by-play", "77"))
    for name in os.listdir(os.path.join(raw, "play-by-play")):
        src = os.path.join(raw, "play-by-play", name, "play-by-play.json")
        dst_dir = os.path.join(inbox, "play-by-play", name)
        os.makedirs(dst_dir, exist_ok=True)
        with open(src) as f, open(os.path.join(dst_dir, "play-by-play.json"), "w") as g:
            g.write(f.read())
    with open(os.path.join(inbox, "play-by-play", "77", "play-by-play.json"), "w") as g:
        g.write('{"id": 77, "plays": [')                              # malformed
    store = str(tmp_path / "store")

    def run():
        docs = L.read_inbox(spark, inbox, "play_by_play").withColumn(
            "game_id", path_key(2).cast("bigint")
        )
        return L.append_new(docs, store, ["game_id"])

    assert run() == {"new": 3, "skipped": 0, "failed": 1}
    assert run() == {"new": 0, "skipped": 3, "failed": 1}            # E20
    assert spark.read.parquet(store).count() == 3


def test_replace_by_key(spark, tmp_path):
    store = str(tmp_path / "sched")
    first = spark.createDataFrame(
        [("AAA", 1), ("AAA", 2), ("BBB", 3)], "team_abbrev string, game_id bigint"
    )
    L.replace_by_key(first, store, "team_abbrev")
    again = spark.createDataFrame([("AAA", 9)], "team_abbrev string, game_id bigint")
    L.replace_by_key(again, store, "team_abbrev")
    got = sorted((r.team_abbrev, r.game_id) for r in spark.read.parquet(store).collect())
    assert got == [("AAA", 9), ("BBB", 3)]


def test_stream_takes_only_new_files(spark, tmp_path):
    root = write_store(str(tmp_path / "raw"))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    ingest_new_games(spark, root, out, ckpt)
    first = spark.read.parquet(out)
    assert first.count() == 3
    assert sorted(r.path_game_id for r in first.collect()) == [2024020001, 2024020002, 2024020003]
    new_dir = os.path.join(root, "play-by-play", "2024020010")
    os.makedirs(new_dir)
    with open(os.path.join(new_dir, "play-by-play.json"), "w") as f:
        json.dump({"id": 2024020010, "gameDate": "2024-11-01", "plays": []}, f)
    ingest_new_games(spark, root, out, ckpt)
    again = spark.read.parquet(out)
    assert again.count() == 4
    assert again.where(F.col("path_game_id") == 2024020010).count() == 1


def test_build_from_incremental_store(spark, tmp_path):
    from snapmart.plans.build import build

    root = write_store(str(tmp_path / "raw"))
    store, ckpt = str(tmp_path / "pbp"), str(tmp_path / "ckpt")
    ingest_new_games(spark, root, store, ckpt)
    a = build(spark, root, str(tmp_path / "wh1"), as_of="2026-06-30")
    b = build(spark, root, str(tmp_path / "wh2"), as_of="2026-06-30", pbp_store=store)
    for name in ("stg_games", "stg_plays", "fct_plays"):
        cols = [c for c in a[name].columns if c != "details"]
        assert sorted(a[name].select(cols).collect()) == sorted(b[name].select(cols).collect())


def test_append_new_counts_come_from_the_store(spark, tmp_path):
    store = str(tmp_path / "s")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "game_id bigint, v string")
    assert L.append_new(df, store, ["game_id"], run_id="r1") == {"new": 2, "skipped": 0, "failed": 0}
    more = spark.createDataFrame([(2, "b"), (3, "c")], "game_id bigint, v string")
    assert L.append_new(more, store, ["game_id"], run_id="r2") == {"new": 1, "skipped": 1, "failed": 0}
    got = sorted((r.game_id, r._run_id) for r in spark.read.parquet(store).collect())
    assert got == [(1, "r1"), (2, "r1"), (3, "r2")]


def test_append_new_partitioned_by_snapshot(spark, tmp_path):
    import datetime as dt

    store = str(tmp_path / "snap")
    d1, d2 = dt.date(2024, 10, 1), dt.date(2024, 10, 2)
    day1 = spark.createDataFrame([("AAA", d1), ("BBB", d1)], "team string, snapshot_date date")
    assert L.append_new(day1, store, ["team", "snapshot_date"], partition_by=["snapshot_date"]) == \
        {"new": 2, "skipped": 0, "failed": 0}
    day2 = spark.createDataFrame([("AAA", d1), ("AAA", d2)], "team string, snapshot_date date")
    assert L.append_new(day2, store, ["team", "snapshot_date"], partition_by=["snapshot_date"]) == \
        {"new": 1, "skipped": 1, "failed": 0}
    parts = sorted(n for n in os.listdir(store) if n.startswith("snapshot_date="))
    assert parts == ["snapshot_date=2024-10-01", "snapshot_date=2024-10-02"]
    assert spark.read.parquet(store).count() == 3


def test_append_new_with_repeated_and_null_keys(spark, tmp_path):
    store = str(tmp_path / "store")
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k int, source_path string")
    assert L.append_new(batch, store, ["k"]) == {"new": 2, "skipped": 1, "failed": 1}
    assert L.append_new(batch, store, ["k"]) == {"new": 0, "skipped": 3, "failed": 1}
    # The greatest path of a key is the one that is kept.
    assert sorted((r.k, r.source_path) for r in spark.read.parquet(store).collect()) == [(1, "b"), (2, "d")]


def test_append_new_fails_on_an_unreadable_store(spark, tmp_path):
    store = tmp_path / "store"
    store.mkdir()
    (store / "part-0.parquet").write_text("no parquet")
    batch = spark.createDataFrame([(1, "a")], "k int, source_path string")
    with pytest.raises(Exception):
        L.append_new(batch, str(store), ["k"])


def test_newest_documents_ignores_broken_old_ones(spark, tmp_path):
    raw = tmp_path / "raw"
    for day, text in (("2024-01-01", "{broken"), ("2024-01-03", '{"standings": [{"teamAbbrev": {"default": "B"}}]}'), ("2024-01-02", "{")):
        (raw / "standings" / day).mkdir(parents=True)
        (raw / "standings" / day / "standings.json").write_text(text)
    docs = L.newest_documents(spark, str(raw), "standings")
    assert [r.team_abbrev for r in L.teams_from_standings(docs).collect()] == ["B"]
    assert all("2024-01-03" in f for f in docs.inputFiles())
    with pytest.raises(Exception):
        L.newest_documents(spark, str(tmp_path / "none"), "standings")


def _inbox(root, games, broken=()):
    day = root / "standings" / "2024-10-05"
    day.mkdir(parents=True)
    (day / "standings.json").write_text(json.dumps({"standings": [{"teamAbbrev": {"default": t}} for t in "AB"]}))
    (root / "schedules" / "A").mkdir(parents=True)
    listed = [{"id": g, "gameState": "OFF", "gameDate": "2024-10-04", "gameType": 2} for g in [*games, *broken, 99]]
    listed.append({"id": 98, "gameState": "FUT", "gameDate": "2024-10-09", "gameType": 2})
    (root / "schedules" / "A" / "schedule.json").write_text(json.dumps({"games": listed}))
    for g in [*games, *broken, 98]:
        (root / "play-by-play" / str(g)).mkdir(parents=True)
        text = "{broken" if g in broken else json.dumps({"id": g, "plays": []})
        (root / "play-by-play" / str(g) / "play-by-play.json").write_text(text)
    return str(root)


def test_landing_run_counts_a_broken_document_and_goes_on(spark, tmp_path):
    inbox, store = _inbox(tmp_path / "in", [1, 2, 3], broken=[4]), str(tmp_path / "store")
    assert L.land_games(spark, inbox, store) == {"teams": 2, "wanted": 5, "new": 3, "skipped": 0, "failed": 1, "pending": 2}
    assert L.land_games(spark, inbox, store) == {"teams": 2, "wanted": 5, "new": 0, "skipped": 0, "failed": 1, "pending": 2}
    assert sorted(r.game_id for r in spark.read.parquet(store).collect()) == [1, 2, 3]


def test_stream_goes_on_after_a_broken_document(spark, tmp_path):
    from snapmart.streaming.incremental import game_documents, ingest_counts

    inbox, out = _inbox(tmp_path / "in", [1, 2], broken=[4]), str(tmp_path / "out")
    ingest_new_games(spark, inbox, out, str(tmp_path / "cp"))
    assert ingest_counts(spark, out) == {"stored": 3, "failed": 1}
    (tmp_path / "in" / "play-by-play" / "5").mkdir()
    (tmp_path / "in" / "play-by-play" / "5" / "play-by-play.json").write_text(json.dumps({"id": 5, "plays": []}))
    ingest_new_games(spark, inbox, out, str(tmp_path / "cp"))
    assert ingest_counts(spark, out) == {"stored": 4, "failed": 1}
    assert {r.path_game_id for r in game_documents(spark, out).collect()} == {1, 2, 5, 98}
