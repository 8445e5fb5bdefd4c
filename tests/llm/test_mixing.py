from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm import mixing
from snapmart.llm.common import documents
from tests.llm.spark_fixture import EDGE_ROWS, docs_of, with_clashing_columns


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes: dict) -> dict:
    """Reshare the excess by weight until no source is above three times its size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = float(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s: 3.0 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return fixed | share
        fixed |= above


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_against_resharing(spark, seed):
    rnd = random.Random(seed)
    names = ["a", "B", "é", "z", None, "", "aa"][: rnd.randrange(1, 8)]
    sizes = {n: rnd.choice([0, 1, 5, 40, 1000]) for n in names}
    sized = spark.createDataFrame([(1, n, 0, v) for n, v in sizes.items()], "doc_id bigint, source string, key bigint, size bigint")
    got = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_driver_documents(spark, sf_check):
    docs = documents(spark, sf_check)
    texts = {r.doc_id: (r.source, r.text) for r in docs.collect()}
    rows = mixing.mix_sources(docs).collect()
    totals = Counter()
    for s, t in texts.values():
        totals[s] += size(t)
    want = brute_targets(totals)
    taken, longest = Counter(), Counter()
    for r in rows:
        assert (r.size, r.source_size) == (size(texts[r.doc_id][1]), totals[r.source])
        assert abs(r.target - want[r.source]) < 1e-6 * want[r.source]
        ratio = r.target / r.source_size
        assert r.taken == r.size * r.copies and int(ratio) <= r.copies <= min(3, int(ratio) + 1)
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    assert len(rows) == len(texts)
    assert all(abs(taken[s] - want[s]) <= longest[s] for s in want)
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_reduction_tree_has_levels(spark, monkeypatch):
    """Many groups: the open documents meet level by level, and copies sum to the expectation."""
    monkeypatch.setattr(mixing, "GROUP", 8)
    monkeypatch.setattr(mixing, "FAN", 4)
    docs = docs_of(spark, [(i, "w " * 10, "ab"[i % 5 == 0]) for i in range(1000)])
    rows = mixing.mix_sources(docs).collect()
    for s in "ab":
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.copies for r in own) - own[0].target / 10) <= 1


def test_pivotal_keeps_each_expectation():
    rng = np.random.default_rng(3)
    p = rng.random(9)
    runs = np.array([mixing.pivotal(p, rng.random(9))[0] for _ in range(20_000)])
    assert np.abs(runs.mean(axis=0) - p).max() < 0.02
    assert (np.isclose(runs, 0) | np.isclose(runs, 1)).sum(axis=1).min() >= 8
    assert np.allclose(runs.sum(axis=1), p.sum())


def test_edge_rows(spark):
    docs = with_clashing_columns(docs_of(spark, EDGE_ROWS))
    rows = mixing.mix_sources(docs.withColumn("_id", F.lit("x"))).collect()
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(i), size(t)) for i, t, _ in EDGE_ROWS)
    copies = mixing.take_copies(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r.copies for r in rows)
    assert mixing.mix_sources(docs.limit(0)).collect() == [] and mixing.take_copies(docs.limit(0)).collect() == []


def test_nulls_tell_rows_apart(spark):
    """Rows that differ only in where their null is get their own copies."""
    rows = [(1, "a", None), (1, None, "a"), (None, "a", "a"), (None, None, "a"), (2, "w " * 400, "big"), (3, "w " * 30, None)]
    docs = docs_of(spark, rows)
    assert docs.select(mixing.row_key().alias("k")).distinct().count() == len(rows)
    mixed = Counter()
    for r in mixing.mix_sources(docs).collect():
        mixed[r.doc_id, r.source, r.size] += r.copies
    taken = Counter((r.doc_id, r.source, size(r.text)) for r in mixing.take_copies(docs).collect())
    assert {k: n for k, n in mixed.items() if n} == taken


def test_equal_rows_meet_in_many_groups(spark):
    """100,000 equal rows are dealt to many groups and taken as the target says, whatever the partitions."""
    docs = spark.range(100_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("one two").alias("text"), F.lit("a").alias("source"))
    docs = docs.unionByName(docs_of(spark, [(8, "w " * 150_000, "b")]).select("doc_id", "text", "source"))
    found = []
    for n in (3, 8):
        sized = mixing.number_repeats(mixing.sizes(docs.repartition(n)))
        groups = sized.filter("doc_id = 7").groupBy(F.pmod("uid", F.lit(98))).count().collect()
        assert len(groups) == 98 and max(r["count"] for r in groups) < 1300
        assert sized.select("uid").distinct().count() == 100_001
        rows = mixing.mix_sources(docs.repartition(n)).filter("doc_id = 7")
        r = rows.agg(F.sum("taken"), F.max("target"), F.max("copies") - F.min("copies")).first()
        assert abs(r[0] - r[1]) <= 2 and r[2] == 1
        found.append(sorted((x["copies"], x["count"]) for x in rows.groupBy("copies").count().collect()))
    assert found[0] == found[1]
