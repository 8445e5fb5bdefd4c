"""Ranked search against scoring every document, and the bounds of the sketch."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm import ranked_search as rs
from snapmart.llm.common import store
from tests.llm.spark_fixture import EDGE_ROWS, docs_of, with_clashing_columns

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 75 + (25 * sum(b.values()) * n_docs) // total
            s = 0
            for t in terms(text):
                if b[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * ((1_000_000_000 * b[t]) // (1000 * b[t] + 12 * m))
            if s > 0:
                scored.append((-s, math.inf if i is None else i, i))
        scored.sort(key=lambda r: r[:2])
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def got(docs, items, **kw):
    index = store(rs.build_index(docs), "test-index")
    return sorted([tuple(r) for r in rs.search(index, items, **kw).select("item_id", "rank", "doc_id", "score").collect()], key=repr)


def corpus(n, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Äpfel", "straße", "Σίγμα", "x1y2", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rnd.choices(words, weights, k=rnd.choice([0, 1, 3, 30, 200])))) for i in range(n)]


@pytest.mark.parametrize("block_items", [256, 3])
def test_equals_scoring_all(spark, block_items):
    rows = [*corpus(300, 1), *corpus(40, 1)]  # repeated rows and ties
    items = [(7, "w0 w5 W5 äpfel Äpfel"), (7, "w9 日本-日本"), (8, None), (9, "unknown words"), (10, ""), (11, "straße w30 w31 w32 w33 x1y2")]
    docs = docs_of(spark, [(i, t, "s") for i, t in rows]).repartition(5)
    frame = spark.createDataFrame(items, "item_id bigint, text string").coalesce(1)
    assert got(docs, frame, block_items=block_items) == brute_force(rows, items)


def test_edge_rows_and_clashing_names(spark):
    items = [(1, "alpha lone ONE élève long"), (None, "beta")]
    frame = spark.createDataFrame(items, "item_id bigint, text string").coalesce(1)
    docs = with_clashing_columns(docs_of(spark, EDGE_ROWS)).withColumns({n: F.lit(1) for n in ("_item", "n", "terms", "tfs")})
    assert got(docs, frame) == brute_force([(i, t) for i, t, _ in EDGE_ROWS], items)


def test_empty_tables(spark):
    docs, items = docs_of(spark, [(1, "a b", "s")]), spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert rs.rank_documents(docs.limit(0), items).collect() == []
    assert rs.rank_documents(docs_of(spark, [(1, "..", "s"), (2, None, "s")]), items).collect() == []
    assert rs.rank_documents(docs, items.limit(0)).collect() == []


def test_bounds_hold_and_prune():
    rnd = np.random.default_rng(3)
    rows, vocabulary = 400, np.unique(rnd.integers(0, 1 << 63, 3000).astype(np.uint64))
    doc = np.repeat(np.arange(rows), 60)
    terms_ = np.concatenate([rnd.choice(vocabulary, 60, replace=False) for _ in range(rows)])
    order = np.lexsort((terms_, doc))
    terms_, impact = terms_[order], rnd.integers(1, 1000, doc.size)
    place = np.searchsorted(vocabulary, terms_)
    q = rs.Queries([0], vocabulary, np.ones(vocabulary.size, np.int64), [np.sort(rnd.choice(vocabulary.size, 30, replace=False))], [np.ones(30, np.int64)])
    sketch = rs.max_sketch(doc, terms_, impact, rows)
    start = np.searchsorted(doc, np.arange(rows + 1))
    exact = rs.rescore(q, 0, np.arange(rows), start, place, impact)
    at = (vocabulary[q.places[0]] & np.uint64(rs.COORDINATES - 1)).astype(np.int64)
    assert (sketch[at].sum(axis=0) >= exact).all()
    best = [rs.Best(5)]
    scored = rs.search_batch(q, best, list(range(rows)), sketch, start, place, impact, step=8)
    assert [-r[0] for r in best[0].rows] == sorted(exact, reverse=True)[:5]
    assert scored < rows / 3
