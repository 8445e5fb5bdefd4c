from __future__ import annotations

import hashlib
import random

import numpy as np

from snapmart.llm import fingerprints as P
from snapmart.llm.common import documents
from tests.llm.spark_fixture import EDGE_ROWS, docs_of, with_clashing_columns


def shingles(text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x and y else float(x == y)


def brute_next(rows):
    """Rows by (id, text), nulls first; the last one is followed by the smallest id."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    known = [r for r in rows if r[0] is not None]
    after = rows[1:] + [known[0] if known else rows[-1]]
    return [(r[0], r[1] or "", q[1] or "") for r, q in zip(rows, after)]


def test_driver_documents_against_true_jaccard(spark, sf_small):
    docs = documents(spark, sf_small)
    rows = {r.doc_id: r for r in P.compare_with_next(docs.repartition(4), range_rows=32).collect()}
    want = brute_next([(r.doc_id, r.text) for r in docs.collect()])
    assert len(rows) == len(want)
    errors, longer = [], []
    for i, text, following in want:
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        r = rows[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own = [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, following)]
        errors += own
        longer += own * (len(shingles(text)) >= 100)
    # Texts of a few shingles fill few bins, and their copies vary together.
    assert np.sqrt(np.mean(np.square(longer))) < 0.03 and np.abs(longer).max() < 0.12
    assert np.sqrt(np.mean(np.square(errors))) < 0.05
    assert abs(np.mean(errors)) < 0.01
    by_text = {}
    for i, text, _ in want:
        assert by_text.setdefault(text, rows[i].fingerprint) == rows[i].fingerprint


def test_estimate_is_unbiased_for_short_and_long_sets():
    rng = np.random.default_rng(2)
    for n in (3, 40, 3000):
        for share in (0.0, 0.5, 0.9):
            got = []
            for _ in range(60):
                same = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64) * np.uint64(2)
                sides = [np.concatenate((same, rng.integers(0, 1 << 63, n - same.size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))) for _ in range(2)]
                got.append(P.likeness(P.pack(sides[0]), P.pack(sides[1])))
            true = int(n * share) / (2 * n - int(n * share))
            assert abs(np.mean(got) - true) < (0.08 if n == 3 else 0.03)


def test_edge_rows(spark):
    docs = with_clashing_columns(docs_of(spark, EDGE_ROWS)).repartition(3)
    got = P.compare_with_next(docs, range_rows=2).collect()
    want = [(i, len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + q[: len(t) // 2]).encode()).hexdigest()) for i, t, q in brute_next(EDGE_ROWS)]
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    assert P.compare_with_next(docs.limit(0)).collect() == []
    alone = docs_of(spark, [(5, "only one document in here now", "s")])
    (row,) = P.compare_with_next(alone).collect()
    assert row.near_next == 1.0
    assert P.fingerprint_documents(docs).count() == len(EDGE_ROWS)
    assert P.compare_with_next(docs_of(spark, [(None, "a b", "s")])).count() == 1


def test_likeness_of_wordless_texts():
    empty, one = P.fingerprints(["", "a"])
    assert P.likeness(empty, empty) == 1.0 and P.likeness(empty, one) == 0.0 and P.to_text(empty) == ""
    random.seed(1)
    text = " ".join(random.choices("abcdefgh", k=300))
    assert P.likeness(*P.fingerprints([text, text])) == 1.0
