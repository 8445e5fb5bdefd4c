from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from snapmart.llm import ngram_join
from tests.llm.spark_fixture import EDGE_ROWS, docs_of, with_clashing_columns


def shingle_set(text: str | None) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows: list[tuple]) -> list[tuple]:
    sets = [shingle_set(t) for _, t, _ in rows]
    up = list(range(len(rows)))

    def find(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            up[max(find(i), find(j))] = min(find(i), find(j))
    names: dict[int, list] = {}
    for i, r in enumerate(rows):
        names.setdefault(find(i), []).append(r[0])
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in names.items()}
    return sorted(((r[0], len(s), smallest[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df) -> list[tuple]:
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def planted(seed: int) -> list[tuple]:
    """Random texts, exact and near copies around the threshold, chains, and shared passages."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = rnd.choices(vocab, k=30)
    rows: list[list[str]] = []
    for _ in range(40):
        base = rnd.choices(vocab, k=rnd.choice([3, 5, 12, 40, 90]))
        rows.append(base)
        for _ in range(rnd.randrange(4)):
            base = list(base)
            for _ in range(rnd.randrange(4)):
                base[rnd.randrange(len(base))] = rnd.choice(vocab)
            rows.append(base)
    rows += [rnd.choices(vocab, k=rnd.randrange(12)) + passage for _ in range(30)]
    rnd.shuffle(rows)
    return [(i, " ".join(w).title() if i % 7 == 0 else " ".join(w), "s") for i, w in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed, monkeypatch):
    if seed == 2:  # many chunks, hot shingles and small batches
        monkeypatch.setattr(ngram_join, "CHUNK", 8)
        monkeypatch.setattr(ngram_join, "SET_BYTES", 4096)
    rows = planted(seed)
    assert got(ngram_join.jaccard_components(docs_of(spark, rows).repartition(3))) == brute(rows)


def test_edge_rows_and_clashing_columns(spark):
    docs = with_clashing_columns(docs_of(spark, EDGE_ROWS))
    assert got(ngram_join.jaccard_components(docs)) == brute(EDGE_ROWS)
    assert got(ngram_join.jaccard_components(docs.limit(0))) == []


def test_driver_documents_against_all_pairs(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got(ngram_join.jaccard_components(docs)) == brute(rows)


def test_bound_never_refutes_a_link():
    rng = np.random.default_rng(5)
    for n in (3, 40, 700):
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        y = np.concatenate((x[: n - n // 10], rng.integers(0, 1 << 63, n // 10, dtype=np.uint64)))
        links = ngram_join.traverse([0, 0], [x.size, y.size], [ngram_join.bitmap(x), ngram_join.bitmap(y)], lambda i, j: True)
        assert len(links) == 1


def test_dense_group_needs_few_checks():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.concatenate((base[5:], rng.integers(0, 1 << 63, 5, dtype=np.uint64))) for _ in range(600)]
    asked = []
    ngram_join.traverse([0] * 600, [200] * 600, [ngram_join.bitmap(s) for s in sets], lambda i, j: bool(asked.append((i, j))) or True)
    assert len(asked) == 599


def brute_links(rows: list[tuple]) -> list[tuple]:
    sets = [shingle_set(t) for _, t, _ in rows]
    n = [0] * len(rows)
    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            n[i] += 1
            n[j] += 1
    return sorted(((r[0], k) for r, k in zip(rows, n, strict=True)), key=str)


@pytest.mark.parametrize("chunk", [2048, 8])
def test_links_against_all_pairs(spark, chunk, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    rnd = random.Random(9)
    base = rnd.choices([f"w{i}" for i in range(400)], k=80)
    # 150 copies, each with a word of its own near one of its ends: more than one block.
    copies = [[*base[:i], f"x{k}", *base[i + 1 :]] for k in range(150) for i in [rnd.choice((0, 1, 2, 77, 78, 79))]]
    rows = planted(3)
    rows += [(1000 + k, " ".join(w), "s") for k, w in enumerate(copies + copies[:5])]
    got_links = ngram_join.jaccard_components(docs_of(spark, rows).repartition(3)).collect()
    assert sorted(((r.doc_id, r.n_links) for r in got_links), key=str) == brute_links(rows)
    assert got(ngram_join.jaccard_components(docs_of(spark, EDGE_ROWS), counted=False)) == brute(EDGE_ROWS)


def test_edge_rows_links(spark):
    rows = ngram_join.jaccard_components(docs_of(spark, EDGE_ROWS)).collect()
    assert sorted(((r.doc_id, r.n_links) for r in rows), key=str) == brute_links(EDGE_ROWS)


def test_shared_counts_in_slices():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, 200, dtype=np.uint64)) for _ in range(20)]
    got = ngram_join.shared_counts(sets[:12], sets[12:], width=7)
    assert got.tolist() == [[np.intersect1d(a, b).size for b in sets[12:]] for a in sets[:12]]
