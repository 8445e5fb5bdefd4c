"""Whitening against numpy on whole tables."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm import whitening
from snapmart.llm.queries import QUERIES


def brute_force(vectors):
    """Rows of integers, eigenvalues and eigenvectors (falling), exact deviations."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(axis=0)
    deviations = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s, strict=True)) for row in x]
    d = x - s / n
    values, vectors_ = np.linalg.eigh(d.T @ d / n)
    return d, values[::-1], vectors_[:, ::-1], deviations


def check(df, ids, vectors, components=32):
    rows = df.orderBy("vec_id", "component").collect()
    d, values, basis, deviations = brute_force(vectors)
    k = min(components, d.shape[1])
    assert len(rows) == len(ids) * k
    z = np.array([r.whitened for r in rows]).reshape(len(ids), k)
    want = d @ basis[:, :k] / np.sqrt(values[:k])
    assert np.abs(np.abs(z) - np.abs(want)).max() < 1e-6
    sign = np.sign((z * want).sum(axis=0))
    assert np.abs(z - want * sign).max() < 1e-6  # one sign for all rows
    assert [r.deviation for r in rows[::k]] == deviations
    assert [r.vec_id for r in rows[::k]] == list(ids)
    assert {r.n for r in rows} == {len(ids)}
    assert np.allclose([r.explained for r in rows[:k]], values[:k] / values.sum(), rtol=1e-6)
    error = np.abs(z.T @ z / len(ids) - np.eye(k)).max()
    assert {r.identity_error for r in rows} == {rows[0].identity_error}
    assert rows[0].identity_error <= 1e-4 and abs(rows[0].identity_error - error) < 1e-9


def test_whole_table(spark, sf_check):
    rows = spark.read.parquet(f"{sf_check}/embeddings.parquet").orderBy("vec_id").collect()
    check(QUERIES["op11_whitening"](spark, sf_check), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_many_blocks_and_bad_rows(spark):
    rnd = np.random.default_rng(2)
    good = [(i, [float(c) for c in row]) for i, row in enumerate(rnd.normal(size=(2500, 5)) * [1, 2, 3, 4, 5])]
    bad = [(9001, None), (9002, [1.0, None, 1.0, 1.0, 1.0]), (9003, [1.0, float("nan"), 1.0, 1.0, 1.0]), (9004, [float("inf")] * 5), (9005, [1.0]), (9006, [])]
    df = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<double>").repartition(7)
    df = df.withColumns({n: F.lit("x") for n in ("x", "v", "n", "part", "seq", "block", "dim")})
    check(whitening.whiten(df), [i for i, _ in good], [v for _, v in good])


def test_no_variance_repeats_and_empty(spark):
    schema = "vec_id bigint, embedding array<float>"
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, -0.5]), (1, [0.5, -0.5]), (None, [0.5, -0.5])], schema)).collect()
    assert len(same) == 6 and {(r.whitened, r.deviation, r.identity_error, r.n) for r in same} == {(0.0, 0, 0.0, 3)}
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 0.0]), (2, [3.0, 0.0])], schema)).orderBy("vec_id", "component").collect()
    assert [abs(round(r.whitened, 9)) for r in line] == [1.0, 0.0, 1.0, 0.0] and line[0].identity_error < 1e-9
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []


def test_large_entries_stay_exact():
    raw = np.array([[1 << 41, 5], [-(1 << 41), 7]], "<i8").tobytes()
    assert whitening.exact_deviation(raw, 1 << 22, np.array([0, 12])) == [None, None]
    small = np.array([[3_000_000, 1], [1_000_000, 2]], "<i8").tobytes()
    n, s = 2000, np.array([2_000_000_000, 3])
    want = [sum((n * x - t) ** 2 for x, t in zip(row, s.tolist(), strict=True)) for row in ([3_000_000, 1], [1_000_000, 2])]
    assert whitening.exact_deviation(small, n, s) == [w if w < 1 << 63 else None for w in want]


@pytest.mark.parametrize("rank", [1, 3])
def test_whitening_matrix_leaves_out_null_directions(rank):
    rnd = np.random.default_rng(rank)
    b = rnd.normal(size=(5, rank))
    matrix, values = whitening.whitening_matrix(b @ b.T)
    assert ((matrix != 0).any(axis=0)).tolist() == [True] * rank + [False] * (5 - rank)
    assert (np.diff(values) <= 1e-9).all()
