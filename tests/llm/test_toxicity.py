from __future__ import annotations

import random
import zlib

import pytest

from snapmart.llm import toxicity as T
from snapmart.llm.queries import QUERIES
from tests.llm.spark_fixture import EDGE_ROWS, docs_of, with_clashing_columns


def brute_segments(scores: list[float]) -> list[tuple[int, int]]:
    """Maximal scoring segments by their recursive definition: the best, then both sides."""
    best, where = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-12:
                best, where = total, (i, j)
    if where is None:
        return []
    i, j = where
    return brute_segments(scores[:i]) + [(i, j)] + [(a + j + 1, b + j + 1) for a, b in brute_segments(scores[j + 1 :])]


def test_segments_against_definition():
    rnd = random.Random(5)
    for _ in range(400):
        scores = [rnd.choice([-T.GAP] * 4 + [0.3, 0.6, 1.1]) + 0.0 for _ in range(rnd.randrange(25))]
        scores = [s + rnd.random() * 0.01 if s > 0 else s for s in scores]
        got = T.maximal_segments([(i, s) for i, s in enumerate(scores) if s > 0])
        assert [(a, b) for a, b, _ in got] == brute_segments(scores)
        assert all(abs(v - sum(scores[a : b + 1])) < 1e-9 for a, b, v in got)


def steps(items) -> int:
    """Comparisons of the scan: reads of the list of kept segments."""
    import sys

    lines = 0

    def trace(frame, event, arg):
        nonlocal lines
        if frame.f_code is not T.maximal_segments.__code__:
            return None
        lines += event == "line"
        return trace

    old = sys.gettrace()
    sys.settrace(trace)
    try:
        T.maximal_segments(items)
    finally:
        sys.settrace(old)
    return lines


@pytest.mark.parametrize("gap", [2, 7, 40])
def test_the_scan_is_linear(gap):
    rnd = random.Random(gap)
    hits = [(gap * i, 0.3 + rnd.random()) for i in range(8000)]
    half, whole = steps(hits[:4000]), steps(hits)
    assert whole < 2.2 * half and whole < 40 * len(hits)


def brute_log_odds(texts: list[tuple[str, bool]]) -> dict[str, float]:
    """Significant terms and their log-odds, counted text by text."""
    import math
    import re
    from collections import Counter
    from statistics import NormalDist

    kinds = (Counter(), Counter())
    for text, toxic in texts:
        words = set(re.findall(r"[^\W\d_]+", text.lower()))
        kinds[toxic].update({w for w in words} | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) >= n})
    n = [sum(c.values()) for c in kinds]
    judged = [t for t, y in kinds[1].items() if y >= T.MIN_COUNT]
    least = NormalDist().inv_cdf(1 - T.CHANCE_TERMS / len(judged))
    out = {}
    for term in judged:
        c, t = kinds[0][term], kinds[1][term]
        prior = T.PRIOR * (c + t) / sum(n) + T.FLAT
        odds = [(y + prior) / (n_ + T.PRIOR - y) for y, n_ in zip((c, t), n, strict=True)]
        base = n[1] / sum(n)
        g = t * math.log(t / ((c + t) * base)) + (c * math.log(c / ((c + t) * (1 - base))) if c else 0)
        if math.copysign(math.sqrt(max(0.0, 2 * g)), t / (c + t) - base) >= least and odds[1] > odds[0]:
            out[term] = math.log(odds[1] / odds[0])
    return out


@pytest.fixture(scope="module")
def small_model(spark):
    d = "/root/testdata/sf0.01"
    return T.train(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))


def small_texts(spark, folds):
    d = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = spark.read.parquet(f"{d}/documents.parquet").collect()
    fold = lambda r: zlib.crc32(str(r.doc_id).encode()) % 4
    seen = {}
    for r in rows:
        if r.doc_id in marks and r.text and fold(r) != 2:
            k = seen.get(r.text, (9, 0))
            seen[r.text] = (min(k[0], fold(r)), max(k[1], marks[r.doc_id]))
    return [(t, bool(y)) for t, (f, y) in seen.items() if f in folds]


def test_log_odds_against_counting(spark, small_model):
    want = {t: min(T.MAX_SCORE, s) for t, s in brute_log_odds(small_texts(spark, (0, 1))).items()}
    assert small_model.scores.keys() == want.keys()
    assert all(abs(small_model.scores[t] - s) < 1e-9 for t, s in want.items())


def test_extreme_values_and_score_against_their_definition(spark, small_model):
    import math
    import re

    m = small_model
    marks_of = lambda words: [m.word_score(w) for w in words]
    clean = [re.findall(r"[^\W\d_]+", t.lower()) for t, y in small_texts(spark, (3,)) if not y]
    n = sum(map(len, clean)) + 1
    tally = {}
    for w in clean:
        for s in marks_of(w):
            if s > 0:
                tally[round(s, 2)] = tally.get(round(s, 2), 0) + 1
    shares = {round(s, 2): (tally.get(round(s, 2), 0) + 0.5 / len(m.scores)) / n for s in m.scores.values()}
    # The rate solves sum p(s) exp(rate s) = 1, gaps included.
    moment = (1 - sum(shares.values())) * math.exp(-T.GAP * m.rate) + sum(p * math.exp(s * m.rate) for s, p in shares.items())
    assert abs(moment - 1) < 1e-6
    least = min(shares)
    best = [max((v for _, _, v in T.maximal_segments([(i, s) for i, s in enumerate(marks_of(w)) if s > 0])), default=0.0) for w in clean]
    assert abs(m.scale - (sum(b >= least for b in best) + 0.5) / (n * math.exp(-m.rate * least))) < 1e-9
    text = "calm " * 30 + " ".join(sorted(w for w in m.scores if not w.endswith("*"))[:3])
    words = text.split()
    found = T.maximal_segments([(i, s) for i, s in enumerate(marks_of(words)) if s > 0])
    chances = sorted(m.scale * len(words) * math.exp(-m.rate * v) for _, _, v in found)
    evidence = -math.log(1 - math.exp(-chances[0])) + sum(math.log(T.SIGNIFICANT / e) for e in chances[1:] if e < T.SIGNIFICANT)
    assert abs(T.judge(text, m, {})[0] - 1 / (1 + math.exp(-(m.slope * evidence + m.offset)))) < 1e-9


def test_few_labels_still_find_toxic_documents(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    judged = [(labels[r.doc_id], r.predicted) for r in QUERIES["op2_toxicity"](spark, d).collect() if r.held_out and r.doc_id in labels]
    toxic, clean = [p for y, p in judged if y], [p for y, p in judged if not y]
    assert sum(toxic) >= 0.6 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def test_curve_never_falls():
    import numpy as np

    slope, offset = T.fit_curve(np.array([0.0, 50.0, 1.0, 2.0]), np.array([1.0, 0.0, 1.0, 0.0]))
    assert slope == 0.0
    x = np.array([0.0] * 90 + [400.0] + [5.0] * 9)
    slope, offset = T.fit_curve(x, np.array([0.0] * 91 + [1.0] * 9))
    assert slope >= 0.0 and np.isfinite(offset)


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").collect()


def test_held_out_accuracy(spark, scored):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(scored) == len({r.doc_id for r in scored})
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.3)
    judged = [(labels[r.doc_id], r) for r in scored if r.held_out and r.doc_id in labels]
    toxic, clean = [r for y, r in judged if y], [r for y, r in judged if not y]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_passages_are_found_where_they_are(spark):
    model = T.ToxicityModel(scores={"bad": 6.0, "worse": 7.0}, rate=1.0, scale=0.01, slope=1.0, offset=-3.0)
    text = "Quiet words. Bad, WORSE bad! " + "calm " * 200 + "bad."
    (row,) = T.score_documents(docs_of(spark, [(1, text, "s")]), model).collect()
    spans = [text[p.start : p.end] for p in row.passages]
    assert spans == ["Bad, WORSE bad", "bad"]
    assert T.judge("calm words", model, {})[0] < row.score


def test_edge_rows(spark):
    model = T.ToxicityModel(scores={"bad": 6.0})
    docs = with_clashing_columns(docs_of(spark, EDGE_ROWS))
    got = T.score_documents(docs, model).collect()
    assert len(got) == len(EDGE_ROWS) and len({r.score for r in got}) == 1
    assert T.drop_toxic(docs, model).columns == docs.columns
    assert T.score_documents(docs.limit(0), model).collect() == []


def test_training_without_labels(spark):
    docs = docs_of(spark, EDGE_ROWS)
    nothing = spark.createDataFrame([(None, 1, None), (9, None, 1)], "doc_id bigint, toxic int, quality int")
    model = T.train(docs, nothing)
    assert T.judge("anything", model, {})[0] < 0.01
    one_kind = spark.createDataFrame([(i, 0, 1) for i in range(1, 8)], "doc_id bigint, toxic int, quality int")
    assert T.judge("anything", T.train(docs, one_kind), {})[0] < 0.01
