"""Toxic passages by maximum-scoring segments of token log-odds.

Token scores are log-odds of toxic against clean documents with an informative
Dirichlet prior (the pooled token shares and a flat part): ``log`` of the
smoothed odds ratio, kept where the token is commoner in toxic documents by so
many standard deviations (signed root of the likelihood ratio, which also
holds for tokens that no clean document has) that chance would lift about
``CHANCE_TERMS`` of all judged tokens as high: a small sample judges few tokens
and asks for less than a large one. A token is a lower-case
word; words too rare to judge fall back to their first letters, so inflected
forms of a known stem are found. Every other token costs ``GAP``.

A text's passages are all its maximal scoring segments, found in one linear
scan with pointers over segments that cannot matter any more. A passage of score S in a text of n tokens has the expected number of
chance hits ``E = K n exp(-lambda S)``: lambda solves ``sum p(s) exp(lambda s)
= 1`` over the clean token distribution, K is fitted to the clean texts of the
calibration fold. The evidence of a text is ``-log`` of the probability that
chance alone reaches its passages, and a logistic curve fitted on the same
fold maps it to the score (0 to 1).

Learning uses at most ``MAX_LABELLED`` labelled documents, chosen by a hash of
their id (a documented bound; equal texts count once); scoring reads every
whole text. Of the calibration fold the driver gets a histogram of token scores
and one number per text. Labels, language, source and id are no input of a score.

Edge cases: a null text is an empty one; texts without passages, empty ones
too, get the base score. Rows of ``labels`` with a null id or a null mark are
not used; of several marks of one id the largest counts. Without labelled rows
of both kinds, all texts get the share of toxic rows (0 without any). Repeated
rows are scored alike. Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import small_batches, store
from snapmart.sources.scratch import scratch_scope

MAX_LABELLED = 40_000
#: Terms that chance alone may put into the model.
CHANCE_TERMS = 0.5
MIN_COUNT = 3
PRIOR = 500.0
FLAT = 0.5
GAP = 0.25
MAX_SCORE = 8.0
SIGNIFICANT = 0.05
THRESHOLD = 0.3
#: Lengths of the stems a rare word falls back to, longest first.
STEMS = (6, 5, 4)
#: Words whose score a worker remembers at most.
MEMORY = 300_000
WORD = re.compile(r"[^\W\d_]+")


def terms(word: str) -> list[str]:
    """The word itself, then its stems with a mark."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


def maximal_segments(items: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a token sequence, in linear time.

    ``items`` are the positions and scores of the positive tokens; tokens
    between them cost ``GAP`` each. Returns first position, last position and
    score of each segment, in order.
    """
    kept: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, pointer
    total, last = 0.0, -1
    for at, score in items:
        if last >= 0:
            total -= GAP * (at - last - 1)
        first, end, before = at, at, total
        total += score
        after, last = total, at
        while True:
            # The nearest earlier segment that begins lower; a segment's pointer
            # is its own one, and what lies between begins no lower than it.
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= after:
                break
            first, before = kept[j][0], kept[j][2]
            del kept[j:]
        kept.append((first, end, before, after, j))
    return [(a, b, after - before) for a, b, before, after, _ in kept]


@dataclass
class ToxicityModel:
    """Token scores, extreme-value parameters and the final curve."""

    scores: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    scale: float = 1.0
    slope: float = 0.0
    offset: float = -50.0

    def word_score(self, word: str) -> float:
        """Score of the most specific known term, 0 if none is known."""
        for term in terms(word):
            if term in self.scores:
                return self.scores[term]
        return 0.0

    def passages(self, words: list[str], memory: dict[str, float]) -> list[tuple[int, int, float]]:
        if len(memory) > MEMORY:
            memory.clear()
        for w in {*words}.difference(memory):
            memory[w] = self.word_score(w)
        marks = list(map(memory.__getitem__, words))
        return maximal_segments([(i, s) for i, s in enumerate(marks) if s > 0.0])

    def expected(self, score: float, n: int) -> float:
        """Expected number of chance passages of this score in ``n`` clean tokens."""
        return self.scale * max(n, 1) * math.exp(-self.rate * score)

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        """-log chance of the best passage, raised by further significant ones."""
        if not found:
            return 0.0
        chances = sorted(self.expected(s, n) for _, _, s in found)
        best = -math.log(max(1e-300, -math.expm1(-chances[0])))
        return best + sum(math.log(SIGNIFICANT / e) for e in chances[1:] if e < SIGNIFICANT)

    def score(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-min(60.0, max(-60.0, self.slope * evidence + self.offset))))


def fold() -> Column:
    """crc32 of the id as text, modulo 4: 2 is held out, 3 calibrates, the rest gives token scores."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """``text, toxic, fold`` of at most ``bound`` labelled documents outside the held-out fold."""
    marks = labels.select("doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.withColumn("fold", fold()).filter("fold <> 2")
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # At most ``bound`` rows of three numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter(F.length("text") > 0)
    return rows.groupBy(F.sha2("text", 256)).agg(F.min("fold").alias("fold"), F.max("toxic").alias("toxic"), F.first("text").alias("text")).select("text", "toxic", "fold")


def term_counts(sample: DataFrame) -> DataFrame:
    """``term, toxic, clean``: documents of each kind that hold the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tally = (Counter(), Counter())
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tally[bool(toxic)].update({t for w in set(WORD.findall(text.lower())) for t in terms(w)})
            every = list(tally[0].keys() | tally[1].keys())
            columns = [pa.array(every, pa.string()), pa.array([tally[1][t] for t in every], pa.int64()), pa.array([tally[0][t] for t in every], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["term", "toxic", "clean"])

    partial = sample.select("text", "toxic").mapInArrow(count, "term string, toxic bigint, clean bigint")
    return partial.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(counts: DataFrame, chance_terms: float = CHANCE_TERMS) -> DataFrame:
    """``term, delta, z, toxic, clean``: significant log-odds under the Dirichlet prior."""
    totals = counts.agg(F.sum("toxic").cast("double").alias("toxic"), F.sum("clean").cast("double").alias("clean"))
    n_t, n_c = totals.select("toxic").scalar(), totals.select("clean").scalar()
    y_t, y_c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    seen = y_t + y_c
    prior = F.lit(PRIOR) * seen / (n_t + n_c) + F.lit(FLAT)
    t, c = y_t + prior, y_c + prior
    delta = F.log(t / (n_t + PRIOR - y_t)) - F.log(c / (n_c + PRIOR - y_c))
    base = n_t / (n_t + n_c)
    ratio = y_t * F.log(y_t / (seen * base)) + F.when(y_c > 0, y_c * F.log(y_c / (seen * (1 - base)))).otherwise(F.lit(0.0))
    z = F.signum(y_t / seen - base) * F.sqrt(F.greatest(2 * ratio, F.lit(0.0)))
    judged = counts.filter(F.col("toxic") >= MIN_COUNT)
    return judged.select("term", delta.alias("delta"), z.alias("z"), "toxic", "clean").filter((F.col("z") >= least_z(judged.count(), chance_terms)) & (F.col("delta") > 0))


def least_z(judged: int, chance_terms: float = CHANCE_TERMS) -> float:
    """Standard deviations that ``chance_terms`` of ``judged`` terms without any effect exceed."""
    return NormalDist().inv_cdf(1.0 - min(0.5, chance_terms / max(judged, 1)))


def karlin_rate(scores: list[float], shares: list[float]) -> float:
    """The positive root of ``sum p exp(rate s) = 1`` (background tokens cost ``GAP``)."""
    s, p = np.array([-GAP, *scores]), np.array([max(1e-12, 1.0 - sum(shares)), *shares])
    if not scores or float(s @ p) >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while float(p @ np.exp(high * s)) < 1.0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if float(p @ np.exp(mid * s)) < 1.0 else (low, mid)
    return high


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope (never below 0) and offset on smoothed targets, by Newton steps that lower the loss."""
    hits = y.sum()
    target = np.where(y > 0, (hits + 1) / (hits + 2), 1 / (len(y) - hits + 2))
    width = float(x.std()) or 1.0
    design = np.column_stack((x / width, np.ones_like(x)))

    def loss(beta: np.ndarray) -> float:
        m = design @ beta
        return float((np.logaddexp(0.0, m) - target * m).sum() + 5e-4 * beta[0] ** 2)

    flat = np.array([0.0, math.log((hits + 1) / (len(y) - hits + 1))])
    beta = flat
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (p - target) + 1e-3 * beta * [1, 0]
        hess = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if size * np.abs(step).max() < 1e-8:
            break
    slope, offset = beta if beta[0] >= 0 else flat
    return float(slope / width), float(offset)


def train(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> ToxicityModel:
    """Fit on a bounded labelled sample; all folds but the held-out one are used."""
    with scratch_scope(docs.sparkSession):
        return _fit(docs, labels, bound)


def _fit(docs: DataFrame, labels: DataFrame, bound: int) -> ToxicityModel:
    small_batches(docs.sparkSession)
    sample = store(labelled_sample(docs, labels, bound), "toxicity-sample")
    # Bounded by the sample.
    odds = log_odds(store(term_counts(sample.filter("fold <> 3")), "toxicity-terms")).collect()
    model = ToxicityModel(scores={r["term"]: min(MAX_SCORE, r["delta"]) for r in odds})
    least = min((round(s, 2) for s in model.scores.values()), default=1.0)

    def background(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Clean texts: number of tokens (kind 0), texts with a passage of the least score (1), tokens of each score (2)."""
        memory: dict[str, float] = {}
        tally: Counter[tuple[int, float]] = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                words = WORD.findall(text.lower())
                found = model.passages(words, memory)
                tally[0, 0.0] += len(words)
                tally[1, 0.0] += max((s for _, _, s in found), default=0.0) >= least
                tally.update((2, round(s, 2)) for w in words if (s := memory[w]) > 0.0)
        columns = [pa.array(c, t) for c, t in zip(zip(*[(k, s, n) for (k, s), n in tally.items()], strict=True), (pa.int32(), pa.float64(), pa.int64()), strict=False)]
        if columns:
            yield pa.RecordBatch.from_arrays(columns, ["kind", "mark", "n"])

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, float] = {}
        for b in batches:
            found = [(words := WORD.findall(t.lower()), model.passages(words, memory)) for t in b.column(0).to_pylist()]
            values = [model.evidence(p, len(w)) for w, p in found]
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.float64()), pa.array(values, pa.float64())], ["toxic", "value"])

    held_back = sample.filter("fold = 3")
    kinds = {r.toxic: r["count"] for r in held_back.groupBy("toxic").count().collect()}
    n_toxic, n_rows = sum(n for t, n in kinds.items() if t), sum(kinds.values())
    if not n_toxic or n_toxic == n_rows:
        share = n_toxic / n_rows if n_rows else 0.0
        model.offset = math.log((share + 1e-9) / (1 - share + 1e-9))
        return model
    clean = held_back.filter("toxic = 0").select("text").mapInArrow(background, "kind int, mark double, n bigint")
    tally = {(r.kind, r.mark): r.n for r in clean.groupBy("kind", "mark").agg(F.sum("n").alias("n")).collect()}
    n_clean = tally.get((0, 0.0), 0) + 1
    floor = {round(s, 2): 0.5 / len(model.scores) for s in model.scores.values()}
    seen = {s: (tally.get((2, s), 0) + floor[s]) / n_clean for s in floor}
    model.rate = karlin_rate(list(seen), list(seen.values()))
    model.scale = (tally.get((1, 0.0), 0) + 0.5) / (n_clean * math.exp(-model.rate * least))
    # Two numbers for each text of the calibration fold.
    rows = held_back.select("text", "toxic").mapInArrow(evidence, "toxic double, value double").collect()
    model.slope, model.offset = fit_curve(np.array([r.value for r in rows]), np.array([r.toxic for r in rows]))
    return model


def judge(text: str | None, model: ToxicityModel, memory: dict[str, float]) -> tuple[float, list[tuple[int, int, float, float]]]:
    """Score of a whole text and its significant passages (code point range, score, E)."""
    lower = (text or "").lower()
    words = WORD.findall(lower)
    found = model.passages(words, memory)
    value = model.score(model.evidence(found, len(words)))
    strong = [(a, b, s, e) for a, b, s in found if (e := model.expected(s, len(words))) < SIGNIFICANT]
    if strong:
        spans = [m.span() for m in WORD.finditer(lower)]
        strong = [(spans[a][0], spans[b][1], s, e) for a, b, s, e in strong]
    return value, strong


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, passages`` of every whole text."""
    small_batches(docs.sparkSession)
    passage = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, float] = {}
        for b in batches:
            judged = [judge(t, model, memory) for t in b.column(1).to_pylist()]
            spans = [[dict(zip(("start", "end", "score", "expected"), p, strict=True)) for p in ps] for _, ps in judged]
            columns = [b.column(0), pa.array([s for s, _ in judged], pa.float64()), pa.array(spans, pa.list_(passage))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "passages"])

    schema = "doc_id bigint, score double, passages array<struct<start: bigint, end: bigint, score: double, expected: double>>"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score stays below ``threshold``, columns unchanged."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, float] = {}
        for b in batches:
            yield b.filter(pa.array([judge(t, model, memory)[0] < threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
