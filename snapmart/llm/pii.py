"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans are the exact patterns of four kinds; matches that fail their check
(octets, Luhn, number of digits) are dropped without a second try. All pattern
matches, and looser ones (separated numbers without a plus, spelled-out mail
addresses, IPv6 addresses), are candidates. Four labelers vote +1, 0 or -1 on
each: the pattern and its check, a gazetteer (top-level domains, card number
ranges, address ranges, calling codes), the words before it, and whether it
stands alone.

The votes of all candidates of the corpus are counted per kind and combination
(at most ``3**4`` each), and expectation-maximisation estimates each labeler's
reliability and each combination's chance to be personal data, without labels.
A vote of 0 abstains and says nothing. Candidates without a pattern vote have a
prior of their own, at least even: how often pattern matches or other loose
ones are personal data does not speak against them. Standing alone is no evidence by itself, so where no other labeler
votes the chance stays at one half. Loose matches that overlap a base span are
no candidates, since the span is found already.
With these chances as soft targets a logistic span classifier is trained on
the candidates' signatures (votes, digits, separators, neighbours), weighted
by their counts; the ``MAX_SIGNATURES`` commonest are used, a documented bound.
Candidates over ``ADD`` that touch no base span are added; base spans stay.

Edge cases: a null text is empty and has no spans; candidates that overlap are
taken from the left, the longer first; repeated rows have the same spans; with
no candidates at all nothing is added. Positions are code points. Runs of any
length are scanned once. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import small_batches, store
from snapmart.sources.scratch import scratch_scope

KINDS = ("email", "ip", "card", "phone")
ADD = 0.9
MAX_SIGNATURES = 20_000
LABELERS = ("pattern", "gazetteer", "context", "alone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits, so runs are entered at their start.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{2,4}\)?(?:[\x20.-]\(?[0-9]{2,4}\)?){1,4}(?![0-9A-Za-z])")
_LOOSE_IP = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9a-fA-F]{1,4}:){3,7}[0-9a-fA-F]{1,4}(?![0-9A-Za-z:])")
_LOOSE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[{]at[)\]}]\x20?[A-Za-z0-9-]+(?:\x20?(?:\.|[(\[{]dot[)\]}])\x20?[A-Za-z0-9-]+)+")

# Gazetteers and context words.
_DOMAINS = frozenset("com org net edu gov mil int info biz io co us uk de fr es it nl ch at eu ca au jp cn in br ru pl se no dk fi pt mx ar".split())
_CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 420".split())
_NEAR = {
    "email": frozenset("email mail e-mail contact write correo courriel kontakt adresse reach".split()),
    "ip": frozenset("ip address host server addr adresse dirección login from".split()),
    "card": frozenset("card visa mastercard credit karte kreditkarte tarjeta carte payment paid".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax contact telefon téléphone teléfono rufnummer ruf".split()),
}
_AGAINST = frozenset("version license lizenz licence licencia isbn issn token key id page chapter section rfc build release v".split())


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (n * 2 - 9 if n > 4 else n * 2)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_matches(text: str) -> list[tuple[str, int, int, bool]]:
    """All pattern matches ``(kind, start, end, passes its check)``, left to right per kind."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if m and start < at:
            end = m.end()
            out.append(("email", start, end, True))
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            out.append(("ip", m.start(), m.end(), all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _only_digits(m.group())
                if len(digits) >= 13:
                    out.append(("card", m.start(), m.end(), 14 <= len(digits) <= 19 and luhn(digits)))
        for m in _PHONE.finditer(text):
            out.append(("phone", m.start(), m.end(), 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15))
    return out


def loose_matches(text: str) -> list[tuple[str, int, int]]:
    """Further candidates of looser patterns."""
    out = []
    if "at)" in text or "at]" in text or "at}" in text:
        out += [("email", m.start(), m.end()) for m in _LOOSE_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        out += [("phone", m.start(), m.end()) for m in _LOOSE_PHONE.finditer(text) if 7 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
        if ":" in text:
            out += [("ip", m.start(), m.end()) for m in _LOOSE_IP.finditer(text)]
    return out


def _gazetteer(kind: str, found: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[.\x20)\]}]", found.lower())[-1] in _DOMAINS else -1
    digits = _only_digits(found)
    if kind == "card":
        return 1 if digits[:1] == "4" or "51" <= digits[:2] <= "55" or digits[:2] in ("34", "37") or digits[:4] == "6011" else -1
    if kind == "ip":
        if ":" in found:
            return 0
        first = found.split(".", 1)[0].lstrip("0")
        return 1 if first and len(first) <= 3 and int(first) < 224 else -1
    if found[0] != "+":
        return 0
    return 1 if any(digits[:n] in _CALLING for n in (1, 2, 3)) else -1


def signature(text: str, kind: str, start: int, end: int, pattern: int) -> str:
    """Votes and surface features of a candidate, as a short text."""
    found = text[start:end]
    words = [w.strip(".,:;()=\"'") for w in text[max(0, start - 60) : start].lower().split()[-5:]]
    context = 1 if _NEAR[kind].intersection(words) else -1 if _AGAINST.intersection(words) else 0
    before, after = text[start - 1 : start], text[end : end + 1]
    alone = -1 if before.isalnum() or after.isalnum() or before in tuple("=\"'/_") and before else 1
    digits = min(20, sum("0" <= c <= "9" for c in found))
    marks = "".join(c for c in " -.()+:@" if c in found)
    return f"{kind}|{pattern},{_gazetteer(kind, found)},{context},{alone}|d{digits}|s{marks}|a{_place(before)}{_place(after)}"


def _place(c: str) -> str:
    return "_" if not c or c.isspace() else "w" if c.isalpha() else "9" if c.isdigit() else "p"


def candidates(text: str) -> list[tuple[str, int, int, bool, str]]:
    """``(kind, start, end, base, signature)`` of all candidates."""
    found = base_matches(text)
    out = [(k, s, e, ok, signature(text, k, s, e, 1 if ok else -1)) for k, s, e, ok in found]
    taken = {(k, s, e) for k, s, e, _ in found}
    base = sorted((s, e) for _, s, e, ok in found if ok)
    starts = [s for s, _ in base]
    ends = list(accumulate((e for _, e in base), max))  # the farthest end up to each start
    for k, s, e in loose_matches(text):
        before = bisect_left(starts, e)
        if (k, s, e) not in taken and not (before and ends[before - 1] > s):
            out.append((k, s, e, False, signature(text, k, s, e, 0)))
    return out


_CANDIDATE = "kind: string, start: bigint, end: bigint, base: boolean, signature: string"


def find_candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, found`` (array of candidates) of every whole text."""
    small_batches(docs.sparkSession)
    names = ("kind", "start", "end", "base", "signature")
    item = pa.struct(list(zip(names, (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(names, c, strict=True)) for c in candidates(t or "")] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(item))], ["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, f"doc_id bigint, found array<struct<{_CANDIDATE}>>")


# ------------------------------------------------------------------ learning


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over vote combinations: prior, ``tables[class, labeler, vote]`` and each combination's chance.

    Starts from the majority; votes are -1, 0, 1. A 0 is left out of the
    likelihood (its table entry is 1 in both classes). Combinations without a
    vote of the first labeler have a prior of their own, at least even; those
    with no vote but the last labeler's for it stay at one half and teach
    nothing, those with votes against and no other for it stay at 0.05 at most.
    Five votes of
    smoothing, nine in ten of them right, keep every table entry positive and
    the classes in place where one of them is hardly seen.
    """
    voted = votes != 0
    silent = ~voted[:, :-1].any(axis=1) & (votes[:, -1] >= 0)
    most = np.where(silent, 0.5, np.where((votes[:, :-1] <= 0).all(axis=1), 0.05, 1.0))
    counts = np.where(silent, 0.0, counts)
    chance = np.minimum(most, np.clip(0.5 + votes.sum(axis=1) / (2.0 * votes.shape[1]), 0.05, 0.95))
    column = votes + 1
    tables = np.ones((2, votes.shape[1], 3))
    prior = np.empty(len(votes))
    for _ in range(rounds):
        for y, weight in ((1, counts * chance), (0, counts * (1 - chance))):
            for j in range(votes.shape[1]):
                held = np.bincount(column[:, j], weights=weight, minlength=3) + (0.5, 0.0, 4.5)[:: 1 if y else -1]
                tables[y, j, ::2] = held[::2] / held[::2].sum()
        for g, least in ((voted[:, 0], 0.0), (~voted[:, 0], 0.5)):
            prior[g] = max(least, (counts[g] @ chance[g] + 1) / (counts[g].sum() + 2))
        logs = [np.log(tables[y])[np.arange(votes.shape[1]), column].sum(axis=1) for y in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1] + np.log(1 - prior) - np.log(prior), -50, 50)))
        new = np.where(silent, 0.5, np.minimum(new, most))
        settled = np.abs(new - chance).max() < 1e-9
        chance = new
        if settled:
            break
    return float((counts @ chance + 1) / (counts.sum() + 2)), tables, chance


def features(sig: str) -> list[str]:
    """Classifier features of a signature; all are per kind."""
    kind, votes, *rest = sig.split("|", 4)
    names = [f"{kind}:{name}:{v}" for name, v in zip(LABELERS, votes.split(","), strict=True)]
    return [kind, *names, *(f"{kind}:{r}" for r in rest)]


class SpanClassifier:
    """Logistic regression over the features of signatures."""

    def __init__(self, weights: dict[str, float], labelers: dict[str, np.ndarray]) -> None:
        self.weights, self.labelers = weights, labelers

    def chance(self, sig: str) -> float:
        total = sum(self.weights.get(f, 0.0) for f in features(sig))
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, total))))


def train(found: DataFrame, bound: int = MAX_SIGNATURES) -> SpanClassifier:
    """EM over all candidates' votes, then the classifier over the commonest signatures."""
    each = found.select(F.explode("found.signature").alias("signature"))
    counted = store(each.groupBy("signature").agg(F.count(F.lit(1)).alias("n")), "pii-signatures")
    parts = F.split("signature", "\\|")
    # At most 4 kinds times 3**4 combinations.
    combos = counted.groupBy(parts[0].alias("kind"), parts[1].alias("votes")).agg(F.sum("n").alias("n")).orderBy("kind", "votes").collect()
    labelers, chance = {}, {}
    for kind in KINDS:
        rows = [r for r in combos if r.kind == kind]
        if rows:
            votes = np.array([[int(v) for v in r.votes.split(",")] for r in rows])
            _, labelers[kind], p = reliabilities(votes, np.array([float(r.n) for r in rows]))
            chance |= {(kind, r.votes): float(c) for r, c in zip(rows, p, strict=True)}
    rows = counted.orderBy(F.desc("n"), "signature").limit(bound).collect()
    names = sorted({f for r in rows for f in features(r.signature)})
    index = {f: i for i, f in enumerate(names)}
    weights = np.zeros(len(names))
    if rows:
        hot = [[index[f] for f in features(r.signature)] for r in rows]
        target = np.array([chance[tuple(r.signature.split("|")[:2])] for r in rows])
        # Counts are damped so that rare shapes are learned too.
        weight = np.log1p(np.array([float(r.n) for r in rows]))
        x = np.zeros((len(rows), len(names)), np.float32)
        for i, h in enumerate(hot):
            x[i, h] = 1.0
        step = 0.5 / (weight.sum() + 1.0)  # below the bound for eight features a row
        speed = np.zeros(len(names))
        for _ in range(400):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            grad = x.T @ (weight * (p - target)) + 0.01 * weights
            speed = 0.9 * speed - step * grad
            weights = weights + speed
    return SpanClassifier(dict(zip(names, weights.tolist(), strict=True)), labelers)


def decide(found: list[dict], model: SpanClassifier, memory: dict[str, float]) -> tuple[list[tuple], list[tuple]]:
    """Base spans and all spans of one text, both by start, then kind."""
    order = {k: i for i, k in enumerate(KINDS)}
    base = sorted(((c["start"], order[c["kind"]], c["end"]) for c in found if c["base"]))
    spans = [(s, e) for s, _, e in base]
    added = []
    for c in sorted((c for c in found if not c["base"]), key=lambda c: (c["start"], -c["end"], order[c["kind"]])):
        sig = c["signature"]
        if sig not in memory:
            memory[sig] = model.chance(sig)
        if memory[sig] >= ADD and all(c["end"] <= s or e <= c["start"] for s, e in spans):
            added.append((c["start"], order[c["kind"]], c["end"]))
            spans.append((c["start"], c["end"]))
    return base, sorted(base + added)


def to_text(spans: list[tuple]) -> str:
    """``kind:start:end`` joined by commas."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``; counts are of base spans."""
    found = store(find_candidates(docs), "pii-candidates")
    model = train(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, float] = {}
        for b in batches:
            judged = [decide(f, model, memory) for f in b.column(1).to_pylist()]
            counts = [pa.array([sum(k == i for _, k, _ in base) for base, _ in judged], pa.int64()) for i in range(len(KINDS))]
            digests = pa.array([hashlib.sha256(to_text(base).encode()).hexdigest() for base, _ in judged], pa.string())
            spans = pa.array([to_text(every) for _, every in judged], pa.string())
            more = pa.array([len(every) - len(base) for base, every in judged], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, digests, spans, more], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    schema = "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string, n_added bigint"
    return found.mapInArrow(run, schema)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``<kind>``; ``n_chars`` follows, all else stays."""
    with scratch_scope(docs.sparkSession):
        model = train(store(find_candidates(docs), "pii-candidates"))
    at = docs.columns.index("text")
    length_at = docs.columns.index("n_chars")

    def masked(text: str | None, memory: dict[str, float]) -> str | None:
        if not text:
            return text
        names = ("kind", "start", "end", "base", "signature")
        _, spans = decide([dict(zip(names, c, strict=True)) for c in candidates(text)], model, memory)
        out, end = [], 0
        for s, k, e in spans:
            if s >= end:  # base spans of two kinds may overlap
                out.append(text[end:s])
                out.append(f"<{KINDS[k]}>")
            end = max(end, e)
        return "".join(out) + text[end:] if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, float] = {}
        for b in batches:
            old = b.column(at).to_pylist()
            new = [masked(t, memory) for t in old]
            lengths = [n if a == t else len(t) for a, t, n in zip(old, new, b.column(length_at).to_pylist(), strict=True)]
            columns = list(b.columns)
            columns[at], columns[length_at] = pa.array(new, b.column(at).type), pa.array(lengths, b.column(length_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)
