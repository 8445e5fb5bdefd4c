"""Document fingerprints by one-permutation MinHash.

The 5-word shingles of a text are hashed once. The top bits of a hash choose
one of ``BINS`` bins, and each bin keeps its smallest hash. Empty bins are
filled by optimal densification: each bin has its own fixed random order of
all bins and copies the first non-empty one in it, so two texts with the same
filled bins agree on every copy and the collision rate stays that of the
Jaccard similarity. Of each bin the lowest ``BITS`` bits are packed. Two
different values agree in these bits with probability ``2**-BITS``; the
estimate takes that share off again.

Edge cases: words are case-sensitive here, and a text with fewer than five
words is one shingle. A null text is an empty one; a text without words has
the fingerprint ``""``, like another such text (1.0) and unlike all others
(0.0). Equal texts have equal fingerprints, so repeated rows do too. Extra
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import small_batches, utf8_buffers
from snapmart.llm.shingles import mix, text_shingles

BINS = 512
BITS = 4
#: Ids of one ordered range, as long as there are at most ``MAX_RANGES``; beyond
#: that ranges get longer (they are streamed, so only their number is held).
RANGE_ROWS = 512
MAX_RANGES = 65536
_TOP = np.uint64(64 - int(np.log2(BINS)))
_EDGES = np.arange(BINS, dtype=np.uint64) << _TOP
_TRIES = 16


def _orders() -> np.ndarray:
    """One fixed random order of all bins per bin."""
    keys = mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(1)).reshape(BINS, BINS)
    return np.argsort(keys, axis=1, kind="stable").astype(np.int16)


_ORDERS = _orders()


def minima(hashes: np.ndarray) -> np.ndarray:
    """Smallest hash of every bin of a non-empty set, empty bins densified."""
    ordered = np.sort(hashes)
    at = np.searchsorted(ordered, _EDGES)
    value = ordered[np.minimum(at, ordered.size - 1)]
    filled = (at < ordered.size) & ((value >> _TOP) == np.arange(BINS, dtype=np.uint64))
    empty = np.flatnonzero(~filled)
    step = _TRIES
    done = 0
    while empty.size:
        tried = _ORDERS[empty, done : done + step]
        ok = filled[tried]
        hit = ok.any(axis=1)
        donor = tried[np.arange(empty.size), ok.argmax(axis=1)]
        value[empty[hit]] = value[donor[hit]]
        empty = empty[~hit]
        done, step = done + step, step * 4
    return value


def pack(hashes: np.ndarray) -> np.ndarray:
    """Low bits of the minima, two bins per byte; empty for an empty set."""
    if hashes.size == 0:
        return np.zeros(0, np.uint8)
    low = (mix(minima(hashes)) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return (low[0::2] << BITS) | low[1::2]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Bias-corrected share of equal bins, 0 to 1."""
    if a.size == 0 or b.size == 0:
        return float(a.size == b.size)
    differing = a ^ b
    same = int(np.count_nonzero((differing & 0x0F) == 0) + np.count_nonzero((differing & 0xF0) == 0))
    chance = 2.0**-BITS
    return float(min(1.0, max(0.0, (same / BINS - chance) / (1.0 - chance))))


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """Packed fingerprint of each text."""
    data, offsets = utf8_buffers(pa.array(texts, pa.large_string()))
    hashes, at = text_shingles(data, offsets, lower=False)
    return [pack(hashes[at[i] : at[i + 1]]) for i in range(len(texts))]


def to_text(packed: np.ndarray) -> str:
    """Fingerprint as base64 text."""
    return base64.b64encode(packed.tobytes()).decode("ascii")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every whole text, in any order."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows = [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([to_text(p) for p in fingerprints(texts)], pa.string())]
            yield pa.RecordBatch.from_arrays(rows, ["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string")


def ordered_ranges(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rng, tail, doc_id, text``: contiguous ranges of ids, each followed by its successor row.

    Only the ids are sorted. They are cut into ranges of a bounded number of
    different ids; the first id of the next range (of the first range, for the
    last one) is sent along as a ``tail`` row, so each range can be read alone.
    """
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    n = ids.count()
    parts = min(MAX_RANGES, max(1, -(-n // range_rows)))
    ranged = ids.dropna().distinct().repartitionByRange(parts, "doc_id").select(F.spark_partition_id().alias("part"), "doc_id")
    firsts = ranged.groupBy("part").agg(F.min("doc_id").alias("first_id"))
    starts = [r[0] for r in firsts.select("first_id").collect()] or [0]
    starts.sort()
    n_ranges = len(starts)
    first_set = np.array(starts, dtype=np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = b.column(0).fill_null(int(first_set[0])).to_numpy(zero_copy_only=False)
            rng = np.maximum(np.searchsorted(first_set, known, side="right") - 1, 0)
            is_first = (first_set[rng] == known) & b.column(0).is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(rng), pa.array(np.zeros(len(rng), bool)), b.column(0), b.column(1)], ["rng", "tail", "doc_id", "text"])
            again = np.flatnonzero(is_first)
            if again.size:
                kept = b.take(pa.array(again))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((rng[again] - 1) % n_ranges), pa.array(np.ones(again.size, bool)), kept.column(0), kept.column(1)], ["rng", "tail", "doc_id", "text"]
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(deal, "rng bigint, tail boolean, doc_id bigint, text string")


def edit(text: str, following: str) -> str:
    """``text`` with its last half replaced by the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def compare_with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of each text and of its half-replaced edit, and their likeness.

    The next document is the next row by ``(doc_id, text)``; after the last id
    comes the smallest. Null ids stand before all others.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row = None
        for b in batches:
            texts = [t or "" for t in b.column(3).to_pylist()]
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), texts, fingerprints(texts), strict=True))
            if open_row is not None:
                rows.insert(0, open_row)
            open_row = None if not rows or rows[-1][1] else rows[-1]
            yield compared([(r, q) for r, q in zip(rows, rows[1:]) if not r[1] and r[0] == q[0]])
        if open_row is not None:
            yield compared([(open_row, open_row)])

    def compared(pairs: list) -> pa.RecordBatch:
        edited = [edit(r[3], q[3]) for r, q in pairs]
        prints = fingerprints(edited)
        columns = [
            pa.array([r[2] for r, _ in pairs], pa.int64()),
            pa.array([len(r[3]) for r, _ in pairs], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([to_text(r[4]) for r, _ in pairs], pa.string()),
            pa.array([to_text(p) for p in prints], pa.string()),
            pa.array([likeness(r[4], p) for (r, _), p in zip(pairs, prints, strict=True)], pa.float64()),
            pa.array([likeness(r[4], q[4]) for r, q in pairs], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _COMPARED.split(", ")])

    dealt = ordered_ranges(docs, range_rows).repartition("rng")
    return dealt.sortWithinPartitions("rng", "tail", F.col("doc_id").asc_nulls_first(), "text").mapInArrow(run, _COMPARED)
