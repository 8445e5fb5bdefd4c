"""Ranked lexical search by hashed max-sketches.

The index holds, for every whole text, its distinct terms (64-bit hashes), how
often each occurs, and the number of all terms. A term is a maximal run of
``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]``, with only A-Z lower-cased.

A term's impact in a document is ``(10**9 * tf) div (1000 * tf + 12 * m)`` with
the length norm ``m``; a query adds ``weight * impact`` over its terms. A batch
of documents folds its impacts into a sketch: term ``t`` raises coordinate
``hash(t) mod COORDINATES`` to the maximum of what it holds and the impact. The
lookups of a whole block of queries in the sketch give each document an upper
bound per query (an impact can only be raised by a term that shares its
coordinate). Documents are then scored exactly, from the highest bound
downward, until the next bound is below the ``k``-th best score seen by the
task. Each task returns at most ``k`` documents per query; these meet in two
rounds, first inside salted groups of a query, so no task gathers them all.

All arithmetic of scores is on 64-bit integers, so bounds and scores are
exact. Terms are told apart by 64-bit hashes: for ``v`` distinct terms and
``q`` query terms a false match has the chance ``v * q / 2**64``.

Queries are read in blocks of ``BLOCK_ITEMS`` rows, which bounds what is sent
to the workers; every block is run against the whole index.

Edge cases: a null or empty text has no terms, is not counted among the
documents and is never a result; an item without known terms has no results;
equal scores are ordered by document id, nulls last; repeated documents and
repeated items are ranked each for itself; an empty table gives an empty
result. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import small_batches, store, utf8_buffers
from snapmart.llm.shingles import word_hashes

TOP = 20
#: Width of a sketch, a power of two.
COORDINATES = 4096
#: Queries that one job answers at most.
BLOCK_ITEMS = 256
#: Documents of one sketch.
SKETCH_ROWS = 512
#: Groups that the best documents of a query meet in first.
SALT = 64
_ITEM_KEY = "_item"

#: Bytes inside a term: digits, letters and all bytes of longer code points.
_IN_TERM = np.zeros(256, bool)
_IN_TERM[0x30:0x3A] = _IN_TERM[0x41:0x5B] = _IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term (repeats kept) and each row's first term index."""
    return word_hashes(np.where(_IN_TERM[data], data, np.uint8(0x20)), offsets)


def row_terms(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per row its sorted distinct term hashes and their counts."""
    for a, b in zip(first[:-1], first[1:], strict=True):
        yield np.unique(hashes[a:b], return_counts=True)


def build_index(docs: DataFrame) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term (binary, little-endian 64 and 32 bit)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, first = term_hashes(*utf8_buffers(b.column(1)))
            rows = list(row_terms(hashes, first))
            columns = [
                b.column(0),
                pa.array(np.diff(first), pa.int64()),
                pa.array([t.astype("<u8").tobytes() for t, _ in rows], pa.binary()),
                pa.array([c.astype("<u4").tobytes() for _, c in rows], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms binary, tfs binary").filter("n > 0")


@dataclass
class Queries:
    """A block of queries: sorted distinct terms, their weights, and per query term places and repeats."""

    keys: list[int]
    vocabulary: np.ndarray
    weights: np.ndarray
    places: list[np.ndarray]
    repeats: list[np.ndarray]


def parse_queries(rows: list, weights: np.ndarray | None = None) -> Queries:
    """``rows`` of (key, text) as a block; weights are filled in later."""
    texts = pa.array([r[1] or "" for r in rows], pa.string())
    terms = list(row_terms(*term_hashes(*utf8_buffers(texts))))
    vocabulary = np.unique(np.concatenate([t for t, _ in terms] or [np.zeros(0, np.uint64)]))
    places = [np.searchsorted(vocabulary, t) for t, _ in terms]
    return Queries([r[0] for r in rows], vocabulary, np.zeros(vocabulary.size, np.int64), places, [c.astype(np.int64) for _, c in terms])


def _postings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document place, term and count of every posting of an index batch."""
    terms = np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u8")
    tfs = np.frombuffer(b"".join(batch.column("tfs").to_pylist()), "<u4").astype(np.int64)
    sizes = np.diff(np.frombuffer(batch.column("tfs").buffers()[1], np.int32)[batch.column("tfs").offset :][: batch.num_rows + 1]) // 4
    return np.repeat(np.arange(batch.num_rows), sizes), terms, tfs


def document_frequencies(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Documents that hold each term of ``vocabulary`` (sorted); one count per query term comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(vocabulary.size, np.int64)
        for b in batches:
            _, terms, _ = _postings(b)
            at = np.minimum(np.searchsorted(vocabulary, terms), vocabulary.size - 1)
            df += np.bincount(at[vocabulary[at] == terms], minlength=vocabulary.size)
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(df[hit], pa.int64())], ["term", "df"])

    out = np.zeros(vocabulary.size, np.int64)
    if vocabulary.size:
        counts = index.select("terms", "tfs").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
        for term, df in counts.collect():
            out[term] = df
    return out


def length_norms(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """``m`` of documents with ``n`` terms."""
    return 75 + (25 * n * documents) // total


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def max_sketch(doc: np.ndarray, terms: np.ndarray, impact: np.ndarray, rows: int, coordinates: int = COORDINATES) -> np.ndarray:
    """``coordinates x rows`` maxima of the impacts."""
    sketch = np.zeros((coordinates, rows), np.int64)
    np.maximum.at(sketch, ((terms & np.uint64(coordinates - 1)).astype(np.int64), doc), impact)
    return sketch


class Best:
    """The ``k`` best documents of one query that a task has seen."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.rows: list[tuple[int, float, int | None]] = []  # -score, id (nulls last), id

    @property
    def threshold(self) -> int:
        """Score that a further document must reach."""
        return -self.rows[-1][0] if len(self.rows) >= self.k else 1

    def offer(self, scores: np.ndarray, ids: list) -> None:
        more = [(-int(s), math.inf if d is None else d, d) for s, d in zip(scores, ids, strict=True) if s > 0]
        self.rows = sorted(self.rows + more, key=lambda r: r[:2])[: self.k]


def rescore(queries: Queries, q: int, found: np.ndarray, start: np.ndarray, place: np.ndarray, impact: np.ndarray) -> np.ndarray:
    """Exact scores of documents ``found`` for query ``q`` from their postings inside the vocabulary.

    Postings of document ``d`` are ``start[d]`` to ``start[d + 1]``; ``place`` is their place in the vocabulary.
    """
    worth = np.zeros(queries.vocabulary.size, np.int64)
    worth[queries.places[q]] = queries.weights[queries.places[q]] * queries.repeats[q]
    return np.array([int(worth[place[start[d] : start[d + 1]]] @ impact[start[d] : start[d + 1]]) for d in found], np.int64)


def search_batch(queries: Queries, best: list[Best], ids: list, sketch: np.ndarray, start: np.ndarray, place: np.ndarray, impact: np.ndarray, step: int = 32) -> int:
    """Add the documents of one sketch to ``best``; returns how many pairs were scored exactly."""
    mask = np.uint64(sketch.shape[0] - 1)
    coordinate = (queries.vocabulary & mask).astype(np.int64)
    scored = 0
    for q, top in enumerate(best):
        at = queries.places[q]
        if not at.size:
            continue
        bounds = (queries.weights[at] * queries.repeats[q]) @ sketch[coordinate[at]]
        open_ = np.flatnonzero(bounds >= top.threshold)
        open_ = open_[np.argsort(-bounds[open_], kind="stable")]
        for a in range(0, open_.size, step):
            some = open_[a : a + step]
            some = some[bounds[some] >= top.threshold]
            if not some.size:
                break
            top.offer(rescore(queries, q, some, start, place, impact), [ids[d] for d in some])
            scored += some.size
    return scored


def search_block(index: DataFrame, queries: Queries, documents: int, total: int, k: int = TOP) -> DataFrame:
    """``_item, doc_id, score``: at most ``k`` documents per query and task, all of the best among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries.keys]
        for whole in batches:
            for b in (whole.slice(i, SKETCH_ROWS) for i in range(0, whole.num_rows, SKETCH_ROWS)):
                doc, terms, tfs = _postings(b)
                m = length_norms(b.column("n").to_numpy(), documents, total)
                impact = impacts(tfs, m[doc])
                sketch = max_sketch(doc, terms, impact, b.num_rows)
                at = np.minimum(np.searchsorted(queries.vocabulary, terms), queries.vocabulary.size - 1)
                known = queries.vocabulary[at] == terms
                start = np.searchsorted(doc[known], np.arange(b.num_rows + 1))
                search_batch(queries, best, b.column("doc_id").to_pylist(), sketch, start, at[known], impact[known])
        rows = [(key, d, -s) for key, top in zip(queries.keys, best, strict=True) for s, _, d in top.rows]
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [_ITEM_KEY, "doc_id", "score"])

    return index.mapInArrow(run, f"{_ITEM_KEY} bigint, doc_id bigint, score bigint")


def search(index: DataFrame, items: DataFrame, k: int = TOP, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of ``index`` for each row of ``items`` (item_id, text)."""
    spark = index.sparkSession
    small_batches(spark)
    # One number per item row, kept by the stored copy.
    keyed = store(items.select("item_id", F.col("text").cast("string")).withColumn(_ITEM_KEY, F.monotonically_increasing_id()), "search-items")
    size = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = None
    after = -1
    while size[1]:
        # A block has a bounded number of rows: they are the queries, not the corpus.
        rows = [(r[0], r[1]) for r in keyed.filter(F.col(_ITEM_KEY) > after).orderBy(_ITEM_KEY).limit(block_items).select(_ITEM_KEY, "text").collect()]
        if not rows:
            break
        after = rows[-1][0]
        queries = parse_queries(rows)
        if not queries.vocabulary.size:
            continue
        df = document_frequencies(index, queries.vocabulary)
        queries.weights = np.array([math.floor(1000 * math.log((2 * size[0] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        block = search_block(index, queries, size[0], size[1], k)
        found = block if found is None else found.unionByName(block)
    if found is None:
        found = spark.createDataFrame([], f"{_ITEM_KEY} bigint, doc_id bigint, score bigint")
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    salted = Window.partitionBy(_ITEM_KEY, F.pmod(F.xxhash64("doc_id"), F.lit(SALT))).orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= k).drop("rank")
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(_ITEM_KEY).orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.join(keyed.drop("text"), _ITEM_KEY).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """Index ``docs`` in the shared folder, then rank them for every item."""
    return search(store(build_index(docs), "search-index"), items, k)
