"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies, its
source's target over its source's size. The whole part is taken as it is; the
fractional parts are rounded by the pivotal method: two documents meet, mass
moves at random from one to the other (each keeps its expectation) until one
of them is 0 or 1, and the other goes on to the next. Documents meet in the
order of their size, so mass moves between documents of like size and the
words taken stay near the target.

The rounding is a reduction tree. Documents of a source are dealt by hash to
groups of about ``GROUP`` rows, each rounded in one task. A group leaves at
most one open document; the open documents of ``FAN`` groups meet on the next
level, until one per source is left, which is drawn. A source with a third of
all rows is simply many groups. Repeats of one row are numbered (in each task,
then over the tasks that hold the row), so they are dealt to many groups as
well. Targets take one row per source. The random numbers are hashes of the
document, its number among equal rows and the level, so reruns agree.

Edge cases: a null text has size 0; a null source is a source, the last one,
and nulls in any column tell rows apart;
repeated rows are documents of their own (they meet like any others); a
source of size 0 has target 0 and its documents are not taken; an empty table
gives an empty result. Further columns of the input are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import small_batches, store, store_alone, utf8_buffers
from snapmart.llm.shingles import mix, word_counts

#: Weights by the rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: A source is taken at most so many times.
MAX_REPEAT = 3
GROUP = 1024
FAN = 64


def row_key() -> Column:
    """Hash of a document row; only repeats of a row share it."""
    names = ("doc_id", "source", "text")
    return F.xxhash64(*names, *[F.isnull(c) for c in names])


def sizes(docs: DataFrame, at: Sequence[str] = ()) -> DataFrame:
    """``doc_id, source, key, size, task, nth`` of every whole text, and ``at_0 ...`` for the columns of ``at``.

    ``size`` is the number of words; ``key`` is the hash of the row, ``nth``
    numbers equal rows inside the task that read them.
    """
    small_batches(docs.sparkSession)
    places = [f"at_{i}" for i in range(len(at))]
    names = ["doc_id", "source", "key", *places, "size", "task", "nth"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for b in batches:
            nth = []
            for k in b.column(2).to_pylist():
                nth.append(seen[k])
                seen[k] += 1
            n = word_counts(*utf8_buffers(b.column(b.num_columns - 1)))
            columns = [*b.columns[:-1], pa.array(n, pa.int64()), pa.array([task] * len(nth), pa.int32()), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kept = [F.col(c).cast("bigint").alias(p) for c, p in zip(at, places, strict=True)]
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), row_key().alias("key"), *kept, F.col("text").cast("string"))
    more = "".join(f"{p} bigint, " for p in places)
    return rows.mapInArrow(count, f"doc_id bigint, source string, key bigint, {more}size bigint, task int, nth bigint")


def number_repeats(sized: DataFrame) -> DataFrame:
    """``sized`` with ``uid``, a hash that tells equal rows apart; a row without repeats keeps its key.

    The running sum sees one row for each task that holds a key.
    """
    held = sized.groupBy("key", "task").agg((F.max("nth") + 1).alias("n"))
    ahead = Window.partitionBy("key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    later = held.select(F.col("key").alias("_key"), F.col("task").alias("_task"), F.sum("n").over(ahead).alias("_ahead")).filter("_ahead > 0")
    both = (F.col("key") == F.col("_key")) & (F.col("task") == F.col("_task"))
    nth = F.col("nth") + F.coalesce("_ahead", F.lit(0))
    uid = F.when(nth == 0, F.col("key")).otherwise(F.xxhash64("key", nth))
    return sized.join(later, both, "left").withColumn("uid", uid).drop("_key", "_task", "_ahead", "task", "nth")


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``source, source_size, n_docs, target`` of every source.

    All words are shared by weight under the caps. The excess reshared again
    and again ends where every uncapped source has the same words per unit of
    weight; sorted by cap per weight, that level is found with running sums.
    The windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.get(table, F.pmod(rank, F.lit(len(weights)))))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    # The first uncapped source in this order has the level of all later ones.
    open_ = F.col("level") * F.col("weight") <= F.col("cap")
    shared = F.first(F.when(open_, F.col("level")), ignorenulls=True).over(Window.partitionBy())
    target = F.least(F.col("cap"), F.coalesce(shared, F.col("level")) * F.col("weight"))
    return per.select("source", "source_size", "n_docs", target.alias("target"))


def _uniform(keys: np.ndarray, level: int) -> np.ndarray:
    seeded = mix(keys.astype(np.uint64) ^ mix(np.full(1, level + 1, np.uint64)))
    return (seeded >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def pivotal(p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Round ``p`` one meeting after the other; returns the values and the open index or -1."""
    out = p.copy()
    held = -1
    for i in range(out.size):
        if out[i] <= 0.0 or out[i] >= 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = out[held], out[i]
        total = a + b
        if total < 1.0:
            # One gives all it has to the other.
            if u[i] * total < b:
                out[held], out[i], held = 0.0, total, i
            else:
                out[held], out[i] = total, 0.0
        else:
            # One is filled up to 1, the other keeps the rest.
            if u[i] * (2.0 - total) < 1.0 - b:
                out[held], out[i] = 1.0, total - 1.0
                held = i
            else:
                out[held], out[i] = total - 1.0, 1.0
        if held >= 0 and (out[held] < 1e-9 or out[held] > 1.0 - 1e-9):
            out[held] = round(out[held])
            held = -1
    return out, held


_STATE = "doc_id bigint, source string, uid bigint, size bigint, chance double, grp bigint, extra int"


def _round_level(state: DataFrame, level: int, last: bool) -> DataFrame:
    """One level: round each group; ``extra`` stays null for the open document.

    ``state`` has the columns of ``_STATE`` and those that tell a row's place, in this order.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "uid"], ascending=[False, True], kind="stable").reset_index(drop=True)
        u = _uniform(pdf["uid"].to_numpy(np.int64).view(np.uint64) + np.arange(len(pdf), dtype=np.uint64), level)
        got, held = pivotal(pdf["chance"].to_numpy(np.float64), u)
        if held >= 0 and last:
            got[held] = float(u[held] < got[held])
            held = -1
        extra = pd.Series(np.rint(got).astype(np.int32), dtype="Int32")
        if held >= 0:
            extra[held] = pd.NA
        pdf["chance"], pdf["extra"] = got, extra
        return pdf

    places = [c for c in state.columns if c.startswith("at_")]
    return state.groupBy("source", "grp").applyInPandas(run, _STATE + "".join(f", {p} bigint" for p in places))


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT, at: Sequence[str] = ()) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every document.

    ``at`` names columns of ``docs`` (whole numbers) that tell a row's place; they come out as ``at_0 ...``.
    """
    places = [f"at_{i}" for i in range(len(at))]
    sized = store(sizes(docs, at), "mix-sizes")
    targets = store(source_targets(sized, weights, max_repeat), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + 1e-12)
    groups = F.ceil(F.col("n_docs") / F.lit(GROUP)).cast("bigint")
    rates = targets.select(
        F.col("source").alias("_source"), "source_size", "target", whole.alias("whole"), F.greatest(ratio - whole, F.lit(0.0)).alias("chance"), groups.alias("groups")
    )
    joined = number_repeats(sized).join(rates, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    state = joined.select(
        "doc_id", "source", "uid", "size", "chance", F.pmod("uid", F.col("groups")).alias("grp"), F.lit(None).cast("int").alias("extra"), *places
    )
    most = targets.agg(F.max(F.ceil(F.col("n_docs") / F.lit(GROUP)))).first()[0] or 1
    levels = 1 + (math.ceil(math.log(most, FAN) - 1e-9) if most > 1 else 0)
    settled = []
    for level in range(levels):
        last = level == levels - 1
        done = store(_round_level(state, level, last), f"mix-level{level}")
        settled.append(done.filter(F.col("extra").isNotNull()))
        state = done.filter(F.col("extra").isNull()).withColumn("grp", F.floor(F.col("grp") / F.lit(FAN)))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    out = out.join(rates.drop("groups", "chance"), F.col("source").eqNullSafe(F.col("_source")))
    copies = (F.col("whole") + F.col("extra")).cast("int")
    return out.select("doc_id", "source", *places, "size", "source_size", F.col("target").cast("double"), copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def take_copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``docs``, each row as many times as the mix takes it, columns unchanged.

    Rows and copy counts meet on the row's place: its file (by hash) and number
    in the file where ``docs`` is a stored table as it stands, else a number that
    is stored with a copy of the rows.
    """
    row = F.struct(*docs.columns).alias("_row")
    if docs.inputFiles():
        held = docs.select(F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"), row)
    else:
        held = store(docs.select(F.lit(0).cast("bigint").alias("_file"), F.monotonically_increasing_id().alias("_index"), row), "mix-rows")
    flat = held.select("_file", "_index", "_row.doc_id", "_row.source", "_row.text")

    def counted() -> DataFrame:
        return mix_sources(flat, weights, max_repeat, at=("_file", "_index")).filter(F.col("copies") > 0).select("at_0", "at_1", "copies")

    counts = store_alone(docs.sparkSession, counted, "mix-counts")
    # The counts grow with the rows, so they are never broadcast, at no size.
    taken = held.join(counts.hint("merge"), (F.col("_file") == F.col("at_0")) & (F.col("_index") == F.col("at_1")))
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
