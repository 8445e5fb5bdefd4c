"""Whitening of embeddings with Spark MLlib's distributed block matrices.

Vectors that are null or hold null or non-finite entries are dropped. Each
entry ``c`` becomes the integer ``x = floor(64 * c) + 1000000``; all sums of x
are exact. Rows are gathered into blocks of ``ROWS`` centred rows with an index
of their own (the last rows of a task are filled up with zero rows, which add
nothing to any product), and the blocks form a ``BlockMatrix`` A. Its
transpose times itself is the scatter; the middle dimension is split, so many
tasks multiply and only ``dim x dim`` sums meet. ``eigh`` of the covariance is
local: it has ``dim x dim`` numbers whatever the table holds. A second
multiplication, by the whitening matrix (eigenvectors over the square roots of
their eigenvalues), projects all rows.

Edge cases: ``64 * c`` is cut off at ``LARGEST``; a ``deviation`` beyond 64 bits
is null; vectors of another length than most remaining ones have (of
equally common lengths the longest) are dropped too; directions without variance have
``whitened`` 0 and take no part in ``identity_error``; repeated rows are rows;
a null id is kept; an empty table or empty vectors give an empty result. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import store

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: ``64 * c`` is cut off beyond this size, so that x is a 64-bit integer.
LARGEST = float(1 << 40)
#: Rows of a block.
ROWS = 512
#: Blocks that one task multiplies, about.
BLOCKS_PER_TASK = 64
#: Eigenvalues below this share of the largest count as none.
NO_VARIANCE = 1e-12


def usable(vector: str) -> Column:
    """Whether a vector is there and all its entries are finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, x``: the usable vectors of the commonest length as integers."""
    doubles = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")).filter(usable("v"))
    lengths = doubles.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    # One row for each length that occurs.
    dim = lengths.orderBy(F.desc("n"), F.desc("dim")).limit(1).select("dim").scalar()
    bounded = lambda c: F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform("v", lambda c: F.floor(bounded(c)) + F.lit(SHIFT).cast("bigint"))
    return doubles.filter(F.size("v") == dim).select("vec_id", x.alias("x"))


_BLOCK = "part bigint, seq bigint, vec_ids array<bigint>, x binary"


def into_blocks(rows: DataFrame, size: int = ROWS) -> DataFrame:
    """``part, seq, vec_ids, x``: runs of at most ``size`` rows of a task, x row by row as 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def block(chunk: pa.Table) -> pa.RecordBatch:
            x = chunk.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<i8")
            columns = [pa.array([part]), pa.array([seq]), pa.array([chunk.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "seq", "vec_ids", "x"])

        for b in batches:
            held.append(b)
            table = pa.Table.from_batches(held)
            while table.num_rows >= size:
                yield block(table.slice(0, size))
                seq += 1
                table = table.slice(size)
            held = table.to_batches()
        if held and sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return rows.mapInArrow(run, _BLOCK)


def numbered(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``block``, a gapless number: a running sum over one count per task."""
    counts = blocks.groupBy(F.col("part").alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("before"))
    return blocks.join(offsets, F.col("part") == F.col("_part")).select((F.col("before") + F.col("seq")).alias("block"), "vec_ids", "x")


def column_sums(blocks: DataFrame, dim: int) -> tuple[int, np.ndarray]:
    """Rows and exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0).to_pylist():
                x = np.frombuffer(raw, "<i8").reshape(-1, dim)
                columns = [pa.array(c, pa.int64()) for c in (np.arange(-1, dim), np.concatenate(([len(x)], x.sum(axis=0))))]
                yield pa.RecordBatch.from_arrays(columns, ["at", "value"])

    sums = blocks.select("x").mapInArrow(run, "at bigint, value bigint").groupBy("at").agg(F.sum("value").alias("value")).collect()
    table = dict((r.at, r.value) for r in sums)
    return table.get(-1, 0), np.array([table.get(i, 0) for i in range(dim)], np.int64)


def differences(raw: bytes, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S`` of each row, exact; Python integers where 64 bits may not do."""
    x = np.frombuffer(raw, "<i8").reshape(-1, sums.size)
    if x.size and n * int(np.abs(x).max()) >= 1 << 61:
        return n * x.astype(object) - sums.astype(object)
    return n * x - sums


def centred(raw: bytes, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n`` from the exact difference."""
    return (differences(raw, n, sums) / n).astype(np.float64)


def exact_deviation(raw: bytes, n: int, sums: np.ndarray) -> list[int | None]:
    """``sum (n * x - S) ** 2`` of each row, without rounding."""
    d = differences(raw, n, sums)
    if d.size and int(np.abs(d).max()) ** 2 * sums.size >= 1 << 63:
        d = d.astype(object)
    return [int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1)]


def block_matrix(blocks: DataFrame, n: int, sums: np.ndarray, count: int, size: int = ROWS) -> BlockMatrix:
    """The centred rows as a distributed matrix; missing rows of a block are zero."""
    dim = sums.size

    def build(row) -> tuple[tuple[int, int], DenseMatrix]:
        full = np.zeros((size, dim))
        rows = centred(row.x, n, sums)
        full[: len(rows)] = rows
        return (row.block, 0), DenseMatrix(size, dim, full.ravel(order="F"))

    return BlockMatrix(blocks.select("block", "x").rdd.map(build), size, dim, count * size, dim)


def multiply_split(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left.multiply(right)`` with the middle dimension dealt to ``splits`` tasks (numMidDimSplits)."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def gram(a: BlockMatrix, count: int) -> np.ndarray:
    """``A' A``, a matrix of the dimension, on the driver."""
    return multiply_split(a.transpose(), a, max(1, -(-count // BLOCKS_PER_TASK))).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors by falling eigenvalue over their square roots, and all eigenvalues."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, values.size)
    there = values[:k] > max(values[0], 0.0) * NO_VARIANCE
    scale = np.where(there, 1.0 / np.sqrt(np.where(there, values[:k], 1.0)), 0.0)
    return vectors[:, :k] * scale, values


def projected_blocks(projected: BlockMatrix) -> RDD:
    """``(block, rows)`` of a matrix with one column of blocks, row by row as doubles."""
    return projected.blocks.map(lambda b: (b[0][0], bytearray(np.ascontiguousarray(b[1].toArray()).tobytes())))


_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable vector."""
    spark = vectors.sparkSession
    parts = store(into_blocks(whole_numbers(vectors, id_column, vector_column)), "whiten-parts")
    first = parts.select("vec_ids", "x").limit(1).collect()
    if not first:
        return spark.createDataFrame([], _OUT)
    dim = len(first[0].x) // 8 // len(first[0].vec_ids)
    count = parts.count()
    n, sums = column_sums(parts, dim)
    blocks = store(numbered(parts), "whiten-blocks")
    a = block_matrix(blocks, n, sums, count)
    matrix, values = whitening_matrix(gram(a, count) / n, components)
    k = matrix.shape[1]
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(dim, k, matrix.ravel(order="F")))], 1), dim, k, dim, k)
    whitened = a.multiply(right)
    stored = store(spark.createDataFrame(projected_blocks(whitened), "block bigint, z binary"), "whiten-projected")

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            for raw in b.column(0).to_pylist():
                z = np.frombuffer(raw).reshape(-1, k)
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(total.ravel(), pa.float64())], ["at", "value"])

    # Whitened rows have mean zero, as the rows they are made from.
    cells = stored.select("z").mapInArrow(scatter, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    check = np.zeros(k * k)
    for at, value in cells:
        check[at] = value
    there = (matrix != 0).any(axis=0)
    off = np.abs(check.reshape(k, k) / n - np.eye(k))[np.ix_(there, there)]
    error = float(off.max(initial=0.0))
    trace = float(values.sum())
    explained = np.maximum(values[:k], 0.0) / trace if trace > 0 else np.zeros(k)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, raw, z in zip(*(c.to_pylist() for c in b.columns), strict=True):
                m = len(ids)
                of = np.repeat(np.arange(m), k)
                columns = [
                    pa.array(ids, pa.int64()).take(pa.array(of)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array(exact_deviation(raw, n, sums), pa.int64()).take(pa.array(of)),
                    pa.array(np.frombuffer(z).reshape(-1, k)[:m].ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    joined = blocks.join(stored, "block").select("vec_ids", "x", "z")
    return joined.mapInArrow(rows, _OUT)
