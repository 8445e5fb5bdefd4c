"""Connected components of an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import store

#: Rounds after which something must be wrong: each at least halves the
#: number of labels of a component, so this covers any input.
MAX_ROUNDS = 64


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable, for every node of ``a, b`` edges.

    Each round gives every label the smallest label next to it (a minimum per
    label, combined before the shuffle), follows the new pointers twice and
    keeps the edges that still join different labels. Labels and edges are
    written to the shared folder in every round; an edge set that became empty
    ends the loop. Rows with a null end are dropped, loops are allowed.
    """
    edges = edges.select("a", "b").dropna()
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc-labels")
    for _ in range(MAX_ROUNDS):
        labels = _jump(labels)
        left = store(_between(edges, labels), "cc-edges")
        if left.isEmpty():
            return labels
        pointed = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = pointed.groupBy(F.col("a").alias("_from")).agg(F.min("b").alias("_to")).filter(F.col("_to") < F.col("_from"))
        joined = labels.join(hooks, F.col("label") == F.col("_from"), "left")
        labels = store(joined.select("node", F.coalesce("_to", "label").alias("label")), "cc-labels")
        edges = left
    raise RuntimeError("connected components did not settle")


def _jump(labels: DataFrame) -> DataFrame:
    """Follow pointers until every label points to itself."""
    for _ in range(MAX_ROUNDS):
        heads = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label")).filter(F.col("_node") != F.col("_label"))
        joined = labels.join(heads, F.col("label") == F.col("_node"), "left")
        moved = store(joined.select("node", F.coalesce("_label", "label").alias("label"), F.col("_label").isNotNull().alias("moved")), "cc-jump")
        labels = moved.select("node", "label")
        if moved.filter("moved").isEmpty():
            return labels
    raise RuntimeError("pointer jumping did not settle")


def _between(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct pairs of different labels joined by an edge."""
    left = labels.select(F.col("node").alias("a"), F.col("label").alias("_a"))
    right = labels.select(F.col("node").alias("b"), F.col("label").alias("_b"))
    out = edges.join(left, "a").join(right, "b").filter(F.col("_a") != F.col("_b"))
    return out.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct()
