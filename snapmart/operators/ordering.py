"""Ordering with the reference's NULL placement: NULLs last in both
directions (Spark's default puts them first when ascending).

``top_k`` is ``orderBy(...).limit(k)``, which Spark plans as
``TakeOrderedAndProject``: every task keeps its own k best rows and only
those reach the final merge, so no full sort or range shuffle happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OrderSpec = tuple[str | Column, str]


def sort_key(spec: OrderSpec | str | Column) -> Column:
    """``("col", "desc")`` -> ``desc_nulls_last(col)``; a bare name is ascending."""
    if isinstance(spec, tuple):
        c, direction = spec
    else:
        c, direction = spec, "asc"
    col = F.col(c) if isinstance(c, str) else c
    if direction == "asc":
        return col.asc_nulls_last()
    if direction == "desc":
        return col.desc_nulls_last()
    raise ValueError(f"direction must be asc or desc, not {direction!r}")


def order_by(df: DataFrame, *specs) -> DataFrame:
    """Full ordering, NULLs last (a range-partitioned sort)."""
    return df.orderBy(*[sort_key(s) for s in specs])


def top_k(df: DataFrame, k: int, *specs) -> DataFrame:
    """First ``k`` rows in the given order, NULLs last.

    Add a unique column as the last key when ties must be broken the same
    way on every run.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    return df.orderBy(*[sort_key(s) for s in specs]).limit(k)
