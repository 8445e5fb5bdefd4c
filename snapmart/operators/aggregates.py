"""Counting aggregates: ``count(*)``, ``count(*) FILTER (WHERE p)``, min/max.

Every aggregate here is decomposable, so Spark computes partial results in
each map task and shuffles one row per group per task; a hot group costs
nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_star(alias: str) -> Column:
    """``count(*)`` as BIGINT."""
    return F.count(F.lit(1)).alias(alias)


def count_filter(predicate: Column, alias: str) -> Column:
    """``count(*) FILTER (WHERE predicate)``; a NULL predicate does not count."""
    return F.count_if(predicate).alias(alias)


def filtered_counts(
    df: DataFrame,
    by: list[str | Column],
    total_alias: str,
    filters: dict[str, Column],
    extra: list[Column] = (),
) -> DataFrame:
    """``count(*)`` plus one filtered count per ``filters`` entry, per group.

    An empty ``by`` gives the global one-row result. ``extra`` adds more
    aggregate columns to the same single pass.
    """
    aggs = [count_star(total_alias)] + [count_filter(p, a) for a, p in filters.items()] + list(extra)
    if by:
        return df.groupBy(*by).agg(*aggs)
    return df.agg(*aggs)


def count_by(df: DataFrame, by: list[str | Column], alias: str = "n") -> DataFrame:
    """``count(*)`` per group."""
    return df.groupBy(*by).agg(count_star(alias))
