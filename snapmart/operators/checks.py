"""Declarative data tests as operators that return the failing rows.

A test passes when its DataFrame is empty. The shapes follow the published
generic tests (unique, not_null, accepted_values, relationships): failing
values with ``n_records`` where the test groups, failing rows otherwise.

All grouped checks aggregate map-side first, so a hot value costs one
partial count per task. ``null_counts`` checks any number of columns in one
pass over the table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import missing_parents


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values seen more than once (NULLs ignored): ``unique_field, n_records``."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def unique_combination_failures(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Key combinations seen more than once (rows with a NULL part are
    ignored): the key columns plus ``n_records``."""
    columns = list(columns)
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return (
        df.where(present)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null_failures(df: DataFrame, column: str, keep: Iterable[str] = ()) -> DataFrame:
    """Rows where ``column`` is NULL, with ``keep`` columns for context."""
    keep = [k for k in keep if k != column]
    return df.where(F.col(column).isNull()).select(*keep, column)


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULL count per column in one scan: rows ``(column_name, n_null)``."""
    columns = list(columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "n_null")


def accepted_values_failures(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values off the list with their counts: ``value_field, n_records``.

    NULL passes (``NULL NOT IN (...)`` is not true). The predicate is on the
    grouping column, so it runs before the aggregate and reaches the scan.
    """
    values = list(values)
    return (
        df.where(~F.col(column).isin(values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships_failures(
    child: DataFrame, column: str, parent: DataFrame, field: str, keep: Iterable[str] = ()
) -> DataFrame:
    """Child rows with a non-NULL key and no parent: ``keep..., from_field``."""
    keep = [k for k in keep]
    return missing_parents(child, column, parent, field).select(
        *keep, F.col(column).alias("from_field")
    )
