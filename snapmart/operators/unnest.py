"""``unnest``: one row per list element; NULL and empty lists give no row.

:func:`unnest_tagged` replaces a ``UNION ALL`` of several unnests of the same
source (forwards / defensemen / goalies) by one scan: each list is tagged
element-wise, the tagged lists are concatenated per row, and a single
``explode`` emits the rows. No shuffle, one pass over the input.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array_col: Column | str, alias: str, keep: Iterable[str] = ()) -> DataFrame:
    """``select keep..., unnest(array_col) as alias``."""
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    return df.select(*keep, F.explode(arr).alias(alias))


def tag_elements(arr: Column, tag: str, item: str, tag_col: str) -> Column:
    """``[x, ...]`` to ``[{item: x, tag_col: tag}, ...]``; NULL list to ``[]``.

    Zips the list with a list of the tag repeated to its length: both are
    compiled expressions (a ``transform`` lambda would run interpreted, about
    four times slower per row).
    """
    a = F.coalesce(arr, F.array())
    return F.arrays_zip(a.alias(item), F.array_repeat(F.lit(tag), F.size(a)).alias(tag_col))


def unnest_tagged(
    df: DataFrame,
    branches: list[tuple[str, Column]],
    item: str,
    tag_col: str,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Union of ``unnest(list_i) as item, 'tag_i' as tag_col`` in one scan.

    ``branches`` is ``[(tag, array column), ...]``; all arrays share one
    element type. Output columns: ``keep..., item, tag_col``.
    """
    keep = list(keep)
    if not branches:
        raise ValueError("no branches")
    tagged = [tag_elements(arr, tag, item, tag_col) for tag, arr in branches]
    merged = F.concat(*tagged) if len(tagged) > 1 else tagged[0]
    return (
        df.select(*keep, F.explode(merged).alias("__u"))
        .select(*keep, F.col("__u")[item].alias(item), F.col("__u")[tag_col].alias(tag_col))
    )
