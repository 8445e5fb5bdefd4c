"""Latest row(s) per key: the reference's current-view pattern.

``max(date)`` per key, then the history rows at that date. All ties on the
latest date stay (a player on two rosters the same day gives two rows); a
key absent from newer snapshots keeps its last row; NULL keys and NULL dates
never match.

Plan, chosen for skew: the per-key max is a partial (map-side) aggregate, so
a key holding a third of all rows still sends one value per map task. The
history is then kept by a left-semi join on ``(key, date)``. The max side
has one row per key: adaptive execution broadcasts it when it is small, and
otherwise the sort-merge semi join lets adaptive skew handling split a hot
key's history rows over many tasks. A ``rank()`` window would put the whole
hot group into one sort task, so it is not used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key, order_col: str) -> DataFrame:
    """Rows of ``df`` whose ``order_col`` equals the max of their ``key``.

    ``key`` is a column name or a list of names. The output has exactly the
    columns of ``df``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    present = reduce(
        lambda a, b: a & b, [F.col(k).isNotNull() for k in keys + [order_col]]
    )
    latest = (
        df.where(present)
        .groupBy(*keys)
        .agg(F.max(order_col).alias(order_col))
    )
    return df.join(latest, on=keys + [order_col], how="left_semi")


def latest_overall(df: DataFrame, order_col: str) -> DataFrame:
    """Rows at the greatest ``order_col`` over the whole frame.

    ``order_col = (select max(order_col) ...)`` as a scalar subquery: the max
    is a partial aggregate evaluated first, and on a table partitioned by
    ``order_col`` the comparison becomes a partition filter, so only the
    newest partition is read. No join and no broadcast of the input.
    """
    top = df.select(F.max(order_col)).scalar()
    return df.where(F.col(order_col) == top)
