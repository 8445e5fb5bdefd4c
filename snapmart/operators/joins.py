"""Left lookups into dimensions, including one dimension in many roles.

Broadcast policy. No join here is hinted and nothing is counted while a
frame is built. Catalyst broadcasts a side whose size in bytes is known to be
under ``spark.sql.autoBroadcastJoinThreshold`` (file statistics after column
pruning), and adaptive execution turns a sort-merge join into a broadcast one
when the side proves small at run time. Whatever is chosen, the rows are those
of SQL's left join.

Skew in the sort-merge case. NULL fact keys never match but all hash to one
partition, and a hot key does the same. Adaptive skew-join handling splits
such an oversized partition of the streamed (left) side of a left outer join
into several tasks and repeats the matching dimension partition, which holds
one row per key. :mod:`snapmart.session` turns it on and forces it even when
the split costs an extra shuffle. :func:`role_join_by_id_sets` spreads its
rows without any id itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shares that rows without any role id are spread over.
NULL_SHARES = 1 << 20


def left_lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    values: dict[str, str],
) -> DataFrame:
    """``fact left join dim on fact_key = dim_key``, adding ``values``.

    ``values`` maps dimension column -> output name. A dimension key held by
    several rows multiplies the fact row, as SQL does.
    """
    d = dim.select(F.col(dim_key).alias("__dk"), *[F.col(c).alias(o) for c, o in values.items()])
    return fact.join(d, fact[fact_key] == d["__dk"], "left").drop("__dk")


def role_join(
    fact: DataFrame,
    dim: DataFrame,
    dim_key: str,
    dim_value: str,
    roles: list[tuple[str, str]],
    by_id_sets: bool = False,
) -> DataFrame:
    """One dimension joined in many roles: ``[(fact_id_col, out_name), ...]``.

    Each role is a left join; a NULL or unknown id gives a NULL name and the
    row stays; a dimension key held by several rows multiplies the row, as
    chained SQL left joins do. The dimension is projected to ``(key, value)``;
    a broadcast of it is made once and reused by every role.

    ``by_id_sets=True`` is for a dimension known to be too large for that: the
    same rows, with one shuffle of the fact instead of one per role
    (:func:`role_join_by_id_sets`). It is the caller's choice, never a switch
    on the data.
    """
    if by_id_sets:
        return role_join_by_id_sets(fact, dim, dim_key, dim_value, roles)
    pair = dim.select(F.col(dim_key).alias("__k"), F.col(dim_value).alias("__v"))
    out = fact
    for i, (fact_col, out_name) in enumerate(roles):
        k = f"__k{i}"
        side = pair.select(F.col("__k").alias(k), F.col("__v").alias(out_name))
        out = out.join(side, out[fact_col] == side[k], "left").drop(k)
    return out


def role_join_by_id_sets(
    fact: DataFrame,
    dim: DataFrame,
    dim_key: str,
    dim_value: str,
    roles: list[tuple[str, str]],
) -> DataFrame:
    """Many roles against a dimension too big to broadcast, with one shuffle
    of the fact whatever the number of roles.

    The names of a fact row depend only on its tuple of role ids, so the
    roles are resolved once per distinct tuple:

    1. Distinct id tuples of the fact: a partial aggregate over the id
       columns only (a second, narrower read of the fact).
    2. :func:`role_join` on these tuples. A key held by several rows of the
       dimension multiplies the tuple there, once for each role.
    3. The fact joins the named tuples once, on a struct of its ids, in which
       NULL equals NULL: k names of a tuple give k rows, the rows chained left
       joins give. Rows without any id match nothing; a share of their hash
       in the struct spreads them over all join tasks.

    No id is filtered on before the distinct: such a filter would be pushed
    below the ids and compute them again. No row key is needed: fact rows
    with the same tuple get the same names.
    """
    ids = [f"__id{k}" for k in range(len(roles))]
    keyed = fact.withColumns({i: F.col(c) for i, (c, _) in zip(ids, roles)})
    tuples = keyed.select(*ids).distinct()
    named = role_join(tuples, dim, dim_key, dim_value, [(i, f"__name{k}") for k, i in enumerate(ids)])
    none = F.coalesce(*[F.col(i).cast("string") for i in ids]).isNull()
    share = F.when(none, F.pmod(F.xxhash64(*fact.columns), F.lit(NULL_SHARES)))
    nothing = F.lit(None).cast("bigint")
    sides = named.select(
        F.struct(nothing.alias("share"), *ids).alias("__named"),
        *[F.col(f"__name{k}").alias(name) for k, (_, name) in enumerate(roles)],
    )
    keyed = keyed.withColumn("__tuple", F.struct(share.alias("share"), *ids)).drop(*ids)
    return keyed.join(sides, F.col("__tuple") == F.col("__named"), "left").drop("__tuple", "__named")


def missing_parents(
    child: DataFrame, child_col: str, parent: DataFrame, parent_col: str
) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left anti join).

    Only the parent's key column is read; Catalyst broadcasts it when small.
    """
    p = parent.select(F.col(parent_col).alias("__pk"))
    c = child.where(F.col(child_col).isNotNull())
    return c.join(p, c[child_col] == p["__pk"], "left_anti")


def not_yet_present(wanted: DataFrame, present: DataFrame, key: str, present_key: str | None = None) -> DataFrame:
    """``wanted`` rows whose key is not in ``present`` (what still needs work)."""
    pk = present_key or key
    p = present.select(F.col(pk).alias("__pk"))
    return wanted.join(p, wanted[key] == p["__pk"], "left_anti")
