"""Proof queries: every operator of the survey run on the driver's tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built from the
library's operators and scalar functions (the same ones the staging and
mart models use), and has a DuckDB SQL oracle in :data:`ORACLE_SQL` with the
same column names. Every query reads whole tables; a LIMIT appears only
where a top-k report is the feature.

The table stand-ins: plays with optional role ids -> lineitem / events;
the player dimension in many roles -> nation, customer; snapshot history ->
events by (user_id, date of ts); ``details`` JSON -> events.props; lists to
unnest -> embeddings, words of part names; path-derived keys -> pages.url.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions import scalar as X
from ..operators.aggregates import count_by, filtered_counts
from ..operators.checks import (
    accepted_values_failures,
    not_null_failures,
    relationships_failures,
    unique_failures,
)
from ..operators.joins import (
    left_lookup,
    not_yet_present,
    role_join,
)
from ..operators.latest import latest_overall, latest_per_key
from ..operators.ordering import order_by, top_k
from ..operators.unnest import unnest, unnest_tagged
from ..tables import load
from .quality import DataTest, run_suite

Query = Callable[[SparkSession, str], DataFrame]


def q_fact_star(spark: SparkSession, sf: str) -> DataFrame:
    """A fact with its header, two dimensions and one dimension in two roles.

    Every join is a plain left join; nothing is counted or read while the
    frame is built. Orders meet their customer before line items do, so at
    large scale line items are shuffled on the order key and the supplier key
    only; the nation names come last, from a table of fixed size.
    """
    nation = load(spark, sf, "nation").select("n_nationkey", "n_name")
    customer = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    supplier = load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    line = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    orders = left_lookup(
        orders, customer, "o_custkey", "c_custkey",
        {"c_name": "customer_name", "c_nationkey": "customer_key"},
    )
    f = left_lookup(
        line, orders, "l_orderkey", "o_orderkey",
        {"o_orderdate": "__orderdate", "customer_name": "customer_name", "customer_key": "customer_key"},
    )
    f = left_lookup(
        f, supplier, "l_suppkey", "s_suppkey",
        {"s_name": "supplier_name", "s_nationkey": "supplier_key"},
    )
    f = role_join(
        f, nation, "n_nationkey", "n_name",
        [("customer_key", "customer_nation"), ("supplier_key", "supplier_nation")],
    )
    return f.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        X.as_date("__orderdate").alias("order_date"),
        "customer_name", "supplier_name", "customer_nation", "supplier_nation",
    )


def _some_missing(column: str):
    """A third of the ids negated: ids that no dimension row has."""
    return F.when(F.col(column) % 3 == 0, -F.col(column)).otherwise(F.col(column))


def q_role_joins_nullable(spark: SparkSession, sf: str) -> DataFrame:
    """Two roles; NULL role ids and ids with no dimension row keep the row
    with a NULL name. The driver's keys have no gaps, so some of the events'
    ids are negated; the whole dimension and all events are read."""
    e = load(spark, sf, "events").select(
        "event_id", "event_type",
        F.when(F.col("event_type") == "click", _some_missing("user_id")).alias("clicker_id"),
        F.when(F.col("event_type") == "purchase", _some_missing("user_id")).alias("buyer_id"),
    )
    return role_join(
        e, load(spark, sf, "customer"), "c_custkey", "c_name",
        [("clicker_id", "clicker_name"), ("buyer_id", "buyer_name")],
    )


# Fixed values for the five-role query: event type -> role column.
EVENT_ROLES = [
    ("view", "viewer"),
    ("click", "clicker"),
    ("purchase", "buyer"),
    ("signup", "signer"),
    ("error", "reporter"),
]


def _events_in_roles(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        "event_id",
        *[
            F.when(F.col("event_type") == t, _some_missing("user_id")).alias(f"{r}_id")
            for t, r in EVENT_ROLES
        ],
    )


_ROLE_NAMES = [(f"{r}_id", f"{r}_name") for _, r in EVENT_ROLES]


def q_role_joins_many(spark: SparkSession, sf: str) -> DataFrame:
    """The fact's real shape: one dimension in five roles, and on any row
    all role ids but one are NULL (as most player roles of a play are).
    One side ``(c_custkey, c_name)``, broadcast once if it is small."""
    return role_join(_events_in_roles(spark, sf), load(spark, sf, "customer"), "c_custkey", "c_name", _ROLE_NAMES)


def q_role_joins_past_bound(spark: SparkSession, sf: str) -> DataFrame:
    """``q_role_joins_many`` by the plan for a dimension too large to
    broadcast: the five roles are resolved once per distinct tuple of role
    ids, so events are shuffled once, not five times. Same rows, same oracle."""
    return role_join(
        _events_in_roles(spark, sf), load(spark, sf, "customer"), "c_custkey", "c_name", _ROLE_NAMES,
        by_id_sets=True,
    )


def _tied(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers with repeated keys and NULL names; events with fractional ids in one role."""
    c = load(spark, sf, "customer")
    first = c.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"))
    second = c.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", F.col("c_mktsegment").alias("name"))
    third = c.where(F.col("c_mktsegment") == "MACHINERY").select("c_custkey", F.lit(None).cast("string").alias("name"))
    half = F.when(F.col("event_id") % 5 == 0, F.lit(0.5)).otherwise(F.lit(0.0))
    e = load(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", F.col("user_id").cast("double") + half).alias("clicker_id"),
        F.when(F.col("event_type") != "error", _some_missing("user_id")).alias("actor_id"),
    )
    return e, first.unionByName(second).unionByName(third)


_TIED_ROLES = [("clicker_id", "clicker_name"), ("actor_id", "actor_name")]


def q_role_joins_tied(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated dimension keys multiply the row, NULL names included."""
    e, dim = _tied(spark, sf)
    return role_join(e, dim, "c_custkey", "name", _TIED_ROLES)


def q_role_joins_tied_sets(spark: SparkSession, sf: str) -> DataFrame:
    """``q_role_joins_tied`` by id sets; same oracle."""
    e, dim = _tied(spark, sf)
    return role_join(e, dim, "c_custkey", "name", _TIED_ROLES, by_id_sets=True)


def q_join_widening(spark: SparkSession, sf: str) -> DataFrame:
    """An INTEGER fact key against a BIGINT dimension key; a negative balance makes the key miss."""
    n = load(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), "n_name")
    key = F.when(F.col("c_acctbal") < 0, -1 - F.col("c_nationkey")).otherwise(F.col("c_nationkey"))
    c = load(spark, sf, "customer").select("c_custkey", key.cast("int").alias("nationkey"))
    return left_lookup(c, n, "nationkey", "k", {"n_name": "n_name"}).select("c_custkey", "n_name")


def _event_history(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        "user_id", X.as_date("ts").alias("snapshot_date"), "event_id", "event_type"
    )


def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(_event_history(spark, sf), "user_id", "snapshot_date")


def q_latest_snapshot_global(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events").select(
        "event_id", "user_id", X.as_date("ts").alias("snapshot_date")
    )
    return latest_overall(ev, "snapshot_date").select("event_id", "user_id", "snapshot_date")


def q_unnest_tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    return unnest_tagged(
        part,
        [("name", X.split_literal("p_name", " ")), ("attr", F.array("p_brand", "p_type"))],
        item="item", tag_col="item_group", keep=["p_partkey"],
    )


def q_unnest_drops_empty(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    words = (
        F.when(F.col("p_size") > 40, X.split_literal("p_name", " "))
        .when(F.col("p_size") > 20, F.array().cast("array<string>"))
    )
    return unnest(part, words, "word", keep=["p_partkey"])


def q_unnest_numeric(spark: SparkSession, sf: str) -> DataFrame:
    emb = load(spark, sf, "embeddings")
    return unnest(emb, "embedding", "v", keep=["vec_id"]).select(
        "vec_id", F.col("v").cast("double").alias("v")
    )


def q_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    r = load(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    n = load(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("parent_id"),
    )
    return r.unionByName(n, allowMissingColumns=True)


def q_struct_nested(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.struct(
            F.struct(F.col("p_name").alias("default")).alias("name"),
            F.col("p_size").alias("size"),
        ).alias("doc"),
    )
    return docs.select(
        "id", F.col("doc.name.default").alias("name"),
        F.col("doc.size").cast("int").alias("size_i"),
    )


def q_json_extract(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events").select("event_id", J.parse(F.col("props")).alias("j"))
    return ev.select(
        "event_id", J.get_int(F.col("j"), "k").alias("k"),
        J.get_text(F.col("j"), "nosuch").alias("missing"),
    )


def q_json_chained(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events")
    wrapped = J.parse(F.concat(F.lit('{"d":'), F.col("props"), F.lit("}")))
    return ev.select("event_id", J.get_int(J.hop(wrapped, "d"), "k").alias("k"))


def q_json_number_text(spark: SparkSession, sf: str) -> DataFrame:
    """``->>`` of numbers with fractions and exponents, of a long integer and of a text that looks like one."""
    t = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    parts = [F.lit('{"a":'), t, F.lit(',"b":'), t, F.lit('e-9,"c":'), t, F.lit('e16,"d":"'), t, F.lit('e16","e":1'), F.col("o_orderkey").cast("string"), F.lit("00000000000000000000}")]
    o = load(spark, sf, "orders").select("o_orderkey", J.parse(F.concat(*parts)).alias("j"))
    return o.select("o_orderkey", *[J.get_text(F.col("j"), k).alias(k) for k in "abcde"])


def q_json_fractions(spark: SparkSession, sf: str) -> DataFrame:
    """Integers out of JSON with fractions, quoted numbers, exponents and a document that is no object."""
    c = load(spark, sf, "customer")
    doc = F.to_json(F.struct(
        (F.round("c_acctbal", 1)).alias("a"),
        F.round("c_acctbal", 1).cast("string").alias("b"),
        F.col("c_nationkey").alias("c"),
    ))
    doc = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("[1]")).otherwise(doc)
    j = c.select("c_custkey", J.parse(doc).alias("j"))
    kinds = {"a": "int", "b": "bigint", "c": "int", "d": "string"}
    fields = j.select("c_custkey", J.get_fields(F.col("j"), list(kinds.items()), stored=False).alias("t"))
    return fields.select("c_custkey", *[J.typed_field(F.col("t")[k], kind, stored=False).alias(k) for k, kind in kinds.items()])


def q_casts_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text to integer, half away from zero."""
    c = load(spark, sf, "customer").select("c_custkey", F.format_string("%.1f", "c_acctbal").alias("t"))
    li = load(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("c_custkey"), F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".5")).alias("t"))
    return c.unionByName(li.select((-F.col("c_custkey")).alias("c_custkey"), "t")).select("c_custkey", "t", X.int_from_text("t").alias("n"))


def q_path_parts(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "pages")
    return p.select(
        "page_id",
        X.split_part("url", "/", 3).alias("host"),
        X.split_part("url", "/", 4).alias("lang"),
        X.split_part(X.replace_literal("url", "https://", ""), "/", 1).alias("first_part"),
        X.split_part("url", "/", 9).alias("beyond"),
    )


def q_casts(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        X.int_half_even("l_quantity").alias("qty_i"),
        X.as_date("l_shipdate").alias("ship_date"),
        F.col("l_linenumber").cast("double").alias("ln_d"),
        X.text(F.col("l_linenumber")).alias("ln_s"),
        X.int_half_even(F.col("l_quantity") + F.lit(0.5)).alias("half_even"),
    )


def q_lateral_alias(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        X.int_half_even("l_quantity").alias("home_score"),
        (F.col("l_linenumber") * F.lit(5)).alias("away_score"),
    )
    return li.select(
        "l_orderkey", "l_linenumber", "home_score", "away_score",
        (F.col("away_score") > F.col("home_score")).alias("away_win"),
        (F.col("home_score") > F.col("away_score")).alias("home_win"),
        F.abs(F.col("home_score") - F.col("away_score")).alias("goal_diff"),
    )


def q_case_group(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("p_type")
    group = (
        F.when(t == "ECONOMY", F.lit("Economy"))
        .when(t.isin("STANDARD", "SMALL"), F.lit("Plain"))
        .otherwise(F.lit("Unknown"))
    )
    return load(spark, sf, "part").select("p_partkey", group.alias("type_group"))


def q_height_display(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part").select(
        "p_partkey", "p_size", (F.col("p_size") + F.lit(40)).alias("height_inches")
    )
    return p.select(
        "p_partkey", "height_inches",
        F.when(F.col("p_size") % 10 != 0, X.height_display("height_inches")).alias("height_display"),
    )


AS_OF = _dt.date(2026, 6, 30)


def q_year_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        X.year_crossings(X.as_date("o_orderdate"), F.lit(AS_OF)).alias("age"),
    )


def q_round_concat(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select(
        "c_custkey",
        X.round_scaled(F.col("c_acctbal") / F.lit(9), 3).alias("pct"),
        X.concat_strict("c_mktsegment", X.text(F.col("c_nationkey"))).alias("streak"),
    )
    return order_by(c, "c_custkey")


def q_global_summary(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    s = F.col("o_orderstatus")
    res = filtered_counts(
        o, [], "total", {"f": s == "F", "o": s == "O", "p": s == "P"},
        extra=[
            F.min("o_orderdate").cast("date").alias("earliest"),
            F.max("o_orderdate").cast("date").alias("latest"),
        ],
    )
    return res.select("total", "earliest", "latest", "f", "o", "p")


def q_type_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events")
    u = F.col("user_id") % 3
    res = filtered_counts(
        ev, ["event_type"], "total_events", {"p1": u == 1, "p2": u == 2, "p3": u == 0}
    )
    return order_by(res, ("total_events", "desc"), "event_type")


def q_snapshot_summary(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events")
    res = count_by(ev, [X.as_date("ts").alias("snapshot_date"), "event_type"], "n")
    return top_k(res, 20, ("snapshot_date", "desc"), "event_type")


def q_filter_topk(spark: SparkSession, sf: str) -> DataFrame:
    o = (
        load(spark, sf, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select("o_orderkey", X.as_date("o_orderdate").alias("order_date"), "o_totalprice")
    )
    return top_k(o, 10, "order_date", "o_totalprice", "o_orderkey")


def q_topk_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events").select("event_id", X.nullif("event_type", "click").alias("t"))
    return top_k(ev, 5000, "t", "event_id")


def q_unknown_values(spark: SparkSession, sf: str) -> DataFrame:
    t = X.nullif("event_type", "error")
    return (
        load(spark, sf, "events")
        .select(t.alias("event_type"))
        .where(~F.col("event_type").isin("view", "click"))
        .distinct()
    )


def q_dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return unique_failures(load(spark, sf, "lineitem"), "l_orderkey")


def q_dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events").select("event_id", X.nullif("event_type", "error").alias("v"))
    return not_null_failures(ev, "v", keep=["event_id"])


def q_dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return accepted_values_failures(
        load(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]
    )


def q_dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Child keys without a parent; urgent orders' keys are negated so that they miss."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    child = load(spark, sf, "orders").withColumn("o_custkey", F.when(urgent, -F.col("o_custkey")).otherwise(F.col("o_custkey")))
    return relationships_failures(child, "o_custkey", load(spark, sf, "customer"), "c_custkey", keep=["o_orderkey"])


# A declared test suite over the driver's tables, run by the same runner as
# the models' 37 tests.
DRIVER_SUITE = [
    DataTest("orders", "o_orderkey", "unique"),
    DataTest("orders", "o_orderkey", "not_null"),
    DataTest("orders", "o_custkey", "not_null"),
    DataTest("orders", "o_orderdate", "not_null"),
    DataTest("orders", "o_orderstatus", "accepted_values", ("F", "O")),
    DataTest("orders", "o_orderpriority", "accepted_values", ("1-URGENT", "2-HIGH", "3-MEDIUM")),
    DataTest("orders", "o_custkey", "relationships", to="customer", field_name="c_custkey"),
    DataTest("lineitem", "l_orderkey", "unique"),
    DataTest("lineitem", "l_orderkey", "not_null"),
    DataTest("lineitem", "l_returnflag", "not_null"),
    DataTest("lineitem", "l_orderkey", "relationships", to="orders", field_name="o_orderkey"),
    DataTest("customer", "c_mktsegment", "accepted_values", ("AUTOMOBILE", "BUILDING", "MACHINERY")),
]


def q_dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    """Q1-Q4 as a suite: one row per declared test with its failure count;
    the NOT NULL tests of a table share one scan."""
    tables = {t: load(spark, sf, t) for t in ("orders", "lineitem", "customer")}
    return run_suite(tables, DRIVER_SUITE)


def q_completed_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = (
        load(spark, sf, "events")
        .where(F.col("event_type").isin("purchase", "signup"))
        .select("user_id")
        .distinct()
    )
    return order_by(ids, "user_id")


def q_pending_ids(spark: SparkSession, sf: str) -> DataFrame:
    wanted = load(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    landed = load(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return not_yet_present(wanted, landed, "o_orderkey", "l_orderkey")


PAST_BOUND = "1996-01-01 00:00:00"


def q_past_items(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").where(
        (F.col("o_orderdate") < F.lit(PAST_BOUND).cast("timestamp_ntz"))
        & F.col("o_orderstatus").isin("F", "P")
    )
    return order_by(o.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


QUERIES: dict[str, Query] = {
    "q_fact_star": q_fact_star,
    "q_role_joins_nullable": q_role_joins_nullable,
    "q_role_joins_many": q_role_joins_many,
    "q_role_joins_past_bound": q_role_joins_past_bound,
    "q_role_joins_tied": q_role_joins_tied,
    "q_role_joins_tied_sets": q_role_joins_tied_sets,
    "q_join_widening": q_join_widening,
    "q_latest_per_key": q_latest_per_key,
    "q_latest_snapshot_global": q_latest_snapshot_global,
    "q_unnest_tagged_union": q_unnest_tagged_union,
    "q_unnest_drops_empty": q_unnest_drops_empty,
    "q_unnest_numeric": q_unnest_numeric,
    "q_union_by_name": q_union_by_name,
    "q_struct_nested": q_struct_nested,
    "q_json_extract": q_json_extract,
    "q_json_chained": q_json_chained,
    "q_json_fractions": q_json_fractions,
    "q_json_number_text": q_json_number_text,
    "q_casts_text": q_casts_text,
    "q_path_parts": q_path_parts,
    "q_casts": q_casts,
    "q_lateral_alias": q_lateral_alias,
    "q_case_group": q_case_group,
    "q_height_display": q_height_display,
    "q_year_boundaries": q_year_boundaries,
    "q_round_concat": q_round_concat,
    "q_global_summary": q_global_summary,
    "q_type_breakdown": q_type_breakdown,
    "q_snapshot_summary": q_snapshot_summary,
    "q_filter_topk": q_filter_topk,
    "q_topk_nulls_last": q_topk_nulls_last,
    "q_unknown_values": q_unknown_values,
    "q_dq_unique": q_dq_unique,
    "q_dq_not_null": q_dq_not_null,
    "q_dq_accepted_values": q_dq_accepted_values,
    "q_dq_relationships": q_dq_relationships,
    "q_dq_suite": q_dq_suite,
    "q_completed_ids": q_completed_ids,
    "q_pending_ids": q_pending_ids,
    "q_past_items": q_past_items,
}


ORACLE_SQL: dict[str, str] = {
    "q_fact_star": "select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, cast(o.o_orderdate as date) as order_date, c.c_name as customer_name, s.s_name as supplier_name, cn.n_name as customer_nation, sn.n_name as supplier_nation from lineitem l left join orders o on l.l_orderkey = o.o_orderkey left join customer c on o.o_custkey = c.c_custkey left join supplier s on l.l_suppkey = s.s_suppkey left join nation cn on c.c_nationkey = cn.n_nationkey left join nation sn on s.s_nationkey = sn.n_nationkey",
    "q_role_joins_nullable": "with e as (select event_id, event_type, case when event_type = 'click' then case when user_id % 3 = 0 then -user_id else user_id end end as clicker_id, case when event_type = 'purchase' then case when user_id % 3 = 0 then -user_id else user_id end end as buyer_id from events) select e.event_id, e.event_type, e.clicker_id, e.buyer_id, a.c_name as clicker_name, b.c_name as buyer_name from e left join customer a on e.clicker_id = a.c_custkey left join customer b on e.buyer_id = b.c_custkey",
    "q_role_joins_many": "with e as (select event_id, case when event_type = 'view' then case when user_id % 3 = 0 then -user_id else user_id end end as viewer_id, case when event_type = 'click' then case when user_id % 3 = 0 then -user_id else user_id end end as clicker_id, case when event_type = 'purchase' then case when user_id % 3 = 0 then -user_id else user_id end end as buyer_id, case when event_type = 'signup' then case when user_id % 3 = 0 then -user_id else user_id end end as signer_id, case when event_type = 'error' then case when user_id % 3 = 0 then -user_id else user_id end end as reporter_id from events) select e.*, d1.c_name as viewer_name, d2.c_name as clicker_name, d3.c_name as buyer_name, d4.c_name as signer_name, d5.c_name as reporter_name from e left join customer d1 on e.viewer_id = d1.c_custkey left join customer d2 on e.clicker_id = d2.c_custkey left join customer d3 on e.buyer_id = d3.c_custkey left join customer d4 on e.signer_id = d4.c_custkey left join customer d5 on e.reporter_id = d5.c_custkey",
    "q_join_widening": "select c.c_custkey, n.n_name from customer c left join (select cast(n_nationkey as bigint) as k, n_name from nation) n on (case when c.c_acctbal < 0 then -1 - c.c_nationkey else c.c_nationkey end) = n.k",
    "q_latest_per_key": "with h as (select user_id, cast(ts as date) as snapshot_date, event_id, event_type from events), s as (select user_id, max(snapshot_date) as latest_date from h group by user_id) select h.* from h inner join s on h.user_id = s.user_id and h.snapshot_date = s.latest_date",
    "q_latest_snapshot_global": "select event_id, user_id, cast(ts as date) as snapshot_date from events where cast(ts as date) = (select max(cast(ts as date)) from events)",
    "q_unnest_tagged_union": "select p_partkey, unnest(string_split(p_name, ' ')) as item, 'name' as item_group from part union all select p_partkey, unnest([p_brand, p_type]) as item, 'attr' as item_group from part",
    "q_unnest_drops_empty": "select p_partkey, unnest(case when p_size > 40 then string_split(p_name, ' ') when p_size > 20 then [] end) as word from part",
    "q_unnest_numeric": "select vec_id, cast(unnest(embedding) as double) as v from embeddings",
    "q_union_by_name": "select r_regionkey as id, r_name as name from region union all by name select n_nationkey as id, n_name as name, n_regionkey as parent_id from nation",
    "q_struct_nested": "select id, doc['name']['default'] as name, cast(doc['size'] as integer) as size_i from (select p_partkey as id, {'name': {'default': p_name}, 'size': p_size} as doc from part)",
    "q_json_extract": "select event_id, cast(props->>'k' as integer) as k, props->>'nosuch' as missing from events",
    "q_json_chained": "select event_id, cast(('{\"d\":' || props || '}')->'d'->>'k' as integer) as k from events",
    "q_path_parts": "select page_id, split_part(url, '/', 3) as host, split_part(url, '/', 4) as lang, split_part(replace(url, 'https://', ''), '/', 1) as first_part, split_part(url, '/', 9) as beyond from pages",
    "q_casts": "select l_orderkey, l_linenumber, cast(l_quantity as integer) as qty_i, cast(l_shipdate as date) as ship_date, cast(l_linenumber as double) as ln_d, cast(l_linenumber as varchar) as ln_s, cast(l_quantity + 0.5 as integer) as half_even from lineitem",
    "q_lateral_alias": "select l_orderkey, l_linenumber, cast(l_quantity as integer) as home_score, l_linenumber * 5 as away_score, away_score > home_score as away_win, home_score > away_score as home_win, abs(home_score - away_score) as goal_diff from lineitem",
    "q_case_group": "select p_partkey, case when p_type = 'ECONOMY' then 'Economy' when p_type in ('STANDARD', 'SMALL') then 'Plain' else 'Unknown' end as type_group from part",
    "q_height_display": "select p_partkey, p_size + 40 as height_inches, case when p_size % 10 <> 0 then cast((p_size + 40) / 12 as integer) || '''' || cast((p_size + 40) % 12 as integer) || '\"' end as height_display from part",
    "q_year_boundaries": "select o_orderkey, date_diff('year', cast(o_orderdate as date), date '2026-06-30') as age from orders",
    "q_round_concat": "select c_custkey, round(c_acctbal / 9, 3) as pct, c_mktsegment || cast(c_nationkey as varchar) as streak from customer order by c_custkey",
    "q_global_summary": "select count(*) as total, cast(min(o_orderdate) as date) as earliest, cast(max(o_orderdate) as date) as latest, count(*) filter (where o_orderstatus = 'F') as f, count(*) filter (where o_orderstatus = 'O') as o, count(*) filter (where o_orderstatus = 'P') as p from orders",
    "q_type_breakdown": "select event_type, count(*) as total_events, count(*) filter (where user_id % 3 = 1) as p1, count(*) filter (where user_id % 3 = 2) as p2, count(*) filter (where user_id % 3 = 0) as p3 from events group by event_type order by total_events desc, event_type",
    "q_snapshot_summary": "select cast(ts as date) as snapshot_date, event_type, count(*) as n from events group by 1, 2 order by snapshot_date desc, event_type limit 20",
    "q_filter_topk": "select o_orderkey, cast(o_orderdate as date) as order_date, o_totalprice from orders where o_orderstatus = 'F' order by order_date, o_totalprice, o_orderkey limit 10",
    "q_topk_nulls_last": "select event_id, nullif(event_type, 'click') as t from events order by t asc nulls last, event_id limit 5000",
    "q_unknown_values": "select distinct nullif(event_type, 'error') as event_type from events where nullif(event_type, 'error') not in ('view', 'click')",
    "q_dq_unique": "select l_orderkey as unique_field, count(*) as n_records from lineitem where l_orderkey is not null group by l_orderkey having count(*) > 1",
    "q_dq_not_null": "select event_id, v from (select event_id, nullif(event_type, 'error') as v from events) where v is null",
    "q_dq_accepted_values": "select o_orderpriority as value_field, count(*) as n_records from orders group by o_orderpriority having o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    "q_dq_relationships": "with o as (select o_orderkey, case when o_orderpriority = '1-URGENT' then -o_custkey else o_custkey end as o_custkey from orders) select o.o_orderkey, o.o_custkey as from_field from o left join customer c on o.o_custkey = c.c_custkey where o.o_custkey is not null and c.c_custkey is null",
    "q_dq_suite": "select 'unique_orders_o_orderkey' as test_id, 'orders' as model, 'o_orderkey' as column_name, 'unique' as test, count(*) as failures from (select o_orderkey from orders where o_orderkey is not null group by o_orderkey having count(*) > 1) union all select 'not_null_orders_o_orderkey' as test_id, 'orders' as model, 'o_orderkey' as column_name, 'not_null' as test, count(*) as failures from orders where o_orderkey is null union all select 'not_null_orders_o_custkey' as test_id, 'orders' as model, 'o_custkey' as column_name, 'not_null' as test, count(*) as failures from orders where o_custkey is null union all select 'not_null_orders_o_orderdate' as test_id, 'orders' as model, 'o_orderdate' as column_name, 'not_null' as test, count(*) as failures from orders where o_orderdate is null union all select 'accepted_values_orders_o_orderstatus' as test_id, 'orders' as model, 'o_orderstatus' as column_name, 'accepted_values' as test, count(*) as failures from (select o_orderstatus as value_field, count(*) as n_records from orders group by o_orderstatus) where value_field not in ('F', 'O') union all select 'accepted_values_orders_o_orderpriority' as test_id, 'orders' as model, 'o_orderpriority' as column_name, 'accepted_values' as test, count(*) as failures from (select o_orderpriority as value_field, count(*) as n_records from orders group by o_orderpriority) where value_field not in ('1-URGENT', '2-HIGH', '3-MEDIUM') union all select 'relationships_orders_o_custkey' as test_id, 'orders' as model, 'o_custkey' as column_name, 'relationships' as test, count(*) as failures from (select c.o_custkey as from_field from orders c left join customer p on c.o_custkey = p.c_custkey where c.o_custkey is not null and p.c_custkey is null) union all select 'unique_lineitem_l_orderkey' as test_id, 'lineitem' as model, 'l_orderkey' as column_name, 'unique' as test, count(*) as failures from (select l_orderkey from lineitem where l_orderkey is not null group by l_orderkey having count(*) > 1) union all select 'not_null_lineitem_l_orderkey' as test_id, 'lineitem' as model, 'l_orderkey' as column_name, 'not_null' as test, count(*) as failures from lineitem where l_orderkey is null union all select 'not_null_lineitem_l_returnflag' as test_id, 'lineitem' as model, 'l_returnflag' as column_name, 'not_null' as test, count(*) as failures from lineitem where l_returnflag is null union all select 'relationships_lineitem_l_orderkey' as test_id, 'lineitem' as model, 'l_orderkey' as column_name, 'relationships' as test, count(*) as failures from (select c.l_orderkey as from_field from lineitem c left join orders p on c.l_orderkey = p.o_orderkey where c.l_orderkey is not null and p.o_orderkey is null) union all select 'accepted_values_customer_c_mktsegment' as test_id, 'customer' as model, 'c_mktsegment' as column_name, 'accepted_values' as test, count(*) as failures from (select c_mktsegment as value_field, count(*) as n_records from customer group by c_mktsegment) where value_field not in ('AUTOMOBILE', 'BUILDING', 'MACHINERY')",
    "q_completed_ids": "select distinct user_id from events where event_type in ('purchase', 'signup') order by user_id",
    "q_pending_ids": "select o.o_orderkey from orders o where o.o_orderstatus = 'F' and not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_returnflag = 'R')",
    "q_past_items": "select o_orderkey, o_orderdate from orders where o_orderdate < timestamp '1996-01-01' and o_orderstatus in ('F', 'P') order by o_orderdate, o_orderkey",
}
ORACLE_SQL["q_json_fractions"] = (
    "with d as (select c_custkey, c_mktsegment = 'BUILDING' as odd, cast(cast(round(c_acctbal, 1) as decimal(18, 1)) as varchar) as t, c_nationkey from customer)"
    " select c_custkey, case when not odd then t::integer end as a, case when not odd then t::integer end::bigint as b,"
    " case when not odd then c_nationkey end as c, null::varchar as d from d"
)
ORACLE_SQL["q_json_number_text"] = (
    "with d as (select o_orderkey, cast(cast(o_totalprice as decimal(18, 2)) as varchar) as t from orders),"
    " j as (select o_orderkey, '{\"a\":' || t || ',\"b\":' || t || 'e-9,\"c\":' || t || 'e16,\"d\":\"' || t || 'e16\",\"e\":1' || o_orderkey || '00000000000000000000}' as j from d)"
    " select o_orderkey, j->>'a' as a, j->>'b' as b, j->>'c' as c, j->>'d' as d, j->>'e' as e from j"
)
ORACLE_SQL["q_casts_text"] = (
    "with u as (select c_custkey, cast(cast(c_acctbal as decimal(18, 1)) as varchar) as t from customer"
    " union all select -(l_orderkey * 10 + l_linenumber), cast(cast(l_quantity as integer) as varchar) || '.5' from lineitem)"
    " select c_custkey, t, t::integer as n from u"
)
ORACLE_SQL["q_role_joins_past_bound"] = ORACLE_SQL["q_role_joins_many"]
ORACLE_SQL["q_role_joins_tied"] = ORACLE_SQL["q_role_joins_tied_sets"] = (
    "with dim as (select c_custkey, case when c_acctbal >= 0 then c_name end as name from customer"
    " union all select c_custkey, c_mktsegment from customer where c_mktsegment = 'BUILDING'"
    " union all select c_custkey, null from customer where c_mktsegment = 'MACHINERY'),"
    " e as (select event_id, case when event_type = 'click' then cast(user_id as double) + case when event_id % 5 = 0 then 0.5 else 0.0 end end as clicker_id,"
    " case when event_type <> 'error' then case when user_id % 3 = 0 then -user_id else user_id end end as actor_id from events)"
    " select e.*, a.name as clicker_name, b.name as actor_name from e"
    " left join dim a on e.clicker_id = a.c_custkey left join dim b on e.actor_id = b.c_custkey"
)

# Models, reports and landing selections on stand-ins built from the tables.
from .standins import STANDIN_ORACLE_SQL, STANDIN_QUERIES  # noqa: E402

QUERIES.update(STANDIN_QUERIES)
ORACLE_SQL.update(STANDIN_ORACLE_SQL)
ORACLE_SQL["q_dq_measured"] = ORACLE_SQL["q_dq_suite"]
