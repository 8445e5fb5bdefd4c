"""Chat formatting: tool calls linked to results, ordered, validated, serialised.

With DataFrame functions only. Messages carry tool calls as a JSON array
(``id, name, arguments``) or answer one (``tool_call_id``).

* Results are first reduced to the earliest per ``(conv_id, id)``, then joined
  by a shuffled hash join, so a call meets one row at most and repeated ids
  cannot multiply.
* A call depends on the calls its ``after`` argument names. Where all names
  point to earlier messages, the order of messages is a topological order and
  one join proves it (``level`` 0). Conversations with a name that points
  ahead get levels by peeling: each round settles the calls whose needs are
  settled, until none is left; what remains is a cycle.
* Arguments are parsed and checked against the tool's schema: required keys,
  types, bounds, no unknown keys.
* The linked call is written as canonical JSON: keys sorted, no white space.

Order inside a conversation: ``level, turn, position``; it is not numbered, so
no conversation has to be gathered in one task.

Edge cases: null or broken ``tool_calls`` hold no calls; a call with a null id
is kept, linked with nothing and marked; a repeated id of a conversation is
marked on all its calls; messages with a null conversation form no links;
names that no call has are marked. Repeated messages are calls of their own.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import store

CALLS = "array<struct<id: string, name: string, arguments: string>>"
#: Rounds of peeling after which the settled calls are written as one table.
MERGE_ROUNDS = 50


@dataclass(frozen=True)
class Property:
    """One argument: its type (string, integer, number, boolean, strings) and bounds."""

    name: str
    type: str
    required: bool = True
    least: int | None = None
    most: int | None = None


@dataclass(frozen=True)
class ToolSchema:
    """A tool and its arguments."""

    name: str
    properties: tuple[Property, ...]


_TYPES = {
    "string": lambda t: t == "STRING",
    "integer": lambda t: t == "BIGINT",
    "number": lambda t: (t == "BIGINT") | (t == "DOUBLE") | t.startswith("DECIMAL"),
    "boolean": lambda t: t == "BOOLEAN",
    "strings": lambda t: t.isin("ARRAY<STRING>", "ARRAY<VOID>"),
}


def property_errors(value: Column, p: Property) -> list[Column]:
    """Error texts of one argument, null where it is right."""
    one = F.try_variant_get(value, f"$['{p.name}']", "variant")
    kind = F.schema_of_variant(one)
    there = one.isNotNull()
    right = F.coalesce(_TYPES[p.type](kind), F.lit(False))
    out = [F.when(there & ~right, F.lit(f"{p.name} is no {p.type}"))]
    if p.required:
        out.append(F.when(~there, F.lit(f"{p.name} is missing")))
    if p.least is not None or p.most is not None:
        number = F.when(there & right, F.try_variant_get(value, f"$['{p.name}']", "double"))
        if p.least is not None:
            out.append(F.when(number < p.least, F.lit(f"{p.name} is below {p.least}")))
        if p.most is not None:
            out.append(F.when(number > p.most, F.lit(f"{p.name} is above {p.most}")))
    return out


def validate(arguments: Column, name: Column, schemas: Sequence[ToolSchema]) -> Column:
    """Array of error texts of a call's arguments (JSON text) under its tool's schema."""
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    out = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for s in schemas:
        known = F.array(*[F.lit(p.name) for p in s.properties])
        keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
        extra = F.transform(F.array_sort(F.array_except(keys, known)), lambda k: F.concat(F.lit("unknown argument "), k))
        own = F.array_compact(F.array(*[e for p in s.properties for e in property_errors(value, p)]))
        out = F.when(name == s.name, F.concat(own, extra)).otherwise(out)
    return F.when(is_object, out).otherwise(F.array(F.lit("arguments are no object")))


def explode_calls(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, position, call_id, name, arguments`` of every call."""
    parsed = F.from_json("tool_calls", CALLS)
    rows = messages.select("conv_id", "turn", F.posexplode(parsed).alias("position", "call"))
    return rows.select("conv_id", "turn", "position", F.col("call.id").alias("call_id"), "call.name", "call.arguments")


def dependencies(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, needs``: distinct names in the ``after`` argument."""
    names = F.try_variant_get(F.try_parse_json("arguments"), "$.after", "array<string>")
    return calls.select("conv_id", "call_id", F.explode(names).alias("needs")).filter("call_id is not null and needs is not null").distinct()


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level, n_needs, missing`` of every distinct call id.

    ``level`` is 0 in conversations whose needs all stand earlier, from 1 on
    in peeled ones, and null inside a cycle or behind one.
    """
    ids = calls.filter("conv_id is not null and call_id is not null")
    # The place of an id is that of its first call.
    places = store(ids.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "position")).alias("at")), "call-places")
    needs = dependencies(ids)
    target = places.select("conv_id", F.col("call_id").alias("needs"), F.col("at").alias("needs_at"))
    edges = needs.join(target, ["conv_id", "needs"], "left").join(places, ["conv_id", "call_id"])
    edges = store(edges.select("conv_id", "call_id", "needs", F.col("needs_at").isNull().alias("missing"), F.coalesce(F.col("needs_at") >= F.col("at"), F.lit(False)).alias("ahead")), "call-edges")
    counts = edges.groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("n_needs"), F.sum(F.col("missing").cast("bigint")).alias("missing"))
    tangled = store(edges.filter("ahead").select("conv_id").distinct(), "call-tangled")
    every = places.select("conv_id", "call_id")
    level = every.join(tangled, "conv_id", "left_anti").withColumn("level", F.lit(0).cast("int"))
    if not tangled.isEmpty():
        level = level.unionByName(peel(every.join(tangled, "conv_id", "left_semi"), edges.filter("not missing").join(tangled, "conv_id", "left_semi")))
    out = level.join(counts, ["conv_id", "call_id"], "left")
    zero = F.lit(0).cast("bigint")
    return out.select("conv_id", "call_id", "level", F.coalesce("n_needs", zero).alias("n_needs"), F.coalesce("missing", zero).alias("missing"))


def peel(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` by rounds; each round's rest is written to the shared folder."""
    rest = store(ids, "peel-rest")
    links = store(edges.select("conv_id", "call_id", "needs"), "peel-links")
    done = None
    for depth in count(1):  # every round settles a call or ends the loop
        ready = store(rest.join(links.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti"), "peel-ready")
        if ready.isEmpty():
            break
        settled = ready.withColumn("level", F.lit(depth).cast("int"))
        done = settled if done is None else done.unionByName(settled)
        if depth % MERGE_ROUNDS == 0:
            done = store(done, "peel-done")
        rest = store(rest.join(ready, ["conv_id", "call_id"], "left_anti"), "peel-rest")
        links = store(links.join(ready.withColumnRenamed("call_id", "needs"), ["conv_id", "needs"], "left_anti"), "peel-links")
    cyclic = rest.withColumn("level", F.lit(None).cast("int"))
    return cyclic if done is None else done.unionByName(cyclic)


def link_tool_calls(messages: DataFrame, schemas: Sequence[ToolSchema]) -> DataFrame:
    """Every call with its result, order, errors and canonical JSON."""
    messages = messages.select("conv_id", "turn", "text", "tool_calls", "tool_call_id")
    calls = explode_calls(messages)
    results = messages.filter("tool_call_id is not null and conv_id is not null").groupBy("conv_id", F.col("tool_call_id").alias("call_id"))
    results = results.agg(F.min(F.struct("turn", "text")).alias("result"), F.count(F.lit(1)).alias("n_results"))
    facts = levels(calls)
    copies = calls.filter("call_id is not null").groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("copies"))
    linked = calls.join(results.hint("shuffle_hash"), ["conv_id", "call_id"], "left").join(facts, ["conv_id", "call_id"], "left").join(copies, ["conv_id", "call_id"], "left")
    problems = F.array_compact(
        F.array(
            F.when(F.col("call_id").isNull(), F.lit("id is missing")),
            F.when(F.col("copies") > 1, F.lit("id is repeated")),
            F.when(F.col("missing") > 0, F.lit("needs an unknown call")),
            F.when(F.col("call_id").isNotNull() & F.col("conv_id").isNotNull() & F.col("level").isNull(), F.lit("needs itself")),
            F.when(F.col("n_results").isNull(), F.lit("has no result")),
            F.when(F.col("n_results") > 1, F.lit("has several results")),
        )
    )
    errors = F.concat(problems, validate(F.col("arguments"), F.col("name"), schemas))
    whole = F.to_json(
        F.struct(
            F.coalesce(F.try_parse_json("arguments"), F.to_variant_object(F.struct(F.col("arguments").alias("text")))).alias("arguments"),
            F.col("call_id").alias("id"),
            "name",
            F.col("result.text").alias("output"),
        ),
        {"ignoreNullFields": "false"},
    )
    # Parsing sorts the keys of every object; writing adds no white space.
    return linked.select(
        "conv_id",
        "turn",
        "position",
        "call_id",
        "name",
        "level",
        F.coalesce("n_needs", F.lit(0).cast("bigint")).alias("n_needs"),
        F.col("result.turn").alias("result_turn"),
        F.array_join(errors, "; ").alias("errors"),
        F.to_json(F.parse_json(whole)).alias("canonical"),
    )


# ------------------------------------------------ calls derived from conversations

#: Schemas of the derived tools (turns as calls); word counts have a bound each.
TURN_TOOLS = tuple(
    ToolSchema(name, (Property("after", "strings", required=False), Property("text", "string"), Property("words", "integer", least=1, most=most)))
    for name, most in (("ask", 60), ("answer", 150), ("configure", 15))
)


def turns_as_messages(conversations: DataFrame) -> DataFrame:
    """Each turn as a call on its text, needing the turn before, which it also answers."""
    id_of = lambda turn: F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    before = F.when(F.col("turn") > 0, id_of(F.col("turn") - 1))
    text = F.coalesce("text", F.lit(""))
    tool = F.when(F.col("role") == "user", "ask").when(F.col("role") == "assistant", "answer").when(F.col("role") == "system", "configure").otherwise(F.col("role"))
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
    arguments = F.to_json(F.struct(words.alias("words"), text.alias("text"), F.when(before.isNotNull(), F.array(before)).alias("after")))
    call = F.array(F.struct(id_of(F.col("turn")).alias("id"), tool.alias("name"), arguments.alias("arguments")))
    return conversations.select("conv_id", "turn", "text", F.to_json(call).alias("tool_calls"), before.alias("tool_call_id"))
