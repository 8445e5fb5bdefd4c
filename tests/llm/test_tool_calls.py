from __future__ import annotations

import json

from snapmart.llm import tool_calls as T

MESSAGES = "conv_id bigint, turn bigint, text string, tool_calls string, tool_call_id string, name string, errors string"
TOOLS = (
    T.ToolSchema("find", (T.Property("q", "string"), T.Property("n", "integer", required=False, least=1, most=5), T.Property("after", "strings", required=False))),
    T.ToolSchema("calc", (T.Property("x", "number"), T.Property("deep", "boolean", required=False))),
)


def call(i, name="find", **arguments):
    return {"id": i, "name": name, "arguments": json.dumps(arguments or {"q": "x"})}


def linked(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], MESSAGES)
    return T.link_tool_calls(df, TOOLS).collect()


def said(conv, turn, *calls):
    return conv, turn, None, json.dumps(list(calls)), None


def answer(conv, turn, to, text="ok"):
    return conv, turn, text, None, to


def test_links_validation_and_canonical_json(spark):
    rows = [
        said(1, 0, call("a", q="é \"q\"\n", n=2), call("b", "calc", x=1.5, deep=True)),
        answer(1, 1, "a", "first"),
        answer(1, 2, "a", "second"),
        said(1, 3, call("c", n=9, q=4, z=1), call("d", "what"), {"id": "e", "name": "find", "arguments": "no json"}, {"id": None, "name": "find", "arguments": "{}"}),
        answer(1, 4, "b", None),
        said(2, 0, call("a", q="other conversation", after=["zz"])),
        (2, 1, None, "broken [", None),
        (None, None, None, None, None),
        (None, 1, "t", json.dumps([call("n")]), "n"),
        said(3, 0, call("r"), call("r")),
        answer(3, 1, "r"),
    ]
    got = {(r.conv_id, r.turn, r.position): r for r in linked(spark, rows)}
    assert len(got) == 10
    a = got[1, 0, 0]
    assert a.result_turn == 1 and a.errors == "has several results"
    assert a.canonical == '{"arguments":{"n":2,"q":"é \\"q\\"\\n"},"id":"a","name":"find","output":"first"}'
    assert got[1, 0, 1].errors == "" and json.loads(got[1, 0, 1].canonical)["output"] is None
    assert got[1, 3, 0].errors == "has no result; q is no string; n is above 5; unknown argument z"
    assert got[1, 3, 1].errors == "has no result; unknown tool what"
    assert got[1, 3, 2].errors == "has no result; arguments are no object"
    assert json.loads(got[1, 3, 2].canonical)["arguments"] == {"text": "no json"}
    assert got[1, 3, 3].errors == "id is missing; has no result; q is missing"
    assert got[2, 0, 0].errors == "needs an unknown call; has no result"
    assert got[None, 1, 0].errors == "has no result"
    assert got[3, 0, 0].errors == got[3, 0, 1].errors == "id is repeated"


def test_order(spark):
    forward = [said(1, t, call(f"c{t}", q="x", after=[f"c{k}" for k in range(t)])) for t in range(4)]
    ahead = [said(2, 0, call("x", q="x", after=["y", "z"])), said(2, 1, call("y", q="x", after=["z"]), call("z", q="x")), said(2, 2, call("w", q="x", after=["x"]))]
    cycle = [said(3, 0, call("p", q="x", after=["r"])), said(3, 1, call("r", q="x", after=["p"]), call("s", q="x"), call("t", q="x", after=["r"])), said(3, 2, call("u", q="x", after=["u"]))]
    got = {(r.conv_id, r.call_id): (r.level, r.n_needs) for r in linked(spark, forward + ahead + cycle)}
    assert [got[1, f"c{t}"] for t in range(4)] == [(0, 0), (0, 1), (0, 2), (0, 3)]
    assert {k: got[2, k] for k in "zyxw"} == {"z": (1, 0), "y": (2, 1), "x": (3, 2), "w": (4, 1)}
    assert {k: got[3, k][0] for k in "prstu"} == {"p": None, "r": None, "s": 1, "t": None, "u": None}


def test_one_id_in_most_rows_does_not_multiply(spark):
    rows = [said(1, t, call("hot")) for t in range(200)] + [answer(1, 300 + t, "hot", f"r{t}") for t in range(200)]
    got = linked(spark, rows)
    assert len(got) == 200 and {r.result_turn for r in got} == {300}


def test_empty(spark):
    assert linked(spark, [(1, 0, "plain", None, None)]) == []


def test_plan_has_no_python(spark):
    df = T.turns_as_messages(spark.createDataFrame([(1, 0, "user", "hi")], "conv_id bigint, turn bigint, role string, text string"))
    plan = T.link_tool_calls(df, T.TURN_TOOLS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_long_chain_is_no_cycle(spark, monkeypatch):
    for name in ("MAX_DEPTH", "MERGE_ROUNDS"):  # the bound on rounds of before, and of one union
        monkeypatch.setattr(T, name, 3, raising=False)
    chain = spark.createDataFrame([(1, f"c{i}") for i in range(8)], "conv_id bigint, call_id string")
    needs = spark.createDataFrame([(1, f"c{i}", f"c{i + 1}") for i in range(7)], "conv_id bigint, call_id string, needs string")
    assert {r.call_id: r.level for r in T.peel(chain, needs).collect()} == {f"c{i}": 8 - i for i in range(8)}
