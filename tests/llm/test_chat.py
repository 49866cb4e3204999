import json

from tidemark.llm import chat
from tidemark.llm.queries import TOOLS

SCHEMA = "conv_id long, turn long, role string, text string"


def calls(*items, content=None):
    return json.dumps({"tool_calls": list(items)} | ({"content": content} if content is not None else {}))


def result(call_id, content):
    return json.dumps({"tool_call_id": call_id, "content": content})


def run(spark, rows, schema=SCHEMA):
    units = chat.linked(spark.createDataFrame(rows, schema), TOOLS)
    return sorted(units.collect(), key=lambda r: (r.conv_id is None, r.conv_id or 0, r["at"] or 0, r.level, r.turn or 0, r.seq))


def test_plain_turns_as_json(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = {(r.conv_id, r.turn): r.json for r in chat.linked(turns, TOOLS).collect()}
    assert got == {(r.conv_id, r.turn): json.dumps({"content": r.text, "role": r.role}, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in turns.collect()}


def test_linking_order_and_checks(spark):
    rows = [
        (1, 0, "user", 'say "hi"\né'),
        (1, 1, "assistant", calls({"id": "a", "name": "search", "arguments": {"query": "x", "limit": 5}}, {"id": "b", "name": "calculate", "arguments": '{"digits": -1, "expression": 3, "extra": 1}', "after": ["a", "zz"]}, content="wait")),
        (1, 2, "tool", result("b", {"z": 1, "a": [True, None]})),
        (1, 3, "tool", result("a", "found")),
        (1, 4, "tool", result("a", "again")),
        (1, 5, "tool", result("nobody", 1)),
        (1, 6, "assistant", calls({"id": "a", "name": "search", "arguments": {"query": "y"}}, {"id": "c", "name": "launch", "arguments": "{"})),
        (2, 0, "assistant", calls({"id": "p", "name": "search", "arguments": {"query": "q"}, "after": ["q"]}, {"id": "q", "function": {"name": "search", "arguments": '{"query": ""}'}, "after": ["p"]})),
        (2, 1, "tool", result("a", "other conversation")),
    ]
    got = {(r.conv_id, r.turn, r.kind, r.call_id, r.seq): r for r in run(spark, rows)}
    a, b = got[1, 1, "call", "a", 0], got[1, 1, "call", "b", 1]
    assert (a.status, a.errors, a.json) == ("ok", [], '{"arguments":{"limit":5,"query":"x"},"id":"a","name":"search"}')
    assert b.status == "ok"
    assert sorted(b.errors) == sorted(["arguments: unknown extra", "expression: not string", "digits: beyond minimum", "after: no call zz"])
    assert got[1, 3, "result", "a", 0].status == "ok" and got[1, 4, "result", "a", 0].status == "duplicate" and got[1, 5, "result", "nobody", 0].status == "orphan"
    assert got[1, 2, "result", "b", 0].json == '{"content":{"a":[true,null],"z":1},"role":"tool","tool_call_id":"b"}'
    assert got[1, 6, "call", "a", 0].status == "duplicate"
    assert got[1, 6, "call", "c", 1].errors == ["unknown tool launch", "arguments: no JSON"] and got[1, 6, "call", "c", 1].status == "unanswered"
    assert {got[2, 0, "call", x, k].status for k, x in enumerate("pq")} == {"cyclic"}
    assert got[2, 0, "call", "q", 1].errors == ["query: beyond minLength"]
    assert got[2, 1, "result", "a", 0].status == "orphan"
    order = [(r.kind, r.call_id) for r in run(spark, rows) if r.conv_id == 1 and r.status == "ok" and r.call_id]
    assert order.index(("call", "a")) < order.index(("result", "a")) < order.index(("call", "b")) < order.index(("result", "b"))
    assert got[1, 1, "message", None, -1].json == '{"content":"wait","role":"assistant"}'


def test_long_chain_is_ordered(spark):
    n = 7
    rows = [(1, k, "assistant", calls({"id": f"c{k}", "name": "search", "arguments": {"query": "q"}, "after": [f"c{k + 1}"] if k < n - 1 else []})) for k in range(n)]
    rows += [(1, 100 + k, "tool", result(f"c{k}", k)) for k in range(n)]
    order = [(r.kind, r.call_id) for r in run(spark, rows) if r.call_id]
    assert order == [(kind, f"c{k}") for k in reversed(range(n)) for kind in ("call", "result")]


def test_edges(spark):
    rows = [(None, 0, "assistant", calls({"id": "a", "name": "search", "arguments": {"query": "x"}})), (None, 1, "tool", result("a", 1)), (1, None, "user", None), (1, 0, None, ""), (1, 0, None, ""), (1, 1, "tool", "plain"), (1, 2, "assistant", '{"a":1,"a":2}'), (1, 3, "assistant", calls({"name": "search", "arguments": {"query": "x"}})), (1, 4, "user", "x" * 500_000)]
    got = run(spark, [(*r, "k") for r in rows], SCHEMA + ", status string")
    status = {(r.conv_id, r.turn, r.kind): r.status for r in got}
    assert status[None, 0, "call"] == "unanswered" and status[None, 1, "result"] == "orphan" and status[1, 3, "call"] == "unanswered"
    assert [r.json for r in got if r.turn == 0 and r.conv_id == 1] == ['{"content":"","role":null}'] * 2
    assert [r.json for r in got if r.conv_id == 1 and r.turn is None] == ['{"content":null,"role":"user"}']
    assert [json.loads(r.json)["content"] for r in got if r.turn == 2 and r.conv_id == 1] == ['{"a":1,"a":2}']
    assert run(spark, []) == []


def test_rows_that_repeat_count_once(spark):
    call, answer = (1, 0, "assistant", calls({"id": "a", "name": "search", "arguments": {"query": "x"}})), (1, 1, "tool", result("a", "same"))
    got = run(spark, [call, call, answer, answer, answer])
    assert sorted(r.status for r in got if r.kind == "call") == ["duplicate", "ok"]
    assert sorted(r.status for r in got if r.kind == "result") == ["duplicate", "duplicate", "ok"]


def brute_order(after, turn, answer):
    """(level, at) of each call whose needs can all be met, from what each needs."""
    out = {}
    while True:
        new = {}
        for c in after.keys() - out.keys():
            need = [x for x in after[c] if x in after]
            if all(x in out for x in need):
                new[c] = (max([out[x][0] + 2 for x in need], default=0), max([turn[c], *[max(out[x][1], answer.get(x, out[x][1])) for x in need]]))
        if not new:
            return out
        out |= new


def test_random_needs_against_brute_force(spark):
    import random

    choose = random.Random(3)
    names = [f"c{k}" for k in range(40)]
    after = {c: choose.sample(names, choose.choice([0, 0, 1, 2, 5])) if k > 30 else choose.sample(names[:k], min(k, choose.choice([0, 1, 1, 2, 4]))) for k, c in enumerate(names)}
    turn = {c: k for k, c in enumerate(choose.sample(names, len(names)))}
    answer = {c: 100 + choose.randrange(50) for c in names[:25]}
    rows = [(1, turn[c], "assistant", calls({"id": c, "name": "search", "arguments": {"query": "q"}, "after": [*after[c], "no such call"]})) for c in names]
    rows += [(1, t, "tool", result(c, 1)) for c, t in answer.items()]
    want = brute_order(after, turn, answer)
    got = {r.call_id: r for r in run(spark, rows) if r.kind == "call"}
    assert {c: (r.level - 1, r["at"]) for c, r in got.items() if r.status != "cyclic"} == want
    assert {c for c, r in got.items() if r.status == "cyclic"} == set(names) - set(want)


def test_a_call_that_all_others_need(spark):
    rows = [(1, 0, "assistant", calls({"id": "hub", "name": "search", "arguments": {"query": "q"}})), (1, 1, "tool", result("hub", 1))]
    rows += [(1, 2 + k, "assistant", calls({"id": f"c{k}", "name": "search", "arguments": {"query": "q"}, "after": ["hub"]})) for k in range(300)]
    levels = {r.call_id: r.level for r in run(spark, rows) if r.kind == "call"}
    assert levels.pop("hub") == 1 and set(levels.values()) == {3} and len(levels) == 300


def test_schemas_that_cannot_be_checked_raise():
    import pytest

    for bad in ({"oneOf": []}, {"properties": {"x": {"$ref": "#"}}}, {"items": {"uniqueItems": True}, "type": "array"}, {"additionalProperties": {"type": "string"}}, {"items": [{}]}):
        with pytest.raises(ValueError, match="can't check"):
            chat.schema_errors(chat.F.lit(1), bad)


def test_elements_and_limits_are_checked(spark):
    item = {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "exclusiveMinimum": 0, "maximum": 9}}, "additionalProperties": False}
    tools = {"t": {"type": "object", "properties": {"xs": {"type": "array", "items": item, "minItems": 1, "maxItems": 2, "description": "d"}, "y": {"type": "number", "exclusiveMaximum": 1.5}}}}
    cases = [({"xs": [{"n": 1}]}, []), ({"xs": []}, ["xs: beyond minItems"]), ({"xs": [{"n": 1}] * 3}, ["xs: beyond maxItems"]), ({"xs": [{"n": 0}]}, ["xs: items not by their schema"]), ({"xs": [{"n": 2}, {"m": 1, "n": 1}]}, ["xs: items not by their schema"]), ({"xs": [{}]}, ["xs: items not by their schema"]), ({"y": 1.5}, ["y: beyond exclusiveMaximum"]), ({"y": 1.4}, []), ({"xs": "no"}, ["xs: not array"])]
    rows = [(k, 0, "assistant", calls({"id": "a", "name": "t", "arguments": a})) for k, (a, _) in enumerate(cases)]
    got = {r.conv_id: r.errors for r in chat.linked(spark.createDataFrame(rows, SCHEMA), tools).collect() if r.kind == "call"}
    assert got == {k: e for k, (_, e) in enumerate(cases)}
