"""Linking, order, validation and canonical JSON of tool events."""

import json

from blockledger.llm import tool_chat as C

TOOLS = {"add": {"a": ("BIGINT", True), "b": ("BIGINT", False), "note": ("STRING", False)}}
SCHEMA = "conv_id string, turn long, kind string, call_id string, name string, arguments string, parent_id string, content string, extra int"


def run(spark, rows, tools=TOOLS):
    df = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA)
    return C.linked(df, tools).collect()


def call(conv, turn, id_, args='{"a":1}', parent=None, name="add"):
    return (conv, turn, "call", id_, name, args, parent, None)


def result(conv, turn, id_, content="r"):
    return (conv, turn, "result", id_, None, None, None, content)


def test_order_by_generation(spark):
    n = 70  # a chain whose turns run backwards, and a tree
    rows = [call("x", n - k, f"c{k}", parent=f"c{k - 1}" if k else None) for k in range(n)]
    rows += [result("x", 500 - k, f"c{k}") for k in range(n)]
    rows += [call("y", 1, "r"), call("y", 2, "s", parent="r"), call("y", 3, "t", parent="r")]
    got = {(r.conv_id, r.kind, r.call_id): r for r in run(spark, rows)}
    for k in range(n):
        assert got["x", "call", f"c{k}"].generation == 2 * k
        assert got["x", "result", f"c{k}"].generation == 2 * k + 1
        assert got["x", "call", f"c{k}"].status == "ok"
    assert [got["y", "call", c].generation for c in "rst"] == [0, 2, 2]
    assert got["y", "call", "r"].status == "unanswered"


def test_cycles_and_missing_parents(spark):
    rows = [call("x", 1, "a", parent="b"), call("x", 2, "b", parent="a"), call("x", 3, "c", parent="b"),
            call("x", 4, "d", parent="gone"), call("x", 5, "e", parent="e"), call("z", 6, "f", parent="a")]
    got = {r.call_id: r for r in run(spark, rows)}
    assert [got[c].status for c in "abcdef"] == ["cycle", "cycle", "cycle", "no_parent", "cycle", "no_parent"]
    assert got["a"].generation is None and got["d"].generation == 0


def test_validation(spark):
    cases = {"ok": '{"b":2, "a":1}', "missing": '{"b":2}', "type": '{"a":"1"}', "unknown": '{"a":1,"z":0}',
             "float": '{"a":1.5}', "null_optional": '{"a":1,"b":null}', "null": '{"a":null}', "list": "[1]", "text": "hello",
             "none": None, "twice": '{"a":1,"a":2}'}
    rows = [call("x", k, name, args) for k, (name, args) in enumerate(cases.items())]
    rows += [result("x", 50, name) for name in cases] + [call("x", 99, "tool", name="nope")]
    got = {r.call_id: r for r in run(spark, rows) if r.kind == "call"}
    assert got["ok"].status == got["null_optional"].status == "ok"
    assert (got["missing"].status, got["missing"].errors) == ("invalid", ["missing:a"])
    assert got["type"].errors == got["float"].errors == got["null"].errors == ["type:a"]
    assert got["unknown"].errors == ["unknown:z"]
    assert {got[k].status for k in ("list", "text", "none", "twice")} == {"not_json"}
    assert got["tool"].status == "unknown_tool"


def test_canonical_json(spark):
    args = '{ "note" : "é\\n\\"q\\"", "b":2,\n "a":1 }'
    got = {r.kind: r for r in run(spark, [call("x", 1, "i", args), result("x", 2, "i", 'say "hi"\n'),
                                          ("x", 0, "message", None, "system", None, None, "be\tkind")])}
    for r in got.values():
        assert json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json
    assert json.loads(got["call"].json)["arguments"] == {"a": 1, "b": 2, "note": 'é\n"q"'}
    assert got["message"].json == '{"content":"be\\tkind","role":"system","type":"message"}'


def test_repeats_duplicates_and_nulls(spark):
    rows = [call("x", 1, "a"), call("x", 1, "a"), call("x", 2, "a"), result("x", 3, "a"), result("x", 4, "a", "again"),
            result("x", 5, "none"), call(None, 1, "a"), call("x", 6, None), result(None, 1, "a"),
            (None,) * 8, ("x", 7, "message", None, None, None, None, None)]
    got = run(spark, rows)
    assert len(got) == 10
    first, = [r for r in got if r.copies == 2]
    assert (first.turn, first.status, first.n_results) == (1, "ok", 2)
    assert [r.status for r in got if r.turn == 2] == ["duplicate"]
    assert sorted(r.status for r in got if r.kind == "result") == ["ok", "ok", "orphan", "orphan"]
    assert {r.status for r in got if r.kind == "call" and (r.conv_id is None or r.call_id is None)} == {"unanswered"}


def test_no_rows(spark):
    assert run(spark, []) == []


def test_events_of_a_conversation(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"),
             (1, 5, "assistant", "late"), (2, 0, "assistant", "first"), (2, None, "user", "?"), (None, 3, "user", None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in C.linked(C.as_events(df)).collect()}
    assert got["1", 1].generation == 0 and got["1", 2].generation == 1 and got["1", 3].generation == 2
    assert (got["1", 3].status, got["1", 5].status, got["2", 0].status) == ("unanswered", "orphan", "orphan")
    assert got["1", 0].kind == got["2", None].kind == got[None, 3].kind == "message"


def test_plan_has_no_python(spark):
    df = C.linked(C.as_events(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
