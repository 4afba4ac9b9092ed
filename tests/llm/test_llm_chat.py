import json

from ledgerlens.llm import chat

SCHEMAS = [("weather", "city", "string", True), ("weather", "days", "integer", False), ("weather", "exact", "number", False),
           ("weather", "tags", "array", False), ("weather", "at", "object", False), ("weather", "now", "boolean", False)]


def run(spark, rows):
    schemas = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'own' as linked", "'own' as position", "'own' as name")
    return sorted(chat.format_chat(spark, df, schemas).collect(), key=lambda r: (r.conv_id or -1, r.position))


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a, "after": w} for i, n, a, w in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def test_links_and_topological_order(spark):
    rows = [(1, 0, "user", "Wie ist das Wetter?\n"), (1, 1, "tool", result("b", "late")),
            (1, 2, "assistant", call(("a", "weather", {"days": 2, "city": "Ö"}, None), ("c", "weather", {"city": "x"}, ["b"]))),
            (1, 3, "tool", result("a", "sun")), (1, 4, "assistant", call(("b", "weather", {"city": "y"}, ["a"]))),
            (1, 5, "assistant", "Sonne."), (1, 6, "tool", result("none", "orphan"))]
    got = run(spark, rows)
    order = [(r.kind, r.call_id) for r in got]
    at = {k: i for i, k in enumerate(order)}
    assert order[0] == ("message", None) and [r.position for r in got] == list(range(len(got)))
    assert at[("call", "a")] < at[("result", "a")] < at[("call", "b")] < at[("result", "b")] < at[("call", "c")]
    linked = {(r.kind, r.call_id): r.linked for r in got}
    assert linked[("call", "a")] and linked[("result", "b")]
    assert not linked[("call", "c")] and not linked[("result", "none")]
    by = {(r.kind, r.call_id): r.json for r in got}
    assert by[("call", "a")] == ('{"arguments":{"city":"Ö","days":2},"call_id":"a","name":"weather",'
                                 '"role":"assistant","turn":2}')
    assert by[("result", "a")] == '{"call_id":"a","content":"sun","role":"tool","turn":3}'
    assert all(r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
               for r in got)


def test_arguments_against_schema(spark):
    good = [{"city": "x"}, {"city": "x", "days": 3, "exact": 1.5, "tags": [1], "at": {"a": 1}, "now": True},
            {"city": "x", "exact": 2}]
    bad = [{}, {"days": 1}, {"city": 1}, {"city": "x", "days": "1"}, {"city": "x", "days": 1.5}, {"city": "x", "else": 1},
           {"city": None}, {"city": "x", "now": 1}]
    rows = [(1, i, "assistant", call((f"i{i}", "weather", a, None))) for i, a in enumerate(good + bad)]
    rows += [(1, 90, "assistant", call(("u", "unknown", {}, None)))]
    rows += [(1, 91, "assistant", '{"tool_calls":[{"id":"t","name":"weather","arguments":"no object"}]}')]
    got = {r.call_id: r.valid for r in run(spark, rows)}
    assert [got[f"i{i}"] for i in range(len(good))] == [True] * len(good)
    assert [got[f"i{i}"] for i in range(len(good), len(good + bad))] == [False] * len(bad)
    assert got["u"] is False and got["t"] is False


def test_duplicates_and_circles(spark):
    rows = [(1, 1, "assistant", call(("a", "weather", {"city": "1"}, ["b"]))),
            (1, 2, "assistant", call(("b", "weather", {"city": "2"}, ["a"]))),
            (1, 3, "assistant", call(("a", "weather", {"city": "3"}, None))),
            (1, 4, "tool", result("a", "first")), (1, 5, "tool", result("a", "second"))]
    got = run(spark, rows)
    assert len(got) == 5
    assert sorted((r.turn, r.linked) for r in got) == [(1, True), (2, False), (3, False), (4, True), (5, False)]
    assert any(r.circular for r in got)
    same_turn = run(spark, [(2, 0, "assistant", call(("z", "weather", {}, ["y"]), ("y", "weather", {}, ["x"]),
                                                    ("x", "weather", {}, None)))])
    assert [r.call_id for r in same_turn] == ["x", "y", "z"]


def test_defined_cases(spark):
    rows = [(None, 0, "user", "hi"), (1, None, "user", None), (1, 0, None, "text"), (1, 0, "user", ""), (1, 0, "user", ""),
            (2, 0, "assistant", "{broken"), (2, 1, "assistant", '{"tool_calls":[]}'), (2, 2, "tool", "plain"),
            (2, 3, "assistant", '{"tool_calls":[{"id":null,"name":null,"arguments":null}]}'), (2, 4, "user", "x" * 200_000),
            (2, 5, "assistant", '{"tool_calls":[{"id":"d","name":"weather","arguments":{"city":"a","city":"b"}}]}')]
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert [r.kind for r in got if r.conv_id == 2][:3] == ["message"] * 3
    assert [r.valid for r in got if r.call_id == "d"] == [False]
    assert [r.conv_id for r in got if r.position == 0].count(None) == 1
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chat(spark, empty, spark.createDataFrame(
        SCHEMAS, "name string, field string, type string, required boolean")).count() == 0


def test_long_conversation(spark):
    n = 12_000
    df = spark.range(n).selectExpr("1L as conv_id", "id as turn", "'user' as role", "concat('m', id) as text")
    got = run(spark, [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    assert [r.turn for r in got] == list(range(n)) and [r.position for r in got] == list(range(n))


def test_equal_calls_and_results_are_duplicates(spark):
    """One id and one content at several turns, and twice in one: the earliest is the call, the others stay where they are."""
    c, r = call(("a", "weather", {"city": "x"}, None)), result("a", "sun")
    rows = [(1, 0, "assistant", c), (1, 1, "tool", r), (1, 2, "user", "thanks"), (1, 5, "assistant", c), (1, 6, "tool", r),
            (1, 6, "tool", r)]
    got = run(spark, rows)
    assert [(x.turn, x.kind) for x in got] == [(0, "call"), (1, "result"), (2, "message"), (5, "call"), (6, "result"), (6, "result")]
    assert [x.linked for x in got] == [True, True, False, False, False, False]
    assert [x.duplicate for x in got] == [False, False, False, True, True, True]
    twice = run(spark, [(1, 0, "assistant", c), (1, 0, "assistant", c), (1, 0, "assistant", c), (1, 1, "tool", r)])
    assert sorted((x.kind, x.linked, x.duplicate) for x in twice) == [
        ("call", False, True), ("call", False, True), ("call", True, False), ("result", True, False)]
    alone = run(spark, [(1, 0, "assistant", c), (1, 3, "assistant", c)])
    assert [(x.linked, x.duplicate) for x in alone] == [(False, False), (False, True)]


def test_blanks_before_an_object(spark):
    rows = [(1, 0, "assistant", " \n\t" + call(("a", "weather", {"city": "x"}, None))), (1, 1, "tool", "\r\n " + result("a", "sun"))]
    assert [(x.kind, x.linked) for x in run(spark, rows)] == [("call", True), ("result", True)]
