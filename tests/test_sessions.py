"""Calls in messages: every rule by a record that obeys it and one that just does not."""

import json

import pytest
from pyspark.sql import functions as F

from tidemill.operators import checks, sessions


def calls_of(spark, *messages, ids=None):
    rows = [(i, m if isinstance(m, str) or m is None else json.dumps(m)) for i, m in zip(ids or range(len(messages)), messages)]
    return sessions.extract_calls(spark.createDataFrame(rows, "session int, line string"), "line")


def found(spark, *messages):
    parts = [r.calls for r in calls_of(spark, *messages).orderBy("session").collect()]
    return [([*c.tools], [*c.commands], [tuple(f) for f in c.failures]) for c in parts]


@pytest.mark.parametrize(
    ("record", "tools", "commands", "failures"),
    [
        # a name alone is no call; a command, arguments or a kind that says tool make it one
        ({"name": "plumber"}, [], [], []),
        ({"name": "plumber", "cmd": "  fix sink\n"}, ["plumber"], ["fix sink"], []),
        ({"name": "plumber", "arguments": "pipe"}, ["plumber"], [], []),
        ({"name": "plumber", "action_type": "ToolUse"}, ["plumber"], [], []),
        ({"tool": "", "command": "fix"}, [], [], []),
        ({"command": "fix"}, [], [], []),
        # keys count in their listed order, also within what was given
        ({"name": "c", "tool": "b", "tool_name": "a", "input": {"shell_command": "s", "cmd": "k"}}, ["a"], ["k"], []),
        ({"name": "a", "arguments": {"cmd": "one"}, "input": {"command": "two"}}, ["a"], ["one"], []),
        ({"name": "a", "arguments": ["no object"], "input": {"command": "two"}}, ["a"], ["two"], []),
        ({"name": "a", "command": "", "input": {"command": "two"}}, ["a"], [], []),
        # failure words and an explicit false, with or without a name
        ({"status": "ERROR"}, [], [], [("unknown", "error")]),
        ({"status": "errors"}, [], [], []),
        ({"success": False}, [], [], [("unknown", "false")]),
        ({"success": False, "status": "Gone", "tool": "a"}, [], [], [("a", "gone")]),
        ({"success": 0, "status": True}, [], [], []),
        # the three named shapes need a payload that is an object
        ({"type": "CALL-TOOL", "payload": {"toolParams": {"command": " go "}}}, ["unknown"], ["go"], []),
        ({"type": "call-tool", "payload": {"toolName": 5, "toolParams": "x"}}, ["unknown"], [], []),
        ({"type": "call-tool", "payload": [], "name": "a"}, ["a"], [], []),
        ({"type": 0, "action_type": "call-tool", "payload": {"toolName": "t"}}, ["t"], [], []),
        ({"type": "call-tool-result", "payload": {"toolName": "t", "result": {"status": "failure"}}}, [], [], [("t", "failure")]),
        ({"type": "call-tool-result", "payload": {"result": {"status": "fine", "inner": {"status": "failed"}}}}, [], [], [("unknown", "failed")]),
        ({"type": "call-tool-result", "payload": {"toolName": "t", "result": "failed"}}, [], [], []),
        ({"type": "other", "payload": {"toolName": "t", "result": {"status": "failed"}}}, [], [], [("unknown", "failed")]),
    ],
)
def test_rules(spark, record, tools, commands, failures):
    wrapped = {"deep": [[{"er": [record]}]]}
    assert found(spark, record, wrapped) == [(tools, commands, failures)] * 2


def test_reading_order_and_repeats(spark):
    message = [
        {"tool": "z", "cmd": "1", "then": {"tool": "y", "cmd": "2"}, "last": [{"tool": "x", "cmd": "3"}]},
        {"tool": "z", "cmd": "1"},
    ]
    assert found(spark, message) == [(["z", "y", "x", "z"], ["1", "2", "3", "1"], [])]
    calls = calls_of(spark, message, message[0], ids=[4, 9])
    assert {tuple(r) for r in sessions.tool_counts(calls, ["session"]).collect()} == {(4, "z", 2), (4, "y", 1), (4, "x", 1), (9, "z", 1), (9, "y", 1), (9, "x", 1)}
    assert [tuple(r) for r in sessions.duplicate_commands(calls, ["session"]).collect()] == [(4, "1", 2)]
    assert [tuple(r) for r in sessions.duplicate_commands(calls, []).orderBy("command").collect()] == [("1", 3), ("2", 2), ("3", 2)]


def test_text_that_is_no_message(spark):
    assert found(spark, "{", None, "7", "null", '"tool"', "") == [([], [], [])] * 6


def counters(**values):
    return {"type": "usage", "payload": values}


def test_greatest_counters_win(spark):
    calls = calls_of(
        spark, counters(requests=1, input_tokens="500", output_tokens=8.9), [counters(requests=6, input_tokens=440, cached_tokens=300)],
        counters(requests="many", total_tokens=-3, cached_tokens=None), ids=[1, 1, 2],
    )
    rows = {r.session: r.asDict() for r in sessions.diagnose(calls, ["session"]).collect()}
    assert rows[1] == {
        "session": 1, "tool_calls": 0, "unexpected_failures": 0, "turns": 6, "input_tokens": 500, "output_tokens": 8, "total_tokens": 0,
        "cached_input_tokens": 300, "uncached_input_tokens": 200, "effective_tokens": 208,
    }
    assert rows[2]["turns"] == rows[2]["total_tokens"] == rows[2]["effective_tokens"] == 0


def test_given_usage_replaces_streamed_counters(spark):
    calls = calls_of(spark, counters(requests=9, input_tokens=90), counters(requests=8, input_tokens=80), ids=[1, 2])
    given = spark.createDataFrame([(1, 3, 31, 7, 38, None)], "session int, requests int, input_tokens int, output_tokens int, total_tokens int, cached_tokens int")
    rows = {r.session: (r.turns, r.input_tokens, r.effective_tokens) for r in sessions.diagnose(calls, ["session"], usage=given).collect()}
    assert rows == {1: (3, 31, 38), 2: (8, 80, 80)}


def test_budget_is_a_strict_bound(spark):
    measured = spark.createDataFrame([(1, 70, None), (2, 71, 4)], "session int, steps int, faults int")
    over = checks.budget_check(measured, {"steps": 70, "faults": 3}, ["session"])
    assert {tuple(r) for r in over.collect()} == {(2, "steps", 71, 70), (2, "faults", 4, 3)}


def test_rules_hold_for_each_session(spark):
    calls = calls_of(spark, {"tool": "t", "cmd": "make all"}, {"tool": "t", "cmd": "drop it\nmake none"}, {"quiet": True}, ids=[1, 2, 3])
    broken = sessions.command_expectations(calls, forbidden=["^drop"], expected=["^make"], by=["session"])
    assert {tuple(r) for r in broken.collect()} == {(2, "^drop", "forbidden"), (3, "^make", "required")}
    together = sessions.command_expectations(calls, forbidden=["^drop"], expected=["^make", "sell"])
    assert {tuple(r) for r in together.collect()} == {("^drop", "forbidden"), ("sell", "required")}


def test_usage_totals(spark):
    rows = [(1, 2, 40, 9, 49, '{"cached_tokens": 25}'), (1, None, 60, None, 60, "not json"), (2, 1, 5, 1, 6, '{"cached_tokens": 80}')]
    turns = spark.createDataFrame(
        rows, "session int, requests int, input_tokens int, output_tokens int, total_tokens int, input_tokens_details string"
    )
    got = {r.session: (r.requests, r.input_tokens, r.cached_input_tokens, r.uncached_input_tokens, r.effective_tokens) for r in sessions.usage_rollup(turns, ["session"]).collect()}
    assert got == {1: (2, 100, 25, 75, 84), 2: (1, 5, 5, 0, 1)}


@pytest.mark.parametrize("split_bytes", ["64", "134217728"])
def test_line_numbers_across_splits(spark, tmp_path, split_bytes):
    lines = [json.dumps({"n": n, "pad": "." * (n % 9)}) for n in range(60)]
    lines[0], lines[29], lines[58], lines[59] = "{oops", "7", "\t", "[]"
    (tmp_path / "a.txt").write_text("\n".join(lines))
    (tmp_path / "b.txt").write_text("{}\n\nnull\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        read = sessions.read_json_lines(spark, str(tmp_path))
        errors = {(r.file[-5:], r.number, r.error) for r in sessions.line_errors(read).collect()}
        good = sessions.good_lines(read).groupBy(F.substring_index("file", "/", -1).alias("f")).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert errors == {
        ("a.txt", 1, "line 1: invalid JSON"), ("a.txt", 30, "line 30: payload is not an object"),
        ("a.txt", 60, "line 60: payload is not an object"), ("b.txt", 3, "line 3: payload is not an object"),
    }
    assert {tuple(r) for r in good} == {("a.txt", 56), ("b.txt", 1)}


def test_commands_unfold_a_message_once(spark):
    call = '{"type":"tool_call","tool_name":"t","arguments":{"command":"%s"}}'
    rows = [("s", call % "ls"), ("s", call % "ls"), ("s", call % "pwd"), ("s", "{}"), ("s", None)]
    calls = sessions.extract_calls(spark.createDataFrame(rows, "session string, message string"), "message")
    for made, wanted in ((sessions.duplicate_commands(calls, ["session"]), [("s", "ls", 2)]), (sessions.tool_counts(calls, ["session"]), [("s", "t", 3)])):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
        assert [tuple(r) for r in made.collect()] == wanted
