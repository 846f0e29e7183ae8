"""Session-log queries: a conversation is a session, each turn a message with calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import redact_value
from tidemill.operators import checks, sessions
from tidemill.plans.registry import Tables, query
from tidemill.session import scratch_path


def messages(t: Tables) -> DataFrame:
    """Three record shapes in one nested message per turn; every message carries its whole text, every fourth as the command."""
    turn, length = F.col("turn"), F.length("text")
    plain = F.struct(
        F.lit("tool_call").alias("type"), F.col("role").alias("tool_name"),
        F.struct(F.when(turn % 4 == 3, F.col("text")).otherwise(F.concat(F.lit("run "), F.col("role"))).alias("command")).alias("arguments"),
        F.when(turn % 5 == 4, "Failed").otherwise("done").alias("status"),
    )
    called = F.struct(
        F.lit("call-tool").alias("type"),
        F.struct(F.lit("shell").alias("toolName"), F.struct(F.lit(" list files ").alias("cmd")).alias("toolParams")).alias("payload"),
    )
    answered = F.struct(
        F.lit("call-tool-result").alias("type"),
        F.struct(F.lit("shell").alias("toolName"), F.struct((turn % 3 != 2).alias("success")).alias("result")).alias("payload"),
    )
    used = F.struct(
        F.lit("usage").alias("type"),
        F.struct(
            (turn + 1).alias("requests"), (turn * 100 + 50).alias("input_tokens"), (length % 1000).alias("output_tokens"),
            (turn * 100 + 50 + length % 1000).alias("total_tokens"), (turn * 70 + 40).alias("cached_tokens"),
        ).alias("payload"),
    )
    said = F.struct(F.lit("text").alias("type"), F.struct(F.col("text").alias("text"), F.array("text", F.lit("x")).alias("parts")).alias("payload"))
    content = F.array(F.to_json(called), F.to_json(said), F.to_json(answered), F.to_json(used))
    message = F.concat(F.lit('{"content":['), F.array_join(content, ","), F.lit('],"inner":{"calls":['), F.to_json(plain), F.lit("]}}"))
    return t.conversations.select("conv_id", "turn", message.alias("message"))


def _calls(t: Tables) -> DataFrame:
    return sessions.extract_calls(messages(t), "message").select("conv_id", "turn", "calls")


@query(
    "json_lines",
    """
    SELECT CASE WHEN turn % 7 = 6 THEN 'invalid JSON' WHEN turn % 7 = 5 THEN 'payload is not an object' ELSE 'none' END AS problem,
           count(*) AS lines FROM conversations WHERE turn % 7 <> 4 GROUP BY 1
    """,
)
def json_lines(t: Tables) -> DataFrame:
    """Messages written as text lines, some broken, some no objects, some blank; read back with their problems."""
    lines = sessions.read_json_lines(t.spark, _lines(t))
    good = sessions.good_lines(lines).select(F.lit("none").alias("problem"))
    bad = sessions.line_errors(lines).select(F.regexp_replace("error", r"^line \d+: ", "").alias("problem"))
    return good.unionByName(bad).groupBy("problem").agg(F.count(F.lit(1)).alias("lines"))


def _lines(t: Tables) -> str:
    path = scratch_path(t.spark, "lines")
    rest = F.col("turn") % 7
    line = F.when(rest == 6, "not-json").when(rest == 5, "[1]").when(rest == 4, "  ").otherwise(F.col("message"))
    messages(t).select(line.alias("value")).write.text(path)
    return path


@query(
    "extract_calls",
    """
    SELECT conv_id, turn, 'shell,' || role AS tools,
      'list files|' || trim(CASE WHEN turn % 4 = 3 THEN text ELSE 'run ' || role END, ' ' || chr(10) || chr(9) || chr(13)) AS commands,
      CASE WHEN turn % 3 = 2 THEN 'shell:false;' ELSE '' END || CASE WHEN turn % 5 = 4 THEN role || ':failed;' ELSE '' END AS failures,
      (turn + 1) || '/' || (turn * 100 + 50) || '/' || (length(text) % 1000) AS usage
    FROM conversations
    """,
)
def calls(t: Tables) -> DataFrame:
    failures = F.transform("calls.failures", lambda f: F.concat(f["tool"], F.lit(":"), f["status"], F.lit(";")))
    usage = [F.col(f"calls.usage.{f}").cast("string") for f in ("requests", "input_tokens", "output_tokens")]
    return _calls(t).select(
        "conv_id", "turn", F.array_join("calls.tools", ",").alias("tools"), F.array_join("calls.commands", "|").alias("commands"),
        F.array_join(failures, "").alias("failures"), F.concat_ws("/", *usage).alias("usage"),
    )


@query(
    "tool_counts",
    """
    SELECT conv_id, role AS tool, count(*) AS count FROM conversations GROUP BY 1, 2
    UNION ALL SELECT conv_id, 'shell', count(*) FROM conversations GROUP BY 1
    """,
)
def tools(t: Tables) -> DataFrame:
    return sessions.tool_counts(_calls(t), ["conv_id"])


@query(
    "duplicate_commands",
    """
    WITH c AS (SELECT conv_id, trim(CASE WHEN turn % 4 = 3 THEN text ELSE 'run ' || role END, ' ' || chr(10) || chr(9) || chr(13)) AS command FROM conversations
               UNION ALL SELECT conv_id, 'list files' FROM conversations)
    SELECT conv_id, command, count(*) AS count FROM c GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def repeated(t: Tables) -> DataFrame:
    return sessions.duplicate_commands(_calls(t), ["conv_id"])


@query(
    "latest_usage",
    """
    SELECT conv_id, max(turn + 1) AS requests, max(turn * 100 + 50) AS input_tokens, max(length(text) % 1000) AS output_tokens,
           max(turn * 100 + 50 + length(text) % 1000) AS total_tokens, max(turn * 70 + 40) AS cached_tokens
    FROM conversations GROUP BY 1
    """,
)
def usage(t: Tables) -> DataFrame:
    return sessions.latest_usage(_calls(t), ["conv_id"])


_DIAGNOSIS = """
    WITH u AS (SELECT conv_id, 2 * count(*) AS tool_calls,
      count(*) FILTER (WHERE turn % 3 = 2) + count(*) FILTER (WHERE turn % 5 = 4) AS unexpected_failures, max(turn + 1) AS turns,
      max(turn * 100 + 50) AS input_tokens, max(length(text) % 1000) AS output_tokens, max(turn * 100 + 50 + length(text) % 1000) AS total_tokens,
      least(max(turn * 100 + 50), max(turn * 70 + 40)) AS cached_input_tokens FROM conversations GROUP BY 1),
    d AS (SELECT *, input_tokens - cached_input_tokens AS uncached_input_tokens,
                 input_tokens - cached_input_tokens + output_tokens AS effective_tokens FROM u)
"""


@query("diagnose_sessions", _DIAGNOSIS + "SELECT * FROM d")
def diagnosis(t: Tables) -> DataFrame:
    return sessions.diagnose(_calls(t), ["conv_id"])


@query(
    "session_budget",
    _DIAGNOSIS + """
    SELECT conv_id, 'tool_calls' AS measure, tool_calls AS value, CAST(4 AS BIGINT) AS "limit" FROM d WHERE tool_calls > 4
    UNION ALL SELECT conv_id, 'effective_tokens', effective_tokens, 700 FROM d WHERE effective_tokens > 700
    UNION ALL SELECT conv_id, 'unexpected_failures', unexpected_failures, 0 FROM d WHERE unexpected_failures > 0
    """,
)
def budget(t: Tables) -> DataFrame:
    found = sessions.diagnose(_calls(t), ["conv_id"])
    return checks.budget_check(found, {"tool_calls": 4, "effective_tokens": 700, "unexpected_failures": 0}, ["conv_id"])


@query(
    "command_expectations",
    """
    WITH c AS (SELECT conv_id, max(turn) AS turns FROM conversations GROUP BY 1)
    SELECT conv_id, '^run system' AS pattern, 'forbidden' AS kind FROM conversations WHERE role = 'system' AND turn % 4 <> 3 AND conv_id % 5 <> 0 GROUP BY 1
    UNION ALL SELECT conv_id, '^run assistant$', 'required' FROM conversations GROUP BY 1
      HAVING NOT bool_or(role = 'assistant' AND turn % 4 <> 3 AND conv_id % 5 <> 0)
    UNION ALL SELECT conv_id, '#never#', 'required' FROM c
    """,
)
def command_rules(t: Tables) -> DataFrame:
    """Rules per session; every fifth session has no commands at all."""
    none = F.col("calls").withField("commands", F.array().cast("array<string>"))
    calls = _calls(t).withColumn("calls", F.when(F.col("conv_id") % 5 == 0, none).otherwise(F.col("calls")))
    return sessions.command_expectations(
        calls, forbidden=["^run system", "#nothing#"], expected=["^run assistant$", "#never#"], by=["conv_id"]
    )


@query(
    "usage_rollup",
    """
    WITH t AS (SELECT conv_id, count(*) AS requests, sum(length(text)) AS input_tokens, CAST(sum(turn) AS BIGINT) AS output_tokens,
                      sum(length(text) + turn) AS total_tokens, CAST(sum(CASE WHEN turn % 2 = 0 THEN 300 ELSE 0 END) AS BIGINT) AS cached FROM conversations GROUP BY 1),
    u AS (SELECT *, least(cached, input_tokens) AS c FROM t)
    SELECT conv_id, requests, CAST(input_tokens AS BIGINT) AS input_tokens, output_tokens, CAST(total_tokens AS BIGINT) AS total_tokens,
           CAST(c AS BIGINT) AS cached_input_tokens, CAST(input_tokens - c AS BIGINT) AS uncached_input_tokens,
           CAST(input_tokens - c + output_tokens AS BIGINT) AS effective_tokens FROM u
    """,
)
def rollup(t: Tables) -> DataFrame:
    turn = F.col("turn")
    details = F.when(turn % 2 == 0, '{"cached_tokens": 300}').when(turn % 4 == 1, "broken")
    turns = t.conversations.select(
        "conv_id", F.lit(1).alias("requests"), F.length("text").alias("input_tokens"),
        F.when(turn > 0, turn).alias("output_tokens"), (F.length("text") + turn).alias("total_tokens"),
        details.alias("input_tokens_details"),
    )
    return sessions.usage_rollup(turns, ["conv_id"])


@query(
    "redact_value",
    r"""
    SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '<redacted>' ELSE md5(regexp_replace(text, '(?i)((?:password|secret|token|api[_-]?key)\s*[:=]\s*)[^\s,;]+', '\1<redacted>', 'g')) END AS value
    FROM conversations
    """,
)
def redacted(t: Tables) -> DataFrame:
    key = F.when(F.col("turn") % 2 == 0, "x-api_key").otherwise("note")
    value = redact_value(key, F.col("text"))
    shown = F.when(value == "<redacted>", value).otherwise(F.md5(F.encode(value, "UTF-8")))
    return t.conversations.select("conv_id", "turn", shown.alias("value"))
