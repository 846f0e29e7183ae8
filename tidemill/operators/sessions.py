"""Session logs: JSON lines, calls inside nested messages, usage counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.json import named_objects

# Keys that name a tool or a command, words that mean failure, usage counters.
TOOL_KEYS = ("tool_name", "tool", "name")
COMMAND_KEYS = ("command", "cmd", "shell_command")
FAILURE_WORDS = ("failed", "failure", "error")
USAGE_FIELDS = ("requests", "input_tokens", "output_tokens", "total_tokens", "cached_tokens")
BLANKS = " \t\r\n\f\u000b"


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files with their place and problem (NULL when fine); blank ones are in it, too."""
    parsed = F.try_parse_json("line")
    problem = F.when(parsed.isNull(), "invalid JSON").when(
        ~F.schema_of_variant(parsed).startswith("OBJECT"), "payload is not an object"
    )
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mark"),
        F.col("value").alias("line"),
    )
    return lines.withColumn("problem", F.when(F.btrim("line", F.lit(BLANKS)) != "", problem))


def good_lines(lines: DataFrame) -> DataFrame:
    """The payloads: lines that hold one JSON object."""
    return lines.filter(F.col("problem").isNull() & (F.btrim("line", F.lit(BLANKS)) != "")).select("file", "line")


def line_errors(lines: DataFrame) -> DataFrame:
    """One row per bad line with its line number.

    Files are read in splits; a line's number is its place in the split plus the
    lines of the file's earlier splits.  Only the bad lines are numbered, so the
    texts never shuffle: the rest is counted per split in the map tasks.
    """
    blocks = lines.groupBy("file", "block").agg(F.min("mark").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    bad = lines.filter(F.col("problem").isNotNull()).join(starts, ["file", "block"])
    number = F.col("mark") - F.col("_first") + F.col("_before") + 1
    message = F.concat(F.lit("line "), number.cast("string"), F.lit(": "), F.col("problem"))
    return bad.select("file", number.alias("number"), message.alias("error"))


def _kind(of: Column) -> Column:
    """What a record says it is; an empty, zero or false ``type`` says nothing."""
    said = [F.when(~of[k]["text"].isin("", "false", "0", "0.0") & ~of[k]["kind"].isin("object", "array"), of[k]["text"]) for k in ("type", "action_type")]
    return F.lower(F.coalesce(*said, F.lit("")))


def _text(of: Column, key: str) -> Column:
    return F.when(of[key]["kind"] == "string", of[key]["text"])


def _named(of: Column, keys: Sequence[str]) -> Column:
    """The first of the members that is a string."""
    return F.coalesce(*[_text(of, k) for k in keys])


def _failure(of: Column, tool: Column) -> Column:
    """(tool, status) of a record that failed: its failure word, or ``false`` for an unsuccessful one."""
    word = F.lower(F.coalesce(of["status"]["text"], F.lit("")))
    unsuccessful = F.coalesce((of["success"]["kind"] == "boolean") & (of["success"]["text"] == "false"), F.lit(False))
    status = F.when(word.isin(*FAILURE_WORDS), word).when(unsuccessful, F.when(word == "", "false").otherwise(word))
    return F.when(status.isNotNull(), F.struct(tool.alias("tool"), status.alias("status")))


def _filled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _whole(of: Column, field: str) -> Column:
    """A counter as a whole number: absent and empty ones are 0, unreadable ones NULL."""
    m = of[field]
    number = F.when(m["kind"] == "string", F.btrim(m["text"]).try_cast("bigint")).when(m["kind"] == "number", m["text"].try_cast("double").try_cast("bigint"))
    empty = m.isNull() | (m["kind"] == "null") | (m["text"] == "") | (m["text"] == "false")
    return F.when(empty, F.lit(0)).when(m["text"] == "true", F.lit(1)).otherwise(number).cast("bigint")


#: the members that the rules on calls look at; no other text leaves a message
CALL_MEMBERS = ("type", "action_type", "payload", "arguments", "input", "toolName", "toolParams", "result", "status", "success", *TOOL_KEYS, *COMMAND_KEYS, *USAGE_FIELDS)


def extract_calls(messages: DataFrame, message: str, name: str = "calls") -> DataFrame:
    """Add the calls inside JSON messages of any nesting, as one struct (tools, commands, failures, usage).

    A message is unfolded into its objects; the rules are expressions on them.  ``call-tool`` and
    ``call-tool-result`` records name a tool and its outcome in their payload, ``usage`` records carry counters of which
    the greatest count, and any other object that names a tool and looks like a call is one.  The outcome
    inside a result's payload is judged there and not a second time.  Each message stays in its row.
    """
    records = messages.withColumn("_objects", named_objects(F.col(message), CALL_MEMBERS))
    objects = F.col("_objects")
    of = lambda o, key: F.get(objects, o[key]["at"])
    up = lambda o: F.get(objects, o["up"])
    carries = lambda o, kind: o["payload"]["at"].isNotNull() & (_kind(o) == kind)

    def plain(o: Column) -> Column:
        """Neither one of the three records nor the outcome in one."""
        special = o["payload"]["at"].isNotNull() & _kind(o).isin("call-tool", "call-tool-result", "usage")
        outcome = (o["key"] == "result") & (up(o)["key"] == "payload") & (_kind(up(up(o))) == "call-tool-result")
        return ~special & ~F.coalesce(outcome, F.lit(False))

    def command(o: Column) -> Column:
        given = F.coalesce(of(o, "arguments"), of(o, "input"))
        return _filled(F.coalesce(_named(o, COMMAND_KEYS), _named(given, COMMAND_KEYS)))

    def tool_of(o: Column) -> Column:
        own = _filled(_named(o, TOOL_KEYS))
        looks = o["arguments"].isNotNull() | o["input"].isNotNull() | _kind(o).contains("tool") | command(o).isNotNull()
        return F.when(carries(o, "call-tool"), F.coalesce(_text(of(o, "payload"), "toolName"), F.lit("unknown"))).when(own.isNotNull() & plain(o) & looks, own)

    def command_of(o: Column) -> Column:
        params = of(of(o, "payload"), "toolParams")
        own = F.when(_filled(_named(o, TOOL_KEYS)).isNotNull() & plain(o), command(o))
        return F.btrim(F.when(carries(o, "call-tool"), _filled(_named(params, COMMAND_KEYS))).otherwise(own), F.lit(BLANKS))

    def failure_of(o: Column) -> Column:
        asked = F.coalesce(_filled(of(o, "payload")["toolName"]["text"]), F.lit("unknown"))
        own = F.coalesce(_filled(_named(o, TOOL_KEYS)), F.lit("unknown"))
        outcome = of(of(o, "payload"), "result")
        return F.when(carries(o, "call-tool-result"), _failure(outcome, asked)).when((o["status"].isNotNull() | o["success"].isNotNull()) & plain(o), _failure(o, own))

    def counters(o: Column) -> Column:
        payload = of(o, "payload")
        told = F.struct(*[F.greatest(F.lit(0).cast("bigint"), _whole(payload, f)).alias(f) for f in USAGE_FIELDS])
        return F.when(carries(o, "usage"), told)

    part = lambda rule: F.array_compact(F.transform(objects, rule))
    usage = part(counters)
    greatest = F.struct(*[F.array_max(usage[f]).alias(f) for f in USAGE_FIELDS])
    calls = F.struct(part(tool_of).alias("tools"), part(command_of).alias("commands"), part(failure_of).alias("failures"), greatest.alias("usage"))
    return records.select(*messages.columns, calls.alias(name))


def _each(calls: DataFrame, by: Sequence[str], parts: str, name: str) -> DataFrame:
    """One row per part of a call list.

    Spark would test the list of a plain explode below the projection that makes it, and for that unfold every message a second time.
    """
    each = calls.select(*by, F.posexplode_outer(parts).alias("_at", name))
    return each.filter(F.col("_at").isNotNull()).drop("_at")


def tool_counts(calls: DataFrame, by: Sequence[str], column: str = "calls") -> DataFrame:
    return _each(calls, by, f"{column}.tools", "tool").groupBy(*by, "tool").agg(F.count(F.lit(1)).alias("count"))


def duplicate_commands(calls: DataFrame, by: Sequence[str], column: str = "calls") -> DataFrame:
    """Commands run more than once."""
    counts = _each(calls, by, f"{column}.commands", "command").groupBy(*by, "command").agg(F.count(F.lit(1)).alias("count"))
    return counts.filter(F.col("count") > 1)


def latest_usage(calls: DataFrame, by: Sequence[str], column: str = "calls") -> DataFrame:
    """Running maxima of cumulative counters per session."""
    return calls.groupBy(*by).agg(*[F.coalesce(F.max(f"{column}.usage.{f}"), F.lit(0)).alias(f) for f in USAGE_FIELDS])


def effective_usage(usage: DataFrame, cached: str = "cached_tokens") -> DataFrame:
    """cached = min(cached, input); uncached = input - cached; effective = uncached + output."""
    used = usage.withColumn("cached_input_tokens", F.least("input_tokens", cached))
    used = used.withColumn("uncached_input_tokens", F.col("input_tokens") - F.col("cached_input_tokens"))
    used = used.withColumn("effective_tokens", F.col("uncached_input_tokens") + F.col("output_tokens"))
    return used.drop(cached)


def usage_rollup(turns: DataFrame, by: Sequence[str] = (), details: str = "input_tokens_details") -> DataFrame:
    """Totals of per-turn counters; NULL counts as 0, cached tokens come from the details JSON."""
    counters = ["requests", "input_tokens", "output_tokens", "total_tokens"]
    cached = F.get_json_object(details, "$.cached_tokens").try_cast("bigint")
    sums = [F.sum(F.coalesce(F.col(c).cast("bigint"), F.lit(0))).alias(c) for c in counters]
    totals = turns.groupBy(*by).agg(*sums, F.sum(F.coalesce(cached, F.lit(0))).alias("_cached"))
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in [*counters, "_cached"]]
    return effective_usage(totals.select(*by, *filled), "_cached")


def diagnose(calls: DataFrame, by: Sequence[str], column: str = "calls", usage: DataFrame | None = None) -> DataFrame:
    """One row per session: call counts, failures and effective usage.

    ``usage`` gives counters known from elsewhere, one row per session: where a session has a row, all its
    counters come from there, NULL counting as 0, and the streamed ones are left aside.
    """
    sums = calls.groupBy(*by).agg(
        F.sum(F.size(f"{column}.tools")).alias("tool_calls"),
        F.sum(F.size(f"{column}.failures")).alias("unexpected_failures"),
        *[F.coalesce(F.max(f"{column}.usage.{f}"), F.lit(0)).alias(f) for f in USAGE_FIELDS],
    )
    if usage is not None:
        told = usage.select(*by, F.struct(*[F.coalesce(F.col(f).cast("bigint"), F.lit(0)).alias(f) for f in USAGE_FIELDS]).alias("_told"))
        joined = sums.join(told, list(by), "left") if by else sums.join(told, how="left")
        known = [F.when(F.col("_told").isNotNull(), F.col(f"_told.{f}")).otherwise(F.col(f)).alias(f) for f in USAGE_FIELDS]
        sums = joined.select(*by, "tool_calls", "unexpected_failures", *known)
    return effective_usage(sums).withColumnRenamed("requests", "turns")


def command_expectations(
    calls: DataFrame, forbidden: Sequence[str] = (), expected: Sequence[str] = (), column: str = "calls", by: Sequence[str] = ()
) -> DataFrame:
    """Forbidden patterns that were seen and expected patterns that were not, one row each, for every session in ``by``.

    A session without any command has seen nothing, which breaks what was expected of it.
    """
    from tidemill.operators.checks import text_expectations

    commands = calls.select(*by, F.explode_outer(f"{column}.commands").alias("command"))
    found = text_expectations(commands, "command", required=expected, forbidden=forbidden, by=by)
    return found.filter(~F.col("passed")).select(*by, "pattern", "kind")
