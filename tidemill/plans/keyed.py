"""Keyed-state queries: events are updates of their user; ``error`` events are deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import keyed
from tidemill.operators.ordering import heavy_keys
from tidemill.plans.registry import Tables, query
from tidemill.session import scratch_path
from tidemill.sources.sinks import print_rows

KEYS, ORDER = ["user_id"], ["ts", "event_id"]

_LATEST = """
    SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""
_CHANGELOG = """
    WITH p AS (SELECT event_id, user_id, event_type = 'error' AS gone, round(value / 50, 0) AS v,
                 lag(event_type = 'error') OVER w AS was_gone, lag(round(value / 50, 0)) OVER w AS old
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, coalesce(NOT was_gone, false) AS alive FROM p),
    log AS (
      SELECT event_id, user_id, '-D' AS op, old AS v FROM s WHERE gone AND alive
      UNION ALL SELECT event_id, user_id, '+I', v FROM s WHERE NOT gone AND NOT alive
      UNION ALL SELECT event_id, user_id, '-U', old FROM s WHERE NOT gone AND alive AND v <> old
      UNION ALL SELECT event_id, user_id, '+U', v FROM s WHERE NOT gone AND alive AND v <> old)
"""


def _changes(t: Tables) -> DataFrame:
    return t.events.withColumn("v", F.round(F.col("value") / 50, 0)).withColumn("gone", F.col("event_type") == "error")


def _events(t: Tables) -> DataFrame:
    return t.events.select("user_id", "ts", "event_id", "event_type", "value")


def _log(t: Tables) -> DataFrame:
    cut = heavy_keys(t.events, KEYS, "ts").slice(KEYS, F.col("ts"))
    return keyed.to_changelog(_changes(t), KEYS, ORDER, ["v"], F.col("gone"), cut)


@query("latest_per_key", f"SELECT user_id, event_id, event_type, value FROM ({_LATEST})")
def latest(t: Tables) -> DataFrame:
    return keyed.current_state(_events(t), KEYS, ORDER).select("user_id", "event_id", "event_type", "value")


@query("current_state", f"SELECT user_id, event_id FROM ({_LATEST}) WHERE event_type <> 'error'")
def current(t: Tables) -> DataFrame:
    rows = _events(t).drop("value")
    return keyed.current_state(rows, KEYS, ORDER, F.col("event_type") == "error").select("user_id", "event_id")


@query("merge_state", f"SELECT user_id, event_id FROM ({_LATEST})")
def merged(t: Tables) -> DataFrame:
    rows, half = t.events.select("user_id", "ts", "event_id"), F.col("event_id") % 2 == 0
    state = keyed.current_state(rows.filter(half), KEYS, ORDER)
    return keyed.merge_state(state, rows.filter(~half), KEYS, ORDER).select("user_id", "event_id")


@query("to_changelog", _CHANGELOG + "SELECT event_id, user_id, op, v FROM log")
def changelog(t: Tables) -> DataFrame:
    return _log(t).select("event_id", "user_id", "op", "v")


@query("append_only_check", _CHANGELOG + "SELECT op, count(*) AS rows FROM log WHERE op <> '+I' GROUP BY 1")
def append_only(t: Tables) -> DataFrame:
    return keyed.append_only_check(_log(t))


@query(
    "print_sink",
    _CHANGELOG
    + "SELECT 'users> ' || op || '[' || user_id || ', ' || event_id || ', ' || CAST(v AS DOUBLE) || ']' AS line FROM log",
)
def printed(t: Tables) -> DataFrame:
    return print_rows(_log(t).select("op", "user_id", "event_id", "v"), "users", "op")


@query(
    "table_profile",
    """
    SELECT count(*) AS row_count, count(DISTINCT event_id) AS distinct_keys, min(event_id) AS min_key,
           max(event_id) AS max_key, min(event_type) AS min_text, max(event_type) AS max_text, 1 AS snapshots FROM events
    """,
)
def profile(t: Tables) -> DataFrame:
    return keyed.table_profile(t.events, "event_id", "event_type")


@query(
    "profile_verdict",
    """
    WITH p AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS k, min(o_orderkey) AS lo, max(o_orderkey) AS hi,
                      min(o_orderstatus) AS a, max(o_orderstatus) AS b FROM orders),
    x AS (SELECT count(DISTINCT l_orderkey) AS n, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem),
    c AS (SELECT 'schema' AS "check", true AS passed UNION ALL SELECT 'primary_key', true
      UNION ALL SELECT 'row_count', p.n = x.n FROM p, x UNION ALL SELECT 'distinct_keys', k = x.n FROM p, x
      UNION ALL SELECT 'min_key', p.lo = x.lo FROM p, x UNION ALL SELECT 'max_key', p.hi = x.hi FROM p, x
      UNION ALL SELECT 'single_text', a = 'F' AND b = 'F' FROM p UNION ALL SELECT 'snapshots', true)
    SELECT * FROM c UNION ALL SELECT 'all', bool_and(passed) FROM c
    """,
)
def verdict(t: Tables) -> DataFrame:
    """The orders against what their line items say of them."""
    stored = keyed.table_profile(t.orders, "o_orderkey", "o_orderstatus")
    told = t.lineitem.agg(F.count_distinct("l_orderkey").alias("count"), F.min("l_orderkey").alias("min_key"), F.max("l_orderkey").alias("max_key"))
    return keyed.profile_verdict(stored, {**told.first().asDict(), "text": "F"})


@query(
    "schema_match",
    """
    WITH m AS (SELECT count(*) AS n FROM events WHERE user_id IS NULL)
    SELECT ordinal, name AS actual_name, expected AS expected_name, kind AS actual_type, wanted AS expected_type,
           name IS NOT DISTINCT FROM expected AND kind IS NOT DISTINCT FROM wanted AS matches
    FROM (VALUES (0, 'user_id', 'user_id', 'bigint', 'bigint'), (1, 'n', 'events', 'bigint', 'bigint'),
                 (2, 'last', 'last', 'double', 'string'), (3, NULL, 'extra', NULL, 'int')) v(ordinal, name, expected, kind, wanted)
    """,
)
def schemas(t: Tables) -> DataFrame:
    """The schema a written roll-up comes back with, against the declared one."""
    path = scratch_path(t.spark, "rollup")
    rollup = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max_by("value", "ts").alias("last"))
    rollup.write.parquet(path)
    expected = t.spark.createDataFrame(
        [(0, "user_id", "BIGINT", True), (1, "events", "BIGINT", True), (2, "last", "STRING", True), (3, "extra", "INT", True)],
        "ordinal int, name string, type string, nullable boolean",
    )
    rows = keyed.schema_match(t.spark.read.parquet(path), expected)
    return rows.withColumn("expected_type", F.lower("expected_type"))
