"""Log queries: events are the log, their type is the stream, type and props are the message."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.time import epoch_ms, iso_from_epoch_ms
from tidemill.operators import logs
from tidemill.plans.registry import Tables, query, shown

REFERENCE = datetime(2024, 1, 20, 12, 0)


@query(
    "time_range",
    """
    SELECT event_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-18 12:00:00' AND ts < TIMESTAMP '2024-01-20 06:00:00'
    """,
)
def in_range(t: Tables) -> DataFrame:
    return logs.time_range(t.events, "ts", "-2d", "2024-01-20T06:00:00Z", REFERENCE).select("event_id", "event_type")


@query(
    "since",
    """
    SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 09:00:00'
    """,
)
def recent(t: Tables) -> DataFrame:
    return logs.since(t.events, "ts", REFERENCE, "3h").select("event_id", "user_id")


@query("state_filter", "SELECT event_id FROM events WHERE event_type IN ('error', 'signup')")
def states(t: Tables) -> DataFrame:
    return logs.state_filter(t.events, "event_type", ["error", "signup"]).select("event_id")


@query("name_prefix", "SELECT event_id, event_type FROM events WHERE starts_with(event_type, 's')")
def prefixed(t: Tables) -> DataFrame:
    return logs.name_prefix(t.events, "event_type", "s").select("event_id", "event_type")


@query(
    "tag_filter",
    """
    SELECT event_id, event_type = 'click' AND user_id % 3 = 1 AS has_all FROM events
    WHERE event_type = 'click' OR user_id % 3 = 1
    """,
)
def tagged(t: Tables) -> DataFrame:
    tags = F.array("event_type", F.concat(F.lit("tier"), (F.col("user_id") % 3).cast("string")))
    events = t.events.select("event_id", tags.alias("tags"))
    wanted = ["click", "tier1"]
    either = logs.tag_filter(events, "tags", wanted)
    every = logs.tag_filter(events, "tags", wanted, match_all=True).select("event_id", F.lit(True).alias("has_all"))
    rows = either.join(every, "event_id", "left")
    return rows.select("event_id", F.coalesce("has_all", F.lit(False)).alias("has_all"))


@query(
    "log_pattern",
    """
    SELECT event_id FROM events WHERE contains(event_type || ' ' || props, 'error')
      AND contains(event_type || ' ' || props, '7')
    """,
)
def pattern(t: Tables) -> DataFrame:
    messages = t.events.select("event_id", F.concat_ws(" ", "event_type", "props").alias("message"))
    return logs.log_pattern(messages, "message", "error 7").select("event_id")


@query("updated_since", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-25 00:00:00'")
def updated(t: Tables) -> DataFrame:
    return logs.updated_since(t.events, "ts", datetime(2024, 1, 25)).select("event_id")


@query(
    "stream_events",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events WHERE event_type = 'error'
    ORDER BY ts DESC, event_id DESC LIMIT 50
    """,
)
def one_stream(t: Tables) -> DataFrame:
    rows = logs.stream_events(t.events, F.col("event_type") == "error", "ts", "event_id", 50)
    return rows.select("event_id", shown("ts").alias("at"))


@query(
    "newest_n_per_stream",
    """
    SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS place
    FROM events QUALIFY place <= 20
    """,
)
def newest(t: Tables) -> DataFrame:
    rows = logs.newest_n_per_stream(t.events.select("event_type", "event_id", "ts"), ["event_type"], "ts", "event_id", 20)
    return rows.select("event_type", "event_id", F.col("rank").cast("long").alias("place"))


@query(
    "cursor_page",
    """
    SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-15'
      AND (ts < TIMESTAMP '2024-01-12' OR (ts = TIMESTAMP '2024-01-12' AND event_id < 4000))
    ORDER BY ts DESC, event_id DESC LIMIT 100
    """,
)
def page(t: Tables) -> DataFrame:
    rows = logs.cursor_page(
        t.events, ["event_id", "event_type", "ts"], "ts", "event_id",
        datetime(2024, 1, 5), datetime(2024, 1, 15), after=(datetime(2024, 1, 12), 4000),
    )
    return rows.select("event_id", "event_type", shown("ts").alias("at"))


@query(
    "follow_cursor",
    """
    SELECT event_id FROM events
    WHERE ts > TIMESTAMP '2024-01-28 06:00:00' OR (ts = TIMESTAMP '2024-01-28 06:00:00' AND event_id > 10)
    """,
)
def follow(t: Tables) -> DataFrame:
    return logs.follow_cursor(t.events, "ts", "event_id", (datetime(2024, 1, 28, 6), 10)).select("event_id")


@query(
    "log_stats",
    """
    SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, user_id,
           count(*) AS events, count(DISTINCT event_type) AS kinds
    FROM events GROUP BY 1, 2
    """,
)
def stats(t: Tables) -> DataFrame:
    by = {"bin": logs.time_bin("ts", "1 day"), "user_id": F.col("user_id")}
    metrics = {"events": F.count(F.lit(1)), "kinds": F.count_distinct("event_type")}
    return logs.log_stats(t.events, by, metrics).select(
        F.date_format("bin", "yyyy-MM-dd").alias("day"), "user_id", "events", "kinds"
    )


@query(
    "pairs_to_row",
    """
    SELECT event_id, event_type AS kind, CAST(user_id + 1 AS VARCHAR) AS person, CAST(NULL AS VARCHAR) AS absent
    FROM events
    """,
)
def pairs(t: Tables) -> DataFrame:
    def pair(name: str, value) -> F.Column:
        return F.struct(F.lit(name).alias("field"), value.cast("string").alias("value"))

    listed = F.array(
        pair("person", F.col("user_id")), pair("kind", F.col("event_type")), pair("person", F.col("user_id") + 1)
    )
    rows = t.events.select("event_id", listed.alias("pairs"))
    return logs.pairs_to_rows(rows, "pairs", ["kind", "person", "absent"])


@query(
    "epoch_ms",
    """
    WITH e AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
    SELECT event_id, ms, strftime(make_timestamp_ms(ms), '%Y-%m-%dT%H:%M:%S') ||
           CASE WHEN ms % 1000 = 0 THEN '' ELSE strftime(make_timestamp_ms(ms), '.%f') END || '+00:00' AS iso
    FROM e
    """,
)
def iso(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", epoch_ms(F.col("ts")).alias("ms"))
    return rows.withColumn("iso", iso_from_epoch_ms(F.col("ms")))


@query(
    "limit",
    "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 77",
)
def first_rows(t: Tables) -> DataFrame:
    return logs.first_rows(t.orders, ["o_orderdate", "o_orderkey"], 77).select("o_orderkey")
