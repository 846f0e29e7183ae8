"""Metric queries: a series is an event type (and user), its samples are the events' values."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import series
from tidemill.operators.ordering import heavy_keys
from tidemill.plans.registry import Tables, money, query, shown

AT = datetime(2024, 1, 20, 12)


@query(
    "metric_statistics",
    """
    SELECT strftime(time_bucket(INTERVAL 300 SECOND, ts), '%Y-%m-%d %H:%M:%S.%f') AS at, event_type,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "Sum", min(value) AS "Minimum",
           max(value) AS "Maximum", count(value) AS "SampleCount",
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS "Average"
    FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-30'
    GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def statistics(t: Tables) -> DataFrame:
    samples = t.events.select("ts", "event_type", money("value").alias("value"))
    chosen = ["Sum", "Minimum", "Maximum", "SampleCount", "Average"]
    rows = series.metric_statistics(
        samples, ["event_type"], datetime(2024, 1, 2), datetime(2024, 1, 30), statistics=chosen
    )
    doubles = [F.col(c).cast("double").alias(c) for c in ("Sum", "Minimum", "Maximum", "Average")]
    return rows.select(shown("timestamp").alias("at"), "event_type", "SampleCount", *doubles)


@query(
    "metric_catalog",
    """
    SELECT 'events' AS namespace, event_type AS name, CAST(user_id AS VARCHAR) AS user
    FROM events GROUP BY event_type, user_id
    """,
)
def catalog(t: Tables) -> DataFrame:
    samples = t.events.select(
        F.lit("events").alias("namespace"), F.col("event_type").alias("name"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("dimensions"),
    )
    rows = series.metric_catalog(samples, ["namespace", "name", "dimensions"])
    return rows.select("namespace", "name", F.col("dimensions")["user"].alias("user"))


@query(
    "label_match",
    """
    SELECT event_id FROM events WHERE regexp_full_match(event_type, 'p.*|c.*k') AND CAST(ts AS DATE) = DATE '2024-01-15'
    """,
)
def matched(t: Tables) -> DataFrame:
    labels = {"event_type": ("=~", "$kind"), "day": ("=", "2024-01-15"), "event_id": ("=~", "$any")}
    rows = t.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return series.label_match(rows, labels, {"kind": "p.*|c.*k"}).select("event_id")


@query("label_values", "SELECT DISTINCT event_type AS kind FROM events")
def values(t: Tables) -> DataFrame:
    return series.label_values(t.events, F.col("event_type"), "kind")


_INSTANT = """
    WITH v AS (SELECT event_type, user_id, arg_max(value, ts) AS value FROM events
               WHERE ts > TIMESTAMP '2024-01-20 06:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1, 2)
"""


def _vector(t: Tables) -> DataFrame:
    return series.instant_vector(t.events, ["event_type", "user_id"], AT, timedelta(hours=6), tiebreak=["event_id"])


@query("instant_vector", _INSTANT + "SELECT * FROM v")
def vector(t: Tables) -> DataFrame:
    return _vector(t)


@query(
    "sum_by",
    _INSTANT
    + "SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM v GROUP BY 1",
)
def summed(t: Tables) -> DataFrame:
    exact = _vector(t).withColumn("value", money("value"))
    return series.aggregate_vector(exact, ["event_type"], "sum").withColumn("value", F.col("value").cast("double"))


@query("max_by_label", _INSTANT + "SELECT event_type, max(value) AS value FROM v GROUP BY 1")
def greatest(t: Tables) -> DataFrame:
    return series.aggregate_vector(_vector(t), ["event_type"], "max")


@query(
    "counter_rate",
    """
    WITH d AS (
      SELECT event_id, event_type, ts, CAST(value AS DECIMAL(18,2)) AS v,
             lag(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY ts) AS p FROM events),
    r AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END AS rise FROM d)
    SELECT event_id, round(CASE WHEN first_value(ts) OVER w < ts THEN
             CAST(sum(rise) OVER w - first_value(rise) OVER w AS DOUBLE)
             / (epoch_us(ts) - epoch_us(first_value(ts) OVER w)) * 1000000 END, 6) AS rate
    FROM r WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
    """,
)
def rate(t: Tables) -> DataFrame:
    samples = t.events.select("event_id", "event_type", "ts", money("value").alias("value"))
    heavy = heavy_keys(samples, ["event_type"], "ts")
    rows = series.counter_rate(samples, ["event_type"], 6 * 3600, heavy=heavy)
    return rows.select("event_id", F.round("rate", 6).alias("rate"))


@query(
    "last_not_null",
    """
    SELECT user_id, arg_max(value, ts) FILTER (WHERE event_type <> 'error') AS value FROM events GROUP BY 1
    """,
)
def last_value(t: Tables) -> DataFrame:
    gaps = t.events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return series.last_not_null(gaps, ["user_id"], tiebreak=["event_id"])


@query(
    "state_changes",
    """
    WITH s AS (SELECT event_id, user_id, event_type,
                      lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_state FROM events)
    SELECT * FROM s WHERE event_type IS DISTINCT FROM previous_state
    """,
)
def changes(t: Tables) -> DataFrame:
    history = t.events.select("event_id", "user_id", "ts", "event_type")
    cut = heavy_keys(history, ["user_id"], "ts").slice(["user_id"], F.col("ts"))
    rows = series.state_changes(history, ["user_id"], ["ts", "event_id"], "event_type", cut)
    return rows.select("event_id", "user_id", "event_type", "previous_state")


@query(
    "sort_by_time",
    """
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S.%f') AS at, count(value) AS "SampleCount"
    FROM events GROUP BY 1 ORDER BY 1
    """,
)
def by_time(t: Tables) -> DataFrame:
    rows = series.metric_statistics(
        t.events, [], datetime(2000, 1, 1), datetime(2100, 1, 1), 3600, ["SampleCount"]
    )
    return rows.select(shown("timestamp").alias("at"), "SampleCount")
