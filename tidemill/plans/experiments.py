"""Experiment queries.

Units are users.  A unit is exposed by its ``view`` events from 2024-01-11 on; the
group comes from the user id, a few exposures name the other group, and the first
one counts.  The outcome is the value of ``purchase`` events after the exposure,
the covariate the value of all events before it.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.time import time_literal
from tidemill.operators import experiments as x
from tidemill.operators import partial_states
from tidemill.plans.registry import Tables, money, query, shown
from tidemill.session import scratch_path

START = datetime(2024, 1, 11)

_FIRST = """
    WITH exposure AS (
      SELECT user_id AS unit, event_id, ts,
             CASE WHEN (user_id + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END) % 2 = 0 THEN 'control' ELSE 'test' END AS grp
      FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-11'),
    first AS (
      SELECT unit, arg_min(grp, ts) AS grp, min(ts) AS first_ts, min(grp) <> max(grp) AS crossover
      FROM exposure GROUP BY unit)
"""
_UNITS = _FIRST + """,
    totals AS (
      SELECT f.unit, f.grp,
        coalesce(sum(CASE WHEN e.event_type = 'purchase' AND e.ts >= first_ts THEN CAST(value AS DECIMAL(18,2)) END), 0) AS y,
        coalesce(sum(CASE WHEN e.ts >= first_ts THEN 1 ELSE 0 END), 0) AS n_events,
        coalesce(sum(CASE WHEN e.ts < first_ts THEN CAST(value AS DECIMAL(18,2)) END), 0) AS x
      FROM first f LEFT JOIN events e ON e.user_id = f.unit GROUP BY 1, 2),
    units AS (SELECT unit, grp, y, CAST(n_events AS BIGINT) AS n_events, x FROM totals)
"""
_POST = _FIRST + """,
    post AS (SELECT f.unit, f.grp, e.event_id, e.event_type, e.ts, CAST(e.ts AS DATE) AS ds, CAST(e.value AS DECIMAL(18,2)) AS value
             FROM events e JOIN first f ON e.user_id = f.unit AND e.ts >= f.first_ts)
"""


def _tail(z: str) -> str:
    """The polynomial of the normal's upper tail in SQL, doubled."""
    t = f"(1 / (1 + 0.2316419 * abs({z})))"
    poly = (
        f"{t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429))))"
    )
    return f"2 * exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * {poly}"


def _comparison(by: str = "") -> str:
    """SQL over a relation m(by, grp, n, mean, variance)."""
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
    , w AS (SELECT {lead}
        max(n) FILTER (WHERE grp = 'control') AS cn, max(mean) FILTER (WHERE grp = 'control') AS cm,
        max(variance) FILTER (WHERE grp = 'control') AS cv, max(n) FILTER (WHERE grp = 'test') AS tn,
        max(mean) FILTER (WHERE grp = 'test') AS tm, max(variance) FILTER (WHERE grp = 'test') AS tv
        FROM m {group}),
    d AS (SELECT *, tm - cm AS diff, sqrt(tv / tn + cv / cn) AS se FROM w)
    """


def _shown(exact: bool = True) -> str:
    """The result columns.  Sums of decimals are exact, and so are means, differences and lifts made of
    them; whatever holds a variance is rounded."""
    four = (lambda e: e) if exact else (lambda e: f"round({e}, 4)")
    return f"""
    cn AS control_n, {four('cm')} AS control_mean, tn AS test_n, {four('tm')} AS test_mean,
    {four('diff')} AS difference, {four('diff / nullif(cm, 0)')} AS lift, round(se, 4) AS std_error,
    round(diff - 1.959963984540054 * se, 4) AS ci_low, round(diff + 1.959963984540054 * se, 4) AS ci_high,
    CASE WHEN se > 0 THEN round({_tail('(diff / se)')}, 5) END AS p_value
    """


def _rounded(df: DataFrame, *by: str, extra: tuple[str, ...] = (), exact: bool = True) -> DataFrame:
    means = ["control_mean", "test_mean", "difference", "lift"]
    return df.select(
        *by, "control_n", "test_n", *[F.col(c) if exact else F.round(c, 4).alias(c) for c in means],
        *[F.round(c, 4).alias(c) for c in ("std_error", "ci_low", "ci_high")],
        F.round("p_value", 5).alias("p_value"), *[F.round(c, 6).alias(c) for c in extra],
    )


def _exposures(t: Tables) -> DataFrame:
    events = t.events
    start = time_literal(START, events.schema["ts"].dataType.simpleString())
    other = F.when(F.col("event_id") % 97 == 0, 1).otherwise(0)
    group = F.when((F.col("user_id") + other) % 2 == 0, "control").otherwise("test")
    return events.filter((F.col("event_type") == "view") & (F.col("ts") >= start)).select(
        F.col("user_id").alias("unit"), "event_id", "ts", group.alias("group")
    )


def _first(t: Tables) -> DataFrame:
    return x.first_exposure(_exposures(t), tiebreak=["event_id"])


def _events(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("unit"), "event_id", "event_type", "ts", money("value").alias("value")
    )


def _post(t: Tables) -> DataFrame:
    return x.exposure_join(_events(t), _first(t), "event_id")


def _units(t: Tables, as_of: date | None = None) -> DataFrame:
    after = F.col("ts") >= F.col("first_ts")
    measures = {
        "y": F.when((F.col("event_type") == "purchase") & after, F.col("value")),
        "n_events": F.when(after, 1).otherwise(0),
        "x": F.when(~after, F.col("value")),
    }
    return x.unit_totals(_events(t), _first(t), "event_id", measures, as_of=as_of)


@query(
    "canonical_source",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS ds, user_id AS "userID", event_type AS metric, value AS amount
    FROM events
    """,
)
def source(t: Tables) -> DataFrame:
    rows = x.canonical_source(
        t.events, "ts", {"userID": "user_id"},
        {"event_type": "metric", "value": "amount"}, timestamp_as_day=True,
    )
    return rows.select(F.date_format("ts", "yyyy-MM-dd").alias("ds"), "userID", "metric", "amount")


@query(
    "first_exposure",
    _FIRST + "SELECT unit, grp, strftime(first_ts, '%Y-%m-%d %H:%M:%S.%f') AS first_ts, crossover FROM first",
)
def first(t: Tables) -> DataFrame:
    return _first(t).select("unit", F.col("group").alias("grp"), shown("first_ts").alias("first_ts"), "crossover")


@query("exposure_join", _POST + "SELECT unit, grp, event_id FROM post")
def joined(t: Tables) -> DataFrame:
    return _post(t).select("unit", F.col("group").alias("grp"), "event_id")


@query(
    "metric_values",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS ds, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS metric_value
    FROM events GROUP BY 1, 2
    """,
)
def daily_values(t: Tables) -> DataFrame:
    rows = x.metric_values(_events(t), F.to_date("ts"), "event_type", "value")
    return rows.select(
        F.col("ds").cast("string").alias("ds"), "event_type", F.col("metric_value").cast("double").alias("metric_value")
    )


@query(
    "metric_count",
    "SELECT strftime(ts, '%Y-%m-%d') AS ds, event_type, count(value) AS metric_value FROM events GROUP BY 1, 2",
)
def metric_count(t: Tables) -> DataFrame:
    rows = x.metric_values(_events(t), F.to_date("ts"), "event_type", "value", "count")
    return rows.withColumn("ds", F.col("ds").cast("string"))


@query(
    "metric_mean",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS ds, event_type,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS metric_value FROM events GROUP BY 1, 2
    """,
)
def metric_mean(t: Tables) -> DataFrame:
    rows = x.metric_values(_events(t), F.to_date("ts"), "event_type", "value", "mean")
    return rows.withColumn("ds", F.col("ds").cast("string"))


@query(
    "metric_ratio",
    """
    SELECT user_id AS unit,
      CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS numerator,
      count(*) FILTER (WHERE event_type = 'click') AS denominator,
      CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS ratio
    FROM events GROUP BY 1
    """,
)
def metric_ratio(t: Tables) -> DataFrame:
    spent = F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0))
    clicks = F.when(F.col("event_type") == "click", 1).otherwise(0)
    rows = x.ratio_metric(_events(t), ["unit"], spent, clicks)
    return rows.select(
        "unit", F.col("numerator").cast("double").alias("numerator"), "denominator", "ratio"
    )


@query(
    "metric_funnel",
    """
    WITH s1 AS (SELECT user_id, min(ts) AS at FROM events WHERE event_type = 'view' GROUP BY 1),
    s2 AS (SELECT e.user_id, min(e.ts) AS at FROM events e JOIN s1 USING (user_id)
           WHERE event_type = 'click' AND e.ts > s1.at GROUP BY 1),
    s3 AS (SELECT e.user_id, min(e.ts) AS at FROM events e JOIN s2 USING (user_id)
           WHERE event_type = 'purchase' AND value > 100 AND e.ts > s2.at GROUP BY 1),
    c AS (SELECT 1 AS step, count(*) AS units FROM s1 UNION ALL SELECT 2, count(*) FROM s2
          UNION ALL SELECT 3, count(*) FROM s3)
    SELECT step, units, units / lag(units) OVER (ORDER BY step) AS from_previous FROM c
    """,
)
def metric_funnel(t: Tables) -> DataFrame:
    steps = [
        F.col("event_type") == "view",
        F.col("event_type") == "click",
        (F.col("event_type") == "purchase") & (F.col("value") > 100),
    ]
    return x.funnel_metric(_events(t), steps, "event_id")


@query(
    "metric_user_warehouse",
    """
    SELECT event_type, count(*) AS units, CAST(sum(total) AS DOUBLE) / count(*) AS mean_per_unit FROM (
      SELECT event_type, user_id, sum(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1, 2) GROUP BY 1
    """,
)
def metric_user(t: Tables) -> DataFrame:
    return x.user_warehouse_metric(_events(t), "unit", ["event_type"], F.col("value"))


@query(
    "cumulative_exposures",
    _FIRST + """
    , daily AS (SELECT CAST(first_ts AS DATE) AS ds, grp, count(*) AS new_units FROM first GROUP BY 1, 2)
    SELECT strftime(ds, '%Y-%m-%d') AS ds, grp, new_units,
           CAST(sum(new_units) OVER (PARTITION BY grp ORDER BY ds) AS BIGINT) AS units FROM daily
    """,
)
def cumulative(t: Tables) -> DataFrame:
    rows = x.cumulative_exposures(_first(t))
    return rows.select(F.col("ds").cast("string").alias("ds"), F.col("group").alias("grp"), "new_units", "units")


@query(
    "dimensional_exposures",
    _FIRST + """
    SELECT strftime(first_ts, '%w') AS weekday, grp, count(*) AS units FROM first GROUP BY 1, 2
    """,
)
def dimensional(t: Tables) -> DataFrame:
    weekday = (F.dayofweek("first_ts") - 1).cast("string")
    rows = x.dimensional_exposures(_first(t), weekday)
    return rows.select(F.col("dimension").alias("weekday"), F.col("group").alias("grp"), "units")


@query(
    "sample_ratio_mismatch",
    _FIRST + f"""
    , c AS (SELECT count(*) AS n, count(*) FILTER (WHERE grp = 'control') AS a, count(*) FILTER (WHERE grp = 'test') AS b FROM first),
    s AS (SELECT n, (a - n * 0.5) * (a - n * 0.5) / (n * 0.5) + (b - n * 0.5) * (b - n * 0.5) / (n * 0.5) AS chi FROM c)
    SELECT n AS units, 1 AS df, chi AS chi_square, round({_tail('sqrt(chi)')}, 5) AS p_value FROM s
    """,
)
def mismatch(t: Tables) -> DataFrame:
    rows = x.sample_ratio_mismatch(_first(t), {"control": 0.5, "test": 0.5})
    return rows.select(
        "units", "df", "chi_square", F.round("p_value", 5).alias("p_value")
    )


@query(
    "sample_ratio_mismatch_of_three",
    _FIRST + """
    , g AS (SELECT CASE WHEN unit % 5 = 0 THEN 'third' ELSE grp END AS grp, count(*) AS n FROM first GROUP BY 1),
    e AS (SELECT grp, n, (SELECT sum(n) FROM g) * CASE grp WHEN 'third' THEN 0.2 ELSE 0.4 END AS expected FROM g),
    s AS (SELECT CAST(sum(n) AS BIGINT) AS units, sum((n - expected) * (n - expected) / expected) AS chi FROM e)
    SELECT units, 2 AS df, round(chi, 6) AS chi_square, round(exp(-chi / 2), 6) AS p_value,
           CASE WHEN exp(-chi / 2) <= 0.001 THEN 'high' WHEN exp(-chi / 2) <= 0.01 THEN 'medium' WHEN exp(-chi / 2) <= 0.05 THEN 'low' ELSE 'none' END AS severity
    FROM s
    """,
)
def mismatch_of_three(t: Tables) -> DataFrame:
    group = F.when(F.col("unit") % 5 == 0, "third").otherwise(F.col("group"))
    rows = x.sample_ratio_mismatch(_first(t).withColumn("group", group), {"control": 2, "test": 2, "third": 1})
    return rows.select("units", "df", F.round("chi_square", 6).alias("chi_square"), F.round("p_value", 6).alias("p_value"), "severity")


@query(
    "pulse",
    _UNITS + """
    , m AS (SELECT grp, count(*) AS n, CAST(sum(y) AS DOUBLE) / count(*) AS mean, var_samp(y) AS variance FROM units GROUP BY 1)
    """ + _comparison() + f"SELECT {_shown()} FROM d",
)
def pulse(t: Tables) -> DataFrame:
    return _rounded(x.pulse(_units(t), "y", "control", "test"))


@query(
    "pulse_as_of",
    _UNITS.replace("FROM first f LEFT JOIN events e ON e.user_id = f.unit", """FROM (SELECT * FROM first WHERE first_ts < TIMESTAMP '2024-01-21') f
      LEFT JOIN (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-21') e ON e.user_id = f.unit""")
    + """
    , m AS (SELECT grp, count(*) AS n, CAST(sum(y) AS DOUBLE) / count(*) AS mean, var_samp(y) AS variance FROM units GROUP BY 1)
    """ + _comparison() + f"SELECT {_shown()} FROM d",
)
def earlier_pulse(t: Tables) -> DataFrame:
    """The result as it stood at the end of a day."""
    return _rounded(x.pulse(_units(t, date(2024, 1, 20)), "y", "control", "test"))


@query(
    "ratio_pulse",
    _UNITS + """
    , a AS (SELECT grp, count(*) AS n, (CAST(sum(y) AS DOUBLE) / count(*)) / nullif(CAST(sum(n_events) AS DOUBLE) / count(*), 0) AS mean,
              var_samp(y) AS vx, var_samp(n_events) AS vy, covar_samp(y, n_events) AS cxy,
              CAST(sum(n_events) AS DOUBLE) / count(*) AS my FROM units GROUP BY 1),
    m AS (SELECT grp, n, mean, (vx - 2 * mean * cxy + mean * mean * vy) / (my * my) AS variance FROM a)
    """ + _comparison() + f"SELECT {_shown()} FROM d",
)
def ratio_pulse(t: Tables) -> DataFrame:
    return _rounded(x.ratio_pulse(_units(t), "y", "n_events", "control", "test"))


@query(
    "cuped",
    _UNITS + """
    , p AS (SELECT covar_samp(y, x) / var_samp(x) AS theta, avg(x) AS centre FROM units),
    v AS (SELECT grp, y - theta * (x - centre) AS adjusted FROM units, p),
    m AS (SELECT grp, count(*) AS n, avg(adjusted) AS mean, var_samp(adjusted) AS variance FROM v GROUP BY 1)
    """ + _comparison() + f"SELECT {_shown(False)}, (SELECT round(theta, 6) FROM p) AS theta FROM d",
)
def adjusted(t: Tables) -> DataFrame:
    return _rounded(x.cuped(_units(t), "y", "x", "control", "test"), extra=("theta",), exact=False)


_DAILY = _POST + """
    , per AS (SELECT ds, unit, grp, sum(value) AS y FROM post GROUP BY 1, 2, 3),
    m AS (SELECT ds, grp, count(*) AS n, CAST(sum(y) AS DOUBLE) / count(*) AS mean, var_samp(y) AS variance FROM per GROUP BY 1, 2)
    """ + _comparison("ds") + f"SELECT strftime(ds, '%Y-%m-%d') AS ds, {_shown()} FROM d"


@query("daily_pulse", _DAILY)
def by_day(t: Tables) -> DataFrame:
    rows = x.daily_pulse(_post(t), F.col("value"), "control", "test")
    return _rounded(rows.withColumn("ds", F.col("ds").cast("string")), "ds")


@query("incremental_pulse", _DAILY)
def by_day_late(t: Tables) -> DataFrame:
    """The same from states: three batches, of which the later ones reach back into all days, the last one done twice."""
    path, post = scratch_path(t.spark, "states"), _post(t)
    for batch, (low, high) in enumerate([(0, 7), (7, 9), (9, 10), (9, 10)]):
        part = post.filter((F.col("event_id") % 10 >= low) & (F.col("event_id") % 10 < high))
        partial_states.add_to_states(part, "value", path, min(batch, 2))
    rows = partial_states.pulse_from_states(t.spark, path, "control", "test")
    return _rounded(rows.withColumn("ds", F.col("ds").cast("string")), "ds")


@query(
    "topline_impact",
    _POST + """
    , per AS (SELECT ds, unit, grp, sum(value) AS y FROM post GROUP BY 1, 2, 3),
    s AS (SELECT ds, count(*) FILTER (WHERE grp = 'test') AS test_units, CAST(sum(y) AS DOUBLE) AS total,
                 (CAST(sum(y) FILTER (WHERE grp = 'test') AS DOUBLE) / count(*) FILTER (WHERE grp = 'test')
                  - CAST(sum(y) FILTER (WHERE grp = 'control') AS DOUBLE) / count(*) FILTER (WHERE grp = 'control'))
                 * count(*) FILTER (WHERE grp = 'test') AS impact FROM per GROUP BY 1)
    SELECT strftime(ds, '%Y-%m-%d') AS ds, test_units, total, impact, impact / nullif(total, 0) AS impact_share FROM s
    """,
)
def topline(t: Tables) -> DataFrame:
    rows = x.topline_impact(_post(t), F.col("value"), "control", "test")
    return rows.withColumn("ds", F.col("ds").cast("string"))


@query(
    "ingestion_status",
    """
    WITH spine AS (SELECT o_orderpriority, CAST(d AS DATE) AS ds FROM (SELECT DISTINCT o_orderpriority FROM orders),
                   unnest(generate_series(DATE '1994-12-25', DATE '1995-12-31', INTERVAL 1 DAY)) AS s(d)),
    last AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS ds, arg_max(o_orderstatus, o_orderkey) AS status
             FROM orders GROUP BY 1, 2)
    SELECT o_orderpriority AS dataset, strftime(ds, '%Y-%m-%d') AS ds, coalesce(status, 'missing') AS status
    FROM spine LEFT JOIN last USING (o_orderpriority, ds)
    """,
)
def ingestion(t: Tables) -> DataFrame:
    runs = t.orders.select(
        F.col("o_orderpriority").alias("dataset"), F.to_date("o_orderdate").alias("ds"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("run"),
    )
    rows = x.ingestion_status(runs, ["dataset"], date(1994, 12, 25), date(1995, 12, 31), order=["run"])
    return rows.withColumn("ds", F.col("ds").cast("string"))
