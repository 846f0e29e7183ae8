"""Streaming queries: the event table replayed as a stream, run to its end, and read back."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.time import time_slice
from tidemill.operators.ordering import as_of_join, heavy_keys
from tidemill.operators.skew import skew_join
from tidemill.plans.keyed import _CHANGELOG, _LATEST
from tidemill.plans.registry import Tables, money, query, shown
from tidemill.session import materialize, scratch_path
from tidemill.sources.sinks import discard, shadow_run, statement_set
from tidemill.streaming import keyed, runs, windows

KEYS, ORDER = ["user_id"], ["ts", "event_id"]



def _metrics() -> dict:
    return {"events": F.count(F.lit(1)), "total": F.sum(money("value"))}


def _run(t: Tables, stream: DataFrame, **options) -> DataFrame:
    path = scratch_path(t.spark, "stream")
    runs.bounded_run(stream, path, scratch_path(t.spark, "progress"), partitions=_partitions(t), **options)
    return t.spark.read.parquet(path)


def _partitions(t: Tables) -> int:
    return runs.state_partitions(t.spark, f"{t.folder}/events.parquet")


def _windows(df: DataFrame, *by: str) -> DataFrame:
    return df.select(
        shown("window_start").alias("window_start"), shown("window_end").alias("window_end"), *by, "events",
        F.col("total").cast("double").alias("total"),
    )


def _window_sql(source: str, closed: bool) -> str:
    """Windows as Spark lists them; with ``closed``, those the final watermark has passed."""
    test = "WHERE e <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)" if closed else ""
    return f"""
    WITH w AS ({source})
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(e, '%Y-%m-%d %H:%M:%S.%f') AS window_end, k AS {{key}},
           count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM w {test} GROUP BY 1, 2, 3
    """


_TUMBLING = """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS e,
               event_type AS k, value FROM events"""
_SLIDING = """SELECT b - o * INTERVAL 30 MINUTE AS s, b - o * INTERVAL 30 MINUTE + INTERVAL 1 HOUR AS e, event_type AS k, value
              FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) AS b FROM events), range(2) r(o)"""
_SESSIONS = """SELECT min(ts) OVER x AS s, max(ts) OVER x + INTERVAL 2 HOUR AS e, user_id AS k, value FROM (
                 SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM (
                   SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
               WINDOW x AS (PARTITION BY user_id, n)"""


@query("time_windows_stream", _window_sql(_TUMBLING, True).replace("{key}", "event_type"))
def tumbling_stream(t: Tables) -> DataFrame:
    events = t.stream("events", event_time="ts")
    return _windows(_run(t, windows.time_windows(events, "ts", "1 hour", _metrics(), ["event_type"], delay="10 minutes")), "event_type")


@query("time_windows", _window_sql(_TUMBLING, False).replace("{key}", "event_type"))
def tumbling(t: Tables) -> DataFrame:
    return _windows(windows.time_windows(t.events, "ts", "1 hour", _metrics(), ["event_type"]), "event_type")


@query("time_windows_sliding_stream", _window_sql(_SLIDING, True).replace("{key}", "event_type"))
def sliding_stream(t: Tables) -> DataFrame:
    events = t.stream("events", event_time="ts")
    rolled = windows.time_windows(events, "ts", "1 hour", _metrics(), ["event_type"], slide="30 minutes", delay="10 minutes")
    return _windows(_run(t, rolled), "event_type")


@query("time_windows_sliding", _window_sql(_SLIDING, False).replace("{key}", "event_type"))
def sliding(t: Tables) -> DataFrame:
    return _windows(windows.time_windows(t.events, "ts", "1 hour", _metrics(), ["event_type"], slide="30 minutes"), "event_type")


@query("session_windows_stream", _window_sql(_SESSIONS, True).replace("{key}", "user_id"))
def session_stream(t: Tables) -> DataFrame:
    events = t.stream("events", event_time="ts")
    return _windows(_run(t, windows.session_windows(events, "ts", 7200, _metrics(), KEYS, delay="10 minutes")), "user_id")


@query("session_windows", _window_sql(_SESSIONS, False).replace("{key}", "user_id"))
def session(t: Tables) -> DataFrame:
    return _windows(windows.session_windows(t.events, "ts", 7200, _metrics(), KEYS, heavy=heavy_keys(t.events, KEYS, "ts")), "user_id")


@query("dedupe_by_id", "SELECT event_type, count(*) AS events FROM events GROUP BY 1")
def dedupe_stream(t: Tables) -> DataFrame:
    """Every event delivered twice, counted once."""
    events = t.stream("events", event_time="ts")
    twice = events.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    once = _run(t, windows.dedupe_by_id(twice, ["event_id"], "ts", "1 hour"))
    return once.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query("file_sink", "SELECT event_id, event_type FROM events")
def file_sink(t: Tables) -> DataFrame:
    kept = t.stream("events").select("event_id", "event_type")
    path = scratch_path(t.spark, "sink")
    runs.bounded_run(kept, path, scratch_path(t.spark, "progress"), fmt="json", partitions=_partitions(t))
    return t.spark.read.schema("event_id bigint, event_type string").json(path)


def _split(t: Tables, files: int = 4) -> str:
    """The events as several files, so that a stream can take them one batch at a time."""
    path = scratch_path(t.spark, "split")
    t.events.repartition(files, "event_id").write.parquet(path)
    return path


@query("keyed_table_sink", f"SELECT user_id, event_id, event_type FROM ({_LATEST}) WHERE event_type <> 'error'")
def upserts(t: Tables) -> DataFrame:
    """Keyed upserts and deletes arriving in four batches, out of order; the table's final state."""
    table = scratch_path(t.spark, "table")
    stream = runs.replay(t.spark, _split(t), t.events.schema, max_files=1)
    runs.bounded_batches(stream, keyed.keyed_table_sink(table, KEYS, ORDER), scratch_path(t.spark, "progress"), partitions=_partitions(t))
    state = keyed.read_keyed_table(t.spark, table, KEYS, ORDER, F.col("event_type") == "error")
    return state.select("user_id", "event_id", "event_type")


@query(
    "folding_sink",
    f"""
    WITH l AS ({_LATEST}), k AS (SELECT user_id, event_id, event_type FROM l WHERE event_type <> 'error')
    SELECT user_id, event_id, event_type, CAST(2 AS BIGINT) AS parts FROM k
    """,
)
def folding(t: Tables) -> DataFrame:
    """Five batches into a table that folds itself after every second one: a folded part and the last batch are left."""
    table = scratch_path(t.spark, "table")
    stream = runs.replay(t.spark, _split(t, 5), t.events.schema, max_files=1)
    sink = keyed.keyed_table_sink(table, KEYS, ORDER, compact_every=2)
    runs.bounded_batches(stream, sink, scratch_path(t.spark, "progress"), partitions=_partitions(t))
    state = keyed.read_keyed_table(t.spark, table, KEYS, ORDER, F.col("event_type") == "error")
    return state.select("user_id", "event_id", "event_type", F.lit(keyed.snapshots(t.spark, table).count()).cast("long").alias("parts"))


@query("compact_keyed_table", f"SELECT CAST(1 AS BIGINT) AS snapshots, count(*) AS rows, count(DISTINCT user_id) AS keys FROM ({_LATEST})")
def compacted(t: Tables) -> DataFrame:
    table, folded = scratch_path(t.spark, "table"), scratch_path(t.spark, "folded")
    stream = runs.replay(t.spark, _split(t, 3), t.events.schema, max_files=1)
    runs.bounded_batches(stream, keyed.keyed_table_sink(table, KEYS, ORDER), scratch_path(t.spark, "progress"), partitions=_partitions(t))
    keyed.compact_keyed_table(t.spark, table, folded, KEYS, ORDER)
    return t.spark.read.parquet(folded).agg(
        F.count_distinct("batch_id").alias("snapshots"), F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("keys")
    )


def _changes(t: Tables) -> DataFrame:
    events = t.stream("events", event_time="ts")
    return events.withColumn("v", F.round(F.col("value") / 50, 0)).withColumn("gone", F.col("event_type") == "error")


@query("changelog_stream", _CHANGELOG + "SELECT event_id, user_id, op, v FROM log")
def changelog_stream(t: Tables) -> DataFrame:
    table, log = scratch_path(t.spark, "state"), scratch_path(t.spark, "log")
    sink = keyed.changelog_sink(table, log, KEYS, ORDER, ["v"], F.col("gone"), time_slice(F.col("ts"), 86_400))
    runs.bounded_batches(_changes(t), sink, scratch_path(t.spark, "progress"), partitions=_partitions(t))
    return t.spark.read.parquet(log).select("event_id", "user_id", "op", "v")


def _in_order(t: Tables, files: int = 5) -> str:
    """The events as files that follow one another in time, written one after the other, as a stream takes them."""
    path = scratch_path(t.spark, "ordered")
    moment = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = t.events.agg(F.percentile_approx(moment, [i / files for i in range(1, files)], 1_000)).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges, edges[1:]):
        above = F.lit(True) if low is None else moment > low
        below = F.lit(True) if high is None else moment <= high
        t.events.filter(above & below).write.mode("append").parquet(path)
    return path


def _folded_changes(t: Tables, table: str, log: str) -> None:
    """Change rows of five batches into a table that folds itself after every second one."""
    sink = keyed.changelog_sink(table, log, KEYS, ORDER, ["v"], F.col("gone"), time_slice(F.col("ts"), 86_400), compact_every=2)
    stream = runs.replay(t.spark, _in_order(t), t.events.schema, max_files=t.spark.sparkContext.defaultParallelism, event_time="ts")
    marked = stream.withColumn("v", F.round(F.col("value") / 50, 0)).withColumn("gone", F.col("event_type") == "error")
    runs.bounded_batches(marked, sink, scratch_path(t.spark, "progress"), partitions=_partitions(t))


@query("changelog_folding", _CHANGELOG + "SELECT event_id, user_id, op, v FROM log")
def changelog_folding(t: Tables) -> DataFrame:
    """Change rows against a state that lies in folded files and in later batches."""
    table, log = scratch_path(t.spark, "state"), scratch_path(t.spark, "log")
    _folded_changes(t, table, log)
    return t.spark.read.parquet(log).select("event_id", "user_id", "op", "v")


@query(
    "keyed_lookup",
    f"SELECT user_id, event_id FROM ({_LATEST}) WHERE event_type <> 'error' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')",
)
def looked_up(t: Tables) -> DataFrame:
    """The state of those who ever bought, from the files whose filters may hold them."""
    table, log = scratch_path(t.spark, "state"), scratch_path(t.spark, "log")
    _folded_changes(t, table, log)
    buyers = t.events.filter("event_type = 'purchase'").select("user_id")
    return keyed.read_keyed_table(t.spark, table, KEYS, ORDER, F.col("gone"), only=buyers).select("user_id", "event_id")


@query("state_ttl", _CHANGELOG + "SELECT user_id, op, v, count(*) AS rows FROM log GROUP BY 1, 2, 3")
def expiring(t: Tables) -> DataFrame:
    """The same change rows from expiring keyed state; the run is over long before anything expires."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(provider)
    keyed.use_rocksdb(t.spark)
    try:
        changes = keyed.expiring_changelog(_changes(t), KEYS, ORDER, ["v"], "gone", ttl_seconds=86_400)
        log = _run(t, changes, idle_batches=False)
    finally:
        t.spark.conf.set(provider, before)
    return log.groupBy("user_id", "op", "v").agg(F.count(F.lit(1)).alias("rows"))


def _images_until(t: Tables, moment: str, keep: str) -> tuple[str, str]:
    """The folders of the change rows up to a moment, and of the progress of the run that made them, which is then over."""
    early, log, progress = (scratch_path(t.spark, n) for n in (f"early-{keep}", "log", "progress"))
    t.events.filter(F.col("ts") < F.lit(moment).cast("timestamp")).write.parquet(early)
    runs.bounded_run(_marked(t, early, None), log, progress, partitions=_partitions(t))
    return log, progress


def _marked(t: Tables, source: str, initial: DataFrame | None) -> DataFrame:
    stream = runs.replay(t.spark, source, t.events.schema, event_time="ts")
    marked = stream.withColumn("v", F.round(F.col("value") / 50, 0)).withColumn("gone", F.col("event_type") == "error")
    return keyed.expiring_changelog(marked, KEYS, ORDER, ["v"], "gone", initial=initial)


@contextmanager
def _rocksdb(t: Tables):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(provider)
    keyed.use_rocksdb(t.spark)
    try:
        yield
    finally:
        t.spark.conf.set(provider, before)


@query(
    "stored_state",
    """
    WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15')
    SELECT user_id, round(value / 50, 0) AS v, 'transformWithStateInPandasExec' AS held_by FROM e WHERE n = 1 AND event_type <> 'error'
    """,
)
def stored(t: Tables) -> DataFrame:
    """The state that a stopped run has stored, row by row, beside the operator that holds it."""
    with _rocksdb(t):
        _, progress = _images_until(t, "2024-01-15", "stored")
        names = [r.name for r in keyed.state_stores(t.spark, progress).collect()]  # one row per stateful operator
        return materialize(keyed.stored_images(t.spark, progress).withColumn("held_by", F.lit(",".join(names))))


@query("state_restore", _CHANGELOG + "SELECT user_id, op, v, count(*) AS rows FROM log GROUP BY 1, 2, 3")
def restored(t: Tables) -> DataFrame:
    """The later events against the state that an earlier run left, read as a table and handed to a run of its own."""
    with _rocksdb(t):
        early, progress = _images_until(t, "2024-01-15", "restored")
        images = materialize(keyed.stored_images(t.spark, progress))
        late, log = scratch_path(t.spark, "late"), scratch_path(t.spark, "log")
        t.events.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp")).write.parquet(late)
        runs.bounded_run(_marked(t, late, images), log, scratch_path(t.spark, "progress"), partitions=_partitions(t))
    both = t.spark.read.parquet(early).unionByName(t.spark.read.parquet(log))
    return both.groupBy("user_id", "op", "v").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "state_expired",
    _CHANGELOG.replace("PARTITION BY user_id", "PARTITION BY user_id, ts < TIMESTAMP '2024-01-15'")
    + "SELECT user_id, op, v, count(*) AS rows FROM log GROUP BY 1, 2, 3",
)
def expired(t: Tables) -> DataFrame:
    """State that lives for a second: what arrives seconds later finds no image and starts anew."""
    import time

    source, log, progress = (scratch_path(t.spark, n) for n in ("source", "log", "progress"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(provider)
    keyed.use_rocksdb(t.spark)
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    try:
        for part in (early, ~early):
            t.events.filter(part).write.mode("append").parquet(source)
            stream = runs.replay(t.spark, source, t.events.schema, event_time="ts")
            marked = stream.withColumn("v", F.round(F.col("value") / 50, 0)).withColumn("gone", F.col("event_type") == "error")
            changes = keyed.expiring_changelog(marked, KEYS, ORDER, ["v"], "gone", ttl_seconds=1)
            runs.bounded_run(changes, log, progress, idle_batches=False, partitions=_partitions(t))
            time.sleep(2)
    finally:
        t.spark.conf.set(provider, before)
    return t.spark.read.parquet(log).groupBy("user_id", "op", "v").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "statement_set",
    """
    SELECT 'by_type' AS sink, event_type AS key, count(*) AS events FROM events GROUP BY 2
    UNION ALL SELECT 'by_user', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2
    """,
)
def several_sinks(t: Tables) -> DataFrame:
    """One stream into two tables, each batch computed once."""
    paths = {name: scratch_path(t.spark, name) for name in ("by_type", "by_user")}

    def sink(name: str, key: str) -> Callable[[DataFrame, int], None]:
        append = runs.append_batch(paths[name])
        return lambda batch, n: append(batch.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("events")), n)

    fan = runs.fan_out({"by_type": sink("by_type", "event_type"), "by_user": sink("by_user", "user_id")})
    runs.bounded_batches(t.stream("events"), fan, scratch_path(t.spark, "progress"), partitions=_partitions(t))
    parts = [
        t.spark.read.parquet(path).groupBy("key").agg(F.sum("events").alias("events")).select(F.lit(name).alias("sink"), "key", "events")
        for name, path in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "statement_set_batch",
    """
    SELECT 'F' AS sink, count(*) AS orders FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'O', count(*) FROM orders WHERE o_orderstatus = 'O'
    """,
)
def several_writes(t: Tables) -> DataFrame:
    paths = {s: scratch_path(t.spark, f"status-{s}") for s in ("F", "O")}
    write = {s: (lambda df, s=s, p=p: df.filter(F.col("o_orderstatus") == s).write.parquet(p)) for s, p in paths.items()}
    statement_set(t.orders.select("o_orderkey", "o_orderstatus"), write)
    parts = [
        t.spark.read.parquet(p).agg(F.count(F.lit(1)).alias("orders")).select(F.lit(s).alias("sink"), "orders")
        for s, p in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "shadow_run",
    "SELECT 'totals> +I[' || event_type || ', ' || count(*) || ']' AS line FROM events GROUP BY event_type",
)
def shadowed(t: Tables) -> DataFrame:
    """A job with two outputs, one printed, one discarded."""
    outputs = {
        "totals": t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events")),
        "raw": t.events,
    }
    return shadow_run(outputs, {"totals": "print", "raw": "discard"})["totals"]


def _clicks_and_purchases(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    clicks = events.filter(F.col("event_type") == "click").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    bought = events.filter(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    return clicks, bought


_INTERVAL = """
    SELECT c.user_id, c.event_id AS click_id, p.event_id AS purchase_id FROM events c JOIN events p ON c.user_id = p.user_id
    AND c.event_type = 'click' AND p.event_type = 'purchase' AND p.ts BETWEEN c.ts - INTERVAL 30 MINUTE AND c.ts + INTERVAL 12 HOUR
"""


@query("interval_join", _INTERVAL)
def intervals(t: Tables) -> DataFrame:
    clicks, bought = _clicks_and_purchases(t.events)
    return windows.interval_join(clicks, bought, KEYS, "click_ts", "purchase_ts", 1800, 43_200).select("user_id", "click_id", "purchase_id")


@query("interval_join_stream", _INTERVAL)
def interval_stream(t: Tables) -> DataFrame:
    clicks, _ = _clicks_and_purchases(t.stream("events", event_time="ts"))
    _, bought = _clicks_and_purchases(t.stream("events", event_time="ts"))
    joined = windows.interval_join(
        clicks.withWatermark("click_ts", "1 hour"), bought.withWatermark("purchase_ts", "1 hour"),
        KEYS, "click_ts", "purchase_ts", 1800, 43_200,
    )
    return _run(t, joined).select("user_id", "click_id", "purchase_id")


_AS_OF = """
    WITH v AS (SELECT user_id, ts, event_id AS view_id FROM events WHERE event_type = 'view')
    SELECT p.event_id AS purchase_id, v.view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts
"""


def _views(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type") == "view").select(
        "user_id", F.col("ts").cast("timestamp").alias("view_ts"), F.col("event_id").alias("view_id")
    )


@query("temporal_join", _AS_OF)
def temporal(t: Tables) -> DataFrame:
    bought = t.events.filter(F.col("event_type") == "purchase").select(
        "user_id", "event_id", F.col("ts").cast("timestamp").alias("ts")
    )
    heavy = heavy_keys(t.events, KEYS, "ts")
    rows = as_of_join(bought, _views(t), KEYS, "ts", "view_ts", lambda c: heavy.slice(KEYS, c), ["view_id"])
    return rows.select(F.col("event_id").alias("purchase_id"), F.col("version.view_id").alias("view_id"))


@query("temporal_join_stream", _AS_OF)
def temporal_stream(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "temporal")
    bought = t.stream("events", event_time="ts").filter(F.col("event_type") == "purchase")
    join = windows.temporal_batches(_views(t), KEYS, "ts", "view_ts", lambda c: time_slice(c, 86_400), runs.append_batch(path))
    runs.bounded_batches(bought, join, scratch_path(t.spark, "progress"), partitions=_partitions(t))
    return t.spark.read.parquet(path).select(F.col("event_id").alias("purchase_id"), F.col("version.view_id").alias("view_id"))


_LOOKUP = """
    SELECT e.event_id, c.c_mktsegment FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id AND c.c_acctbal > 0
"""


@query("lookup_join_stream", _LOOKUP)
def lookup_stream(t: Tables) -> DataFrame:
    known = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    events = t.stream("events").select("event_id", "user_id")
    return _run(t, windows.lookup_join(events, known, KEYS)).select("event_id", "c_mktsegment")


@query("lookup_join", _LOOKUP)
def lookup(t: Tables) -> DataFrame:
    known = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    events = t.events.select("event_id", "user_id")
    return skew_join(events, known, KEYS, salt_on=["event_id"], how="left").select("event_id", "c_mktsegment")


_REPLAYED = "SELECT event_type, {n} * count(*) AS deliveries, count(DISTINCT event_id) AS events FROM events GROUP BY 1"


def _twice(t: Tables, second_epoch: int) -> DataFrame:
    """Half of the events, a run, the other half, and a second run in the given epoch."""
    source, target, root = (scratch_path(t.spark, n) for n in ("source", "target", "epochs"))
    schema = t.events.schema
    for run, epoch in enumerate((0, second_epoch)):
        t.events.filter(F.col("event_id") % 2 == run).write.mode("append").parquet(source)
        stream = runs.replay(t.spark, source, schema).select("event_id", "event_type")
        # a target belongs to one progress folder, which numbers its batches
        runs.bounded_run(stream, f"{target}/{epoch}", runs.checkpoint_for(root, "copy", epoch))
    parts = [t.spark.read.parquet(f"{target}/{epoch}") for epoch in sorted({0, second_epoch})]
    delivered = reduce(DataFrame.unionByName, parts)
    return delivered.groupBy("event_type").agg(F.count(F.lit(1)).alias("deliveries"), F.count_distinct("event_id").alias("events"))


@query("restore", _REPLAYED.format(n=1))
def restored(t: Tables) -> DataFrame:
    """The second run goes on where the first one stopped: every event once."""
    return _twice(t, 0)


@query(
    "bookmark_reset",
    """
    SELECT event_type, count(*) + count(*) FILTER (WHERE event_id % 2 = 0) AS deliveries, count(DISTINCT event_id) AS events
    FROM events GROUP BY 1
    """,
)
def reset(t: Tables) -> DataFrame:
    """The second run starts anew: the first half arrives twice."""
    return _twice(t, 1)


@query("tail_follow", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-29 12:00:00'")
def tail(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tail")
    start = F.lit("2024-01-29 12:00:00").cast("timestamp_ntz")
    writer = runs.tail_follow(t.stream("events").select("event_id", "ts"), "ts", start, "1 second")
    started = writer.format("parquet").option("path", path).option("checkpointLocation", scratch_path(t.spark, "progress")).start()
    started.processAllAvailable()
    started.stop()
    return t.spark.read.parquet(path).select("event_id")


@query(
    "stream_join",
    """
    SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id FROM events s JOIN events p ON s.user_id = p.user_id
    AND s.event_type = 'signup' AND p.event_type = 'purchase'
    """,
)
def joined_streams(t: Tables) -> DataFrame:
    """Two unbounded sides joined on their key alone."""
    signups = t.stream("events").filter(F.col("event_type") == "signup")
    bought = t.stream("events").filter(F.col("event_type") == "purchase")
    pairs = windows.regular_join(
        signups.select("user_id", F.col("event_id").alias("signup_id")),
        bought.select("user_id", F.col("event_id").alias("purchase_id")), KEYS,
    )
    return _run(t, pairs)


@query(
    "watermark_late",
    """
    WITH mark AS (SELECT max(ts) FILTER (WHERE event_id % 10 <> 0) - INTERVAL 10 MINUTE AS first, max(ts) - INTERVAL 10 MINUTE AS last FROM events),
    w AS (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS s, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS e FROM events, mark)
    SELECT strftime(s, '%Y-%m-%d') AS day, count(*) AS events, true AS late_reported FROM w
    WHERE e <= last AND (event_id % 10 <> 0 OR e > first) GROUP BY 1
    """,
)
def late(t: Tables) -> DataFrame:
    """A tenth of the events arrives after the rest; what its windows no longer take is dropped and reported."""
    source, path = scratch_path(t.spark, "source"), scratch_path(t.spark, "late")
    progress, report = scratch_path(t.spark, "progress"), None
    for tenth in (False, True):
        t.events.filter((F.col("event_id") % 10 == 0) == F.lit(tenth)).write.mode("append").parquet(source)
        events = runs.replay(t.spark, source, t.events.schema, event_time="ts")
        counted = windows.time_windows(events, "ts", "1 day", {"events": F.count(F.lit(1))}, delay="10 minutes")
        report = runs.bounded_run(counted, path, progress, partitions=_partitions(t))
    rows = t.spark.read.parquet(path)
    return rows.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "events",
        F.lit(report.late_rows_dropped > 0).alias("late_reported"),
    )


@query(
    "dual_mode",
    _window_sql(_TUMBLING, True).replace("{key}", "event_type").replace("WITH w AS", "WITH unused AS (SELECT 1), w AS"),
)
def both_modes(t: Tables) -> DataFrame:
    """The one window function on the batch and on the stream: the rows on which both agree."""
    stream = windows.time_windows(t.stream("events", event_time="ts"), "ts", "1 hour", _metrics(), ["event_type"], delay="10 minutes")
    batch = windows.time_windows(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", _metrics(), ["event_type"])
    return _windows(_run(t, stream).intersect(batch), "event_type")


@query(
    "change_feed",
    "SELECT user_id, event_id, phase FROM ("
    + _LATEST.replace("SELECT *", "SELECT user_id, event_id, 'snapshot' AS phase, event_type").replace("FROM events", "FROM events WHERE ts < TIMESTAMP '2024-01-15'")
    + ") WHERE event_type <> 'error' UNION ALL SELECT user_id, event_id, 'change' FROM events WHERE ts >= TIMESTAMP '2024-01-15'",
)
def feed(t: Tables) -> DataFrame:
    """A change table read from a point on: the state up to there, then every change behind it.  Errors delete."""
    from datetime import datetime

    rows = t.events.select("user_id", "ts", "event_id", "event_type")
    feed = keyed.change_feed(rows, KEYS, ORDER, "ts", datetime(2024, 1, 15), is_delete=F.col("event_type") == "error")
    return feed.select("user_id", "event_id", "phase")


@query(
    "idle_source",
    _window_sql(_TUMBLING, True).replace("{key}", "event_type"),
)
def idle(t: Tables) -> DataFrame:
    """Two sources, one of which falls silent after a third of the time; the other one drives the watermark."""
    events = t.stream("events", event_time="ts")
    silent = (F.col("event_type") == "view") & (F.col("ts") < F.lit("2024-01-10").cast("timestamp"))
    with windows.multi_source_policy(t.spark, slowest=False):
        both = windows.union_sources([events.filter(silent), events.filter(~silent)], "ts", "10 minutes")
        return _windows(_run(t, windows.time_windows(both, "ts", "1 hour", _metrics(), ["event_type"], delay=None)), "event_type")


@query("run_timeout", "SELECT true AS finished, count(*) AS rows, count(DISTINCT event_id) AS events FROM events")
def limited_run(t: Tables) -> DataFrame:
    """A run that may take ten minutes and needs less."""
    path = scratch_path(t.spark, "limited")
    started = (
        t.stream("events").writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", scratch_path(t.spark, "progress")).trigger(availableNow=True).start()
    )
    report = runs.run_timeout(started, 600)
    return t.spark.read.parquet(path).agg(
        F.lit(report.finished).alias("finished"), F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events")
    )


@query("discard_sink", "SELECT count(*) AS discarded, count(*) AS rows FROM events")
def discarded(t: Tables) -> DataFrame:
    """The rows a discarded run reports, next to the rows there are."""
    count = discard(t.events)
    return t.events.agg(F.lit(count).cast("long").alias("discarded"), F.count(F.lit(1)).alias("rows"))
