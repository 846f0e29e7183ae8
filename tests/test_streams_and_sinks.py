from datetime import datetime

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tidemill.operators import experiments, logs
from tidemill.sources import catalog, connectors, files, sinks
from tidemill.streaming import keyed, runs, windows

EVENT = "k string, id int, ts timestamp, v int, gone boolean"


def at(minute):
    return datetime(2024, 1, 1, minute // 60, minute % 60)


def write(spark, path, *events):
    rows = [(k, i, at(m), v, g) for k, i, m, v, g in events]
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(path)


def test_changelog_over_several_batches(spark, tmp_path):
    source, state, log, progress = (str(tmp_path / n) for n in ("source", "state", "log", "progress"))
    sink = keyed.changelog_sink(state, log, ["k"], ["ts", "id"], ["v"], F.col("gone"), F.date_trunc("hour", "ts"))
    write(spark, source, ("a", 1, 0, 10, False), ("a", 2, 70, 11, False), ("b", 3, 5, 1, False))
    runs.bounded_batches(runs.replay(spark, source, EVENT), sink, progress)
    write(spark, source, ("a", 4, 80, 11, False), ("a", 5, 90, 12, False), ("b", 6, 95, 0, True))
    runs.bounded_batches(runs.replay(spark, source, EVENT), sink, progress)
    assert as_set(spark.read.parquet(log).select("batch_id", "k", "id", "op", "v")) == {
        (0, "a", 1, "+I", 10), (0, "a", 2, "-U", 10), (0, "a", 2, "+U", 11), (0, "b", 3, "+I", 1),
        (1, "a", 5, "-U", 11), (1, "a", 5, "+U", 12), (1, "b", 6, "-D", 1),
    }
    held = keyed.read_keyed_table(spark, state, ["k"], ["ts", "id"], F.col("gone"))
    assert as_set(held.select("k", "v")) == {("a", 12)}
    assert as_set(keyed.snapshots(spark, state)) == {(0, 2), (1, 2)}


def test_a_retried_batch_changes_nothing(spark, tmp_path):
    state, log = str(tmp_path / "state"), str(tmp_path / "log")
    sink = keyed.changelog_sink(state, log, ["k"], ["ts", "id"], ["v"], F.col("gone"), F.date_trunc("hour", "ts"))
    batch = spark.createDataFrame([("a", 1, at(0), 10, False), ("a", 2, at(1), 11, False)], EVENT)
    for _ in range(2):
        sink(batch, 0)
    assert spark.read.parquet(log).count() == 3 and keyed.snapshots(spark, state).count() == 1


def test_redelivered_updates_leave_one_row_per_key(spark, tmp_path):
    """120 events on 100 keys, twenty of them delivered again."""
    state = str(tmp_path / "state")
    events = spark.range(120).select(
        (F.col("id") % 100).cast("string").alias("k"), F.col("id").cast("int").alias("id"),
        F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").cast("int").alias("v"), F.lit(False).alias("gone"),
    )
    sink = keyed.keyed_table_sink(state, ["k"], ["ts", "id"])
    sink(events.filter("id >= 60"), 0)
    sink(events.filter("id < 80"), 1)
    held = keyed.read_keyed_table(spark, state, ["k"], ["ts", "id"])
    assert held.count() == 100 and held.filter("v >= 100").count() == 20


def test_restart_and_reset(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    write(spark, source, ("a", 1, 0, 1, False))

    def run(epoch):
        stream = runs.replay(spark, source, EVENT).select("id")
        return runs.bounded_run(stream, f"{root}/out{epoch}", runs.checkpoint_for(root, "job", epoch)).input_rows

    assert run(0) == 1
    write(spark, source, ("a", 2, 1, 1, False))
    assert run(0) == 1
    assert run(1) == 2
    assert spark.read.parquet(f"{root}/out0").count() == spark.read.parquet(f"{root}/out1").count() == 2


def test_late_rows_are_reported(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("source", "out", "progress"))
    reports = []
    for events in ([("a", 1, 0, 1, False), ("a", 2, 300, 1, False)], [("a", 3, 1, 1, False)]):
        write(spark, source, *events)
        stream = windows.time_windows(runs.replay(spark, source, EVENT), "ts", "10 minutes", {"n": F.count(F.lit(1))}, delay="5 minutes")
        reports.append(runs.bounded_run(stream, out, progress))
    assert [r.late_rows_dropped for r in reports] == [0, 1]
    assert [r.n for r in spark.read.parquet(out).collect()] == [1]


def test_time_limit(spark, tmp_path):
    endless = spark.readStream.format("rate").load()
    query = endless.writeStream.format("noop").option("checkpointLocation", str(tmp_path)).start()
    assert not runs.run_timeout(query, 1).finished
    assert not query.isActive


def test_state_partitions_follow_the_input(spark, small):
    path = f"{small}/events.parquet"
    assert runs.state_partitions(spark, path) == 8
    assert runs.state_partitions(spark, path, bytes_each=1) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_run_leaves_the_settings_alone(spark, tmp_path):
    source = str(tmp_path / "source")
    write(spark, source, ("a", 1, 0, 1, False))
    names = (runs.IDLE_BATCHES, runs.SHUFFLE_PARTITIONS)
    before = [spark.conf.get(n) for n in names]
    counted = runs.replay(spark, source, EVENT).groupBy("k").count()
    runs.bounded_batches(counted, runs.append_batch(str(tmp_path / "out")), str(tmp_path / "c"), "complete", partitions=3)
    assert [spark.conf.get(n) for n in names] == before
    assert len(list((tmp_path / "c" / "state" / "0").glob("[0-9]*"))) == 3


def test_policies_are_settings(spark):
    name = "spark.sql.streaming.multipleWatermarkPolicy"
    with windows.multi_source_policy(spark, slowest=False):
        assert spark.conf.get(name) == "max"
        with windows.multi_source_policy(spark):
            assert spark.conf.get(name) == "min"
        assert spark.conf.get(name) == "max"
    assert spark.conf.get(name) == "min"


def test_shadow_run_refuses_what_could_leave(spark, tmp_path):
    job = {"out": spark.range(3), "log": spark.range(2)}
    local = f"file://{tmp_path}/log"
    with pytest.raises(sinks.UnsafeJob, match="no shadow for log"):
        sinks.shadow_run(job, {"out": "print"})
    with pytest.raises(sinks.UnsafeJob, match="without output"):
        sinks.shadow_run(job, {"out": "print", "log": "discard", "more": "discard"})
    for remote in ("s3://bucket/x", "/plain/path", "hdfs://h/x"):
        with pytest.raises(sinks.UnsafeJob, match="not local"):
            sinks.shadow_run(job, {"out": "discard", "log": remote})
    seen = sinks.shadow_run(job, {"out": "print", "log": local})
    assert as_set(seen["out"]) == {(f"out> +I[{i}]",) for i in range(3)}
    assert seen["log"].count() == 2


def test_refresh_reports_failure(spark, tmp_path):
    broken = spark.range(3).select(F.raise_error(F.lit("no source")).alias("x"))
    report = sinks.full_refresh(broken, str(tmp_path / "x"))
    assert report["status"] == "FAILED" and report["rows_ingested"] == 0 and report["error"]


def test_strict_json_and_not_null(spark):
    bad = spark.createDataFrame([('{"a": 1}',), ("{",)], "t string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.parse_json_strict(bad, "t", "a int").collect()
    assert [r.rejected for r in files.parse_json_lenient(bad, "t", "a int").collect()] == [False, True]
    holes = spark.createDataFrame([(1, None)], "a int, b string")
    with pytest.raises(Exception, match="NOT NULL"):
        files.not_null_policy(holes, ["a", "b"]).collect()
    assert files.not_null_policy(holes, ["a"]).count() == 1


def test_select_object_documents(spark, tmp_path):
    (tmp_path / "doc.json").write_text('[{"id": 1,\n "event": "a"},\n {"id": 2, "event": "b"}]')
    found = files.select_object(spark, str(tmp_path), "SELECT count(*) AS n, max(event) AS e FROM s3object", "json", json_type="DOCUMENT")
    assert tuple(found.first()) == (2, "b")
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.csv").write_text("col1,col2\n1,2\n")
    assert tuple(files.select_object(spark, str(tmp_path / "t"), "SELECT col2 FROM s3object", "csv").first()) == ("2",)
    with pytest.raises(ValueError):
        files.select_object(spark, str(tmp_path), "SELECT 1", "avro")


def test_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sales")
    spark.sql("CREATE TABLE IF NOT EXISTS sales.orders (id BIGINT, amount DOUBLE, dt STRING) USING parquet PARTITIONED BY (dt)")
    spark.sql("INSERT INTO sales.orders VALUES (1, 2.5, '2026-01-01'), (2, 3.5, '2026-01-02')")
    assert "sales" in {r[0] for r in catalog.catalog_databases(spark).collect()}
    assert [r.tableName for r in catalog.catalog_tables(spark, "sales", "^ord").collect()] == ["orders"]
    columns = {(r.column, r.type, r.is_partition) for r in catalog.catalog_columns(spark, "sales", "orders").collect()}
    assert columns == {("id", "bigint", False), ("amount", "double", False), ("dt", "string", True)}
    assert [r.column for r in catalog.catalog_search(spark, "AMOU", ["sales"]).collect()] == ["amount"]
    spark.sql("ALTER TABLE sales.orders ADD IF NOT EXISTS PARTITION (dt='2026-01-09') LOCATION '/tmp/elsewhere/none'")
    listed = {r.dt: r.location for r in catalog.partition_filter(spark, "sales.orders", "dt > '2026-01-01'").collect()}
    assert listed.keys() == {"2026-01-02", "2026-01-09"}
    assert listed["2026-01-02"].endswith("/orders/dt=2026-01-02") and listed["2026-01-09"].endswith("/tmp/elsewhere/none")
    with pytest.raises(Exception, match="amount"):
        catalog.partition_filter(spark, "sales.orders", "amount > 1")
    assert catalog.table_preview(spark, "sales.orders", ["id"], 1).first().id == 1
    assert catalog.table_metadata(spark, "sales.orders").count() > 3
    assert catalog.analyze_table(spark, "sales.orders", ["id"]).count() > 3


def test_topic_records_decode_or_fail(spark):
    raw = spark.createDataFrame([(bytearray(b'{"a": 1}'), at(0), 0, 5)], "value binary, timestamp timestamp, partition int, offset long")
    assert connectors.decode_topic(raw, "a int").first().a == 1
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        connectors.decode_topic(raw.withColumn("value", F.lit(bytearray(b"{"))), "a int").collect()


def test_canonical_source_needs_its_columns(spark):
    source = spark.createDataFrame([(1, at(0))], "user int, seen timestamp")
    assert experiments.canonical_source(source, "seen", {"userID": "user"}).columns == ["ts", "userID"]
    with pytest.raises(ValueError):
        experiments.canonical_source(source, "seen", {})
    with pytest.raises(ValueError):
        experiments.canonical_source(source, "when", {"userID": "user"})


def test_cursor_pages_cover_everything_once(spark):
    events = spark.createDataFrame([(i, at(i // 4)) for i in range(30)], "id int, ts timestamp")
    seen, after = [], None
    while True:
        page = logs.cursor_page(events, ["id", "ts"], "ts", "id", at(0), at(100), after, limit=7).collect()
        if not page:
            break
        seen += [r.id for r in page]
        after = (page[-1].ts, page[-1].id)
    assert seen == sorted(range(30), reverse=True)


def test_interval_join_against_all_pairs(spark):
    import random

    rng = random.Random(1)
    left = [("hot" if i % 3 else "k", i, at(rng.randrange(600))) for i in range(60)]
    right = [("hot" if i % 3 else "k", i, at(rng.randrange(600))) for i in range(60)]
    a = spark.createDataFrame(left, "k string, l int, lt timestamp")
    b = spark.createDataFrame(right, "k string, r int, rt timestamp")
    got = as_set(windows.interval_join(a, b, ["k"], "lt", "rt", 600, 1800).select("l", "r"))
    want = {(i, j) for k, i, t in left for q, j, u in right if k == q and -600 <= (u - t).total_seconds() <= 1800}
    assert got == want


def test_folding_survives_a_retry(spark, tmp_path):
    path = str(tmp_path / "t")
    sink = keyed.keyed_table_sink(path, ["k"], ["n"], compact_every=2)
    batches = [[("a", 1), ("b", 1)], [("a", 2)], [("c", 3)], [("a", 4), ("c", 4)]]
    frames = [spark.createDataFrame(b, "k string, n int") for b in batches]
    for number in (0, 1, 1, 2, 2, 3, 3):
        sink(frames[number], number)
    assert as_set(keyed.read_keyed_table(spark, path, ["k"], ["n"])) == {("a", 4), ("b", 1), ("c", 4)}
    assert {r.batch_id for r in keyed.snapshots(spark, path).collect()} == {-1, 3}
    assert keyed.active_folder(spark, path).endswith(".folded-000000000003")


def test_versions_of_a_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    spark.sql("CREATE TABLE kept.tasks (id BIGINT, name STRING, day STRING) USING parquet PARTITIONED BY (day)")
    spark.sql("INSERT INTO kept.tasks VALUES (1, 'a', '2026-01-01')")
    first, second = datetime(2026, 1, 1), datetime(2026, 2, 1)
    assert [catalog.record_version(spark, "kept.tasks", m) for m in (first, first, second)] == [1, 1, 1]
    spark.sql("ALTER TABLE kept.tasks ADD COLUMNS (owner STRING)")
    assert catalog.record_version(spark, "kept.tasks", second) == 2
    assert as_set(catalog.table_versions(spark, "kept.tasks")) == {(1, first, "id bigint, name string, day string"), (2, second, "id bigint, name string, owner string, day string")}
    assert as_set(catalog.version_changes(spark, "kept.tasks")) == {(2, "owner", "added", None, "string")}
    moments = (datetime(2025, 1, 1), first, datetime(2026, 1, 15), second, datetime(2027, 1, 1))
    assert [catalog.version_as_of(spark, "kept.tasks", m) for m in moments] == [None, 1, 1, 2, 2]
    assert catalog.read_version(spark, "kept.tasks", 1).columns == ["id", "name", "day"]
    assert tuple(catalog.read_version(spark, "kept.tasks", 2).first()) == (1, "a", None, "2026-01-01")
    with pytest.raises(ValueError, match="no version 3"):
        catalog.read_version(spark, "kept.tasks", 3)
