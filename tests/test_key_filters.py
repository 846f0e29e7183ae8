"""Keyed tables read by key: right rows, few files, bytes in proportion to the batch."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from helpers import as_set, lines_of, task_sum
from pyspark.sql import functions as F

from tidemill.streaming import keyed, keyfilters

EVENT = "k string, id int, ts timestamp, v int, gone boolean"
ORDER = ["ts", "id"]


def batch(spark, *rows):
    return spark.createDataFrame([(k, i, None, v, g) for k, i, v, g in rows], EVENT).withColumn("ts", F.timestamp_seconds("id"))


def sink_of(tmp_path, **settings):
    state, log = str(tmp_path / "state"), str(tmp_path / "log")
    return state, log, keyed.changelog_sink(state, log, ["k"], ORDER, ["v"], F.col("gone"), F.date_trunc("hour", "ts"), **settings)


def test_change_rows_after_a_fold_start_from_the_latest_image(spark, tmp_path):
    state, log, sink = sink_of(tmp_path, compact_every=1)
    for number, v in enumerate((10, 20, 30)):
        sink(batch(spark, ("x", number, v, False)), number)
    assert as_set(spark.read.parquet(log).select("batch_id", "op", "v")) == {(0, "+I", 10), (1, "-U", 10), (1, "+U", 20), (2, "-U", 20), (2, "+U", 30)}
    assert as_set(keyed.read_keyed_table(spark, state, ["k"], ORDER).select("k", "v")) == {("x", 30)}


def test_a_fold_outside_the_sink_is_followed(spark, tmp_path):
    state, log, sink = sink_of(tmp_path)
    sink(batch(spark, ("x", 0, 1, False)), 0)
    keyed.fold_keyed_table(spark, state, ["k"], ORDER, 0)  # without filters: its files are always opened
    sink(batch(spark, ("x", 1, 2, False)), 1)
    sink(batch(spark, ("x", 2, 3, False)), 2)
    assert as_set(spark.read.parquet(log).filter("batch_id = 2").select("op", "v")) == {("-U", 2), ("+U", 3)}


def test_a_batch_retried_after_its_fold_finds_its_own_past(spark, tmp_path):
    state, log, sink = sink_of(tmp_path, compact_every=2)
    batches = [batch(spark, ("x", 0, 1, False), (None, 1, 5, False)), batch(spark, ("x", 2, 2, False)), batch(spark, ("x", 3, 3, False), (None, 4, 6, False))]
    for number in (0, 1, 1, 2, 2):
        sink(batches[number], number)
    found = as_set(spark.read.parquet(log).select("batch_id", "k", "op", "v"))
    assert found == {
        (0, "x", "+I", 1), (0, None, "+I", 5), (1, "x", "-U", 1), (1, "x", "+U", 2),
        (2, "x", "-U", 2), (2, "x", "+U", 3), (2, None, "-U", 5), (2, None, "+U", 6),
    }


def test_the_state_before_a_batch_is_read_from_the_folder_of_its_time(spark, tmp_path):
    state, _, sink = sink_of(tmp_path, compact_every=2)
    for number in range(5):
        sink(batch(spark, ("x", number, number, False), (f"y{number}", number, 0, False)), number)
    for number in range(1, 5):
        held = keyed.read_keyed_table(spark, state, ["k"], ORDER, before_batch=number)
        assert as_set(held.select("k", "v")) == {("x", number - 1), *((f"y{i}", 0) for i in range(number))}


def test_missing_filters_lose_no_row(spark, tmp_path):
    state, log, sink = sink_of(tmp_path)
    for number in range(3):
        sink(batch(spark, *((f"k{i}", 10 * number + i, number, False) for i in range(5))), number)
    shutil.rmtree(f"{state}.filters/batch_id=1")
    only = spark.createDataFrame([("k3",), ("absent",)], "k string")
    held = keyed.read_keyed_table(spark, state, ["k"], ORDER, only=only)
    assert as_set(held.select("k", "v")) == {("k3", 2)}
    nobody = keyed.read_keyed_table(spark, state, ["k"], ORDER, only=only.limit(0))
    assert nobody.columns == held.columns and nobody.count() == 0


@pytest.fixture()
def many_files(spark):
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_a_batch_reads_in_proportion_to_itself(spark, tmp_path, many_files):
    events = spark.conf.get("spark.eventLog.dir").removeprefix("file:")
    state, log, sink = sink_of(tmp_path, compact_every=2)
    keys = spark.range(60_000).select(F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2(F.col("id").cast("string"), 384)).alias("k"), F.col("id").cast("int").alias("id"))
    rows = keys.select("k", "id", F.timestamp_seconds("id").alias("ts"), F.lit(1).alias("v"), F.lit(False).alias("gone"))
    sink(rows, 0)
    sink(rows.limit(0), 1)  # folds
    folder = keyed.active_folder(spark, state)
    whole = sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))
    filters = sum(p.stat().st_size for p in Path(f"{folder}.filters").rglob("*.parquet"))
    files = spark.read.parquet(folder).inputFiles()
    read = {}
    for n in (1, 10, 60_000):
        few = rows.filter(F.col("id") < n).withColumn("id", F.col("id") + 100_000).withColumn("v", F.lit(2)).cache()
        few.count()
        opened = keyfilters.files_with(folder, files, few, ["k"])
        assert len(opened) <= n and len(files) >= 20
        begun = lines_of(events)
        past = keyed.read_keyed_table(spark, state, ["k"], ORDER, only=few)
        assert past.count() == n
        read[n] = task_sum(events, begun, "Input Metrics", "Bytes Read") - filters
    assert read[1] < 0.12 * whole and read[10] < 0.75 * whole and read[1] < read[10] < read[60_000]
    assert read[60_000] >= 0.8 * whole
