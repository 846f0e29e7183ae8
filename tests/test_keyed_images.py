"""Expiring images: many keys to a group, odd keys among them."""

from __future__ import annotations

import time

import pandas as pd
import pytest
from pyspark.sql import types as T

from tidemill.session import scratch_path
from tidemill.streaming import keyed, runs

SCHEMA = "n bigint, k bigint, v bigint, gone boolean"
BIG = 2**60 + 1


@pytest.fixture()
def rocksdb(spark):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    keyed.use_rocksdb(spark)
    yield
    spark.conf.set(provider, before)


def run(spark, rows, log, progress, **options) -> None:
    path = scratch_path(spark, "rows")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    more(spark, path, log, progress, **options)


def more(spark, path, log, progress, **options) -> None:
    changes = keyed.expiring_changelog(runs.replay(spark, path, SCHEMA), ["k"], ["n"], ["v"], "gone", **options)
    runs.bounded_run(changes, log, progress, idle_batches=False, partitions=2)


def found(spark, log) -> list[tuple]:
    return sorted((tuple(r) for r in spark.read.parquet(log).collect()), key=repr)


def test_images_of_odd_keys_go_from_run_to_run(spark, rocksdb, monkeypatch):
    monkeypatch.setattr(keyed, "KEY_BUCKETS", 1)
    first, second, progress, next_progress = (scratch_path(spark, n) for n in ("log", "log", "progress", "progress"))
    run(spark, [(1, None, BIG, False), (2, None, None, False), (3, BIG, BIG, False), (4, BIG + 1, 1, False), (5, BIG + 1, 1, True), (6, 0, 7, None)], first, progress)
    assert found(spark, first) == sorted([
        (None, "+I", BIG), (None, "-U", BIG), (None, "+U", None), (BIG, "+I", BIG), (BIG + 1, "+I", 1), (BIG + 1, "-D", 1), (0, "+I", 7),
    ], key=repr)
    images = keyed.stored_images(spark, progress)
    assert sorted(map(tuple, images.collect()), key=repr) == sorted([(None, None), (BIG, BIG), (0, 7)], key=repr)
    run(spark, [(7, None, None, False), (8, BIG, BIG + 1, False), (9, 0, None, True), (10, BIG + 1, 2, False)], second, next_progress, initial=images)
    assert found(spark, second) == sorted([(BIG, "-U", BIG), (BIG, "+U", BIG + 1), (0, "-D", 7), (BIG + 1, "+I", 2)], key=repr)


def test_images_of_a_bucket_expire_key_by_key(spark, rocksdb, monkeypatch):
    monkeypatch.setattr(keyed, "KEY_BUCKETS", 1)
    log, progress, path = (scratch_path(spark, n) for n in ("log", "progress", "rows"))
    for part in range(2):
        rows = [(part, None, 5, False), (part, BIG, 5, False), (part, part, 6, False)]
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)
        more(spark, path, log, progress, ttl_seconds=1)
        time.sleep(2)
    assert found(spark, log) == sorted([(None, "+I", 5), (BIG, "+I", 5)] * 2 + [(0, "+I", 6), (1, "+I", 6)], key=repr)


def test_one_group_serves_many_keys():
    whole = T.StructType([T.StructField("k", T.LongType())])
    state: dict = {(2,): (9,)}

    class Held:
        exists, containsKey, getValue = (lambda self: True), (lambda self, k: k in state), (lambda self, k: state[k])
        updateValue, removeKey = (lambda self, k, v: state.update({k: v})), (lambda self, k: state.pop(k))

    images = keyed._ExpiringImages(whole, T.StructType([T.StructField("v", T.LongType())]), ["o0"], None)
    images.last = Held()
    rows = pd.DataFrame({"k0": ["2", "1", None, "1"], "v0": ["9", "4", None, "3"], "o0": [4, 3, 2, 1], "gone": [True, False, False, False]})
    (made,) = images.handleInputRows((0,), iter([rows[:2], rows[2:]]), None)
    shown = [(None if pd.isna(k) else int(k), op, None if pd.isna(v) else int(v)) for k, op, v in made.itertuples(index=False)]
    assert shown == [(1, "+I", 3), (None, "+I", None), (1, "-U", 3), (1, "+U", 4), (2, "-D", 9)]
    assert state == {(1,): (4,), (None,): (None,)}
