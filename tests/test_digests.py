"""Tables compared by digests of ranges: the same violations, little moved."""

from __future__ import annotations

import random

import pytest
from helpers import as_set, lines_of, task_sum
from pyspark.sql import functions as F

from tidemill.operators import checks, rows


def moved(spark, work) -> int:
    events = spark.conf.get("spark.eventLog.dir").removeprefix("file:")
    begun = lines_of(events)
    work()
    return task_sum(events, begun, "Shuffle Write Metrics", "Shuffle Records Written")


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_the_same_differences(spark, monkeypatch, levels):
    draw = random.Random(levels)
    kinds = "a int, b string, c double"
    left = [(draw.randrange(40), draw.choice(["x", "y", None, ""]), draw.choice([1.5, None, -0.25])) for _ in range(400)]
    right = left[:380] + [(99, "x", 1.5)] + left[:7]
    draw.shuffle(right)
    a, b = spark.createDataFrame(left, kinds), spark.createDataFrame(right, kinds).select("c", "a", "b")
    wanted = as_set(checks.same_multiset(a, b))
    assert wanted and as_set(rows.multiset_diff_by_digests(a, b, levels)) == wanted
    monkeypatch.setattr(rows, "MOST_RANGES", 2)  # too many ranges: all of the level above
    assert as_set(rows.multiset_diff_by_digests(a, b, levels)) == wanted
    assert rows.multiset_diff_by_digests(a, a.repartition(3), levels).count() == 0
    assert as_set(rows.multiset_diff_by_digests(a.limit(0), b)) == as_set(checks.same_multiset(a.limit(0), b))


def test_equal_tables_exchange_digests(spark):
    left = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    right = left.repartition(5).cache()
    right.count()
    plain = moved(spark, lambda: checks.same_multiset(left, right).count())
    assert plain >= 60_000
    assert moved(spark, lambda: checks.same_multiset_by_digests(left, right).count()) < 40_000
    other = right.withColumn("text", F.when(F.col("id") == 4711, "changed").otherwise(F.col("text")))
    found = {}
    told = moved(spark, lambda: found.update(rows=as_set(checks.same_multiset_by_digests(left, other))))
    assert {r[0] for r in found["rows"]} == {4711} and len(found["rows"]) == 2 and told < 45_000
    assert as_set(checks.content_equal(left, other, "id", "text", by_ranges=True)) == as_set(checks.content_equal(left, other, "id", "text"))
    assert checks.content_equal(left, right, "id", "text", by_ranges=True).count() == 0
