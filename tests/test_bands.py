"""Band joins against all pairs, with one key, one minute and one moment that hold much of both sides."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tidemill.operators import bands
from tidemill.streaming import windows

START = datetime(2024, 1, 1)


def sides(spark, seed, n, crowd):
    """A third of either side in a crowd: the same key over a day, in a minute, or at a moment."""
    draw = random.Random(seed)

    def rows():
        made = []
        for i in range(n):
            if i % 3 == 0:
                seconds = {"day": draw.randrange(86_400), "minute": 40_000 + draw.randrange(60), "moment": 40_000}[crowd]
                made.append(("hot", i, START + timedelta(seconds=seconds, microseconds=draw.randrange(1_000_000) if crowd == "minute" else 0)))
            else:
                made.append((draw.choice(["a", "b", "c", "d", None]), i, START + timedelta(seconds=draw.randrange(3 * 86_400)) if draw.random() < 0.95 else None))
        return made

    left, right = rows(), rows()
    return left, right, spark.createDataFrame(left, "k string, l int, lt timestamp"), spark.createDataFrame(right, "k string, r int, rt timestamp")


def pairs(left, right, before, after):
    near = lambda t, u: t is not None and u is not None and -before <= (u - t).total_seconds() <= after
    return {(i, j) for k, i, t in left for q, j, u in right if k is not None and k == q and near(t, u)}


@pytest.fixture()
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    yield 40
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("crowd", ["day", "minute", "moment"])
@pytest.mark.parametrize(("before", "after"), [(600, 1800), (0, 0), (100_000, 0)])
def test_equals_all_pairs(spark, partitions, crowd, before, after):
    left, right, a, b = sides(spark, 3, 450, crowd)
    found = windows.interval_join(a, b, ["k"], "lt", "rt", before, after)
    assert found.columns == ["k", "l", "lt", "r", "rt"]
    rows = [tuple(x) for x in found.select("l", "r").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == pairs(left, right, before, after)


@pytest.mark.parametrize("crowd", ["minute", "moment"])
def test_a_crowd_is_spread(spark, partitions, monkeypatch, crowd):
    _, _, a, b = sides(spark, 5, 3000, crowd)
    seen = {}
    plain = bands._crowds

    def watch(cells, cell, rows):
        found = plain(cells, cell, rows)
        seen.setdefault("sides", []).append((cells, cell, found, rows))
        return found

    monkeypatch.setattr(bands, "_crowds", watch)
    n = windows.interval_join(a, b, ["k"], "lt", "rt", 600, 1800).count()
    assert n >= 1000 * 900
    (ours, cell, parts, rows), (theirs, _, more, most) = seen["sides"]
    cells = theirs.groupBy(*cell).count().withColumn("h", F.xxhash64(*cell)).collect()
    assert max(-(-r["count"] // more.get(r.h, 1)) for r in cells) <= most
    shares = [-(-r["count"] // parts.get(r.h, 1)) for r in ours.groupBy(*cell).count().withColumn("h", F.xxhash64(*cell)).collect()]
    assert max(shares) <= rows
    # no row is repeated more often than its pairs fill parts
    repeated = ours.count()
    assert repeated <= 3 * 3000 + n / rows * 2


def test_a_left_crowd_over_few_rows_is_spread(spark, partitions):
    left = spark.range(2000).select(F.lit("x").alias("k"), F.col("id").alias("l"), F.lit(START).cast("timestamp").alias("lt"))
    right = spark.createDataFrame([("x", 1, START), ("x", 1, START), ("y", 2, START)], "k string, r int, rt timestamp")
    assert windows.interval_join(left, right, ["k"], "lt", "rt", 5, 5).count() == 4000
    assert windows.interval_join(left.limit(0), right, ["k"], "lt", "rt", 5, 5).count() == 0
    assert as_set(windows.interval_join(left.limit(1), right.filter("k = 'y'"), ["k"], "lt", "rt", 5, 5)) == set()
