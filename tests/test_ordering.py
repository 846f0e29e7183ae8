"""Order-dependent operators against brute force, on keys where one owns most rows."""

import random

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tidemill.operators import keyed, ordering, series, skew
from tidemill.streaming import windows


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    keys = ["hot"] * 200 + [f"k{i % 23}" for i in range(200)] + [None] * 40
    times = rng.sample(range(5000), len(keys))
    return [(k, t, i, rng.choice("abc")) for i, (k, t) in enumerate(zip(keys, times))]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t int, id int, s string")


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("partitions", [1, 8])
@pytest.mark.parametrize("width", [3, 250, 100_000])
def test_previous_across_slices(spark, frame, rows, partitions, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = as_set(
            ordering.with_previous(frame, ["k"], ["t", "id"], ["s"], F.floor(F.col("t") / width)).select("id", "previous.s")
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {(b[2], a[3] if a else None) for g in by_key(rows).values() for a, b in zip([None, *g], g)}
    assert got == want


def test_only_heavy_keys_are_cut(spark, frame, rows):
    timed = frame.withColumn("ts", F.timestamp_seconds("t"))
    heavy = ordering.heavy_keys(timed, ["k"], "ts", rows=25)
    names = {r.k for r in timed.filter(heavy.covers(["k"])).collect()}
    assert names == {"hot", None} and all(cuts for _, cuts in heavy.cuts)
    assert len(ordering.heavy_keys(timed, ["k"], "ts", rows=25, at_most=1).hashes) == 1
    assert ordering.heavy_keys(timed, ["k"], "ts", rows=10**6) == ordering.HeavyKeys()
    got = as_set(
        ordering.with_previous(timed, ["k"], ["t", "id"], ["s"], heavy.slice(["k"], F.col("ts"))).select("id", "previous.s")
    )
    assert got == {(b[2], a[3] if a else None) for g in by_key(rows).values() for a, b in zip([None, *g], g)}


def test_a_burst_is_cut_where_its_rows_are(spark):
    """A key with 99 of 100 rows in one minute of ten years, others beside it."""
    rng = random.Random(8)
    burst = [("hot", 150_000_000 + rng.random() * 60, i) for i in range(990)] + [("hot", rng.random() * 315_000_000, 990 + i) for i in range(10)]
    rows = burst + [(f"k{i % 7}", rng.random() * 315_000_000, 2000 + i) for i in range(70)]
    frame = spark.createDataFrame(rows, "k string, sec double, id int").withColumn("ts", F.timestamp_micros((F.col("sec") * 1_000_000).cast("long")))
    heavy = ordering.heavy_keys(frame, ["k"], "ts", rows=100)
    sizes = [r["count"] for r in frame.filter(heavy.covers(["k"])).groupBy(heavy.slice(["k"], F.col("ts"))).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200
    paired = ordering.with_previous(frame, ["k"], ["ts", "id"], ["id"], heavy.slice(["k"], F.col("ts")))
    got = {(r.id, r.previous.id if r.previous else None) for r in paired.select("id", "previous").collect()}
    ordered = {}
    for k, sec, i in sorted(rows, key=lambda r: (r[0], int(r[1] * 1_000_000), r[2])):
        ordered.setdefault(k, []).append(i)
    assert got == {(b, a) for ids in ordered.values() for a, b in zip([None, *ids], ids)}
    samples = frame.withColumn("value", F.col("id") % 13)
    plain = {r.id: r.rate for r in series.counter_rate(samples, ["k"], 30).collect()}
    cut = {r.id: r.rate for r in series.counter_rate(samples, ["k"], 30, heavy=heavy).collect()}
    assert cut.keys() == plain.keys()
    for i, rate in plain.items():
        assert (rate is None) == (cut[i] is None) and (rate is None or cut[i] == pytest.approx(rate))


@pytest.mark.parametrize("gap", [5, 40, 400])
def test_sessions_of_heavy_keys(spark, frame, gap):
    timed = frame.withColumn("ts", F.timestamp_seconds(F.col("t") - F.col("t") % 5))
    metrics = {"n": F.count(F.lit(1)), "ids": F.sum("id")}
    plain = windows.session_windows(timed.filter("k IS NOT NULL"), "ts", gap, metrics, ["k"])
    heavy = ordering.heavy_keys(timed, ["k"], "ts", rows=15)
    assert len(heavy.hashes) >= 2
    cut = windows.session_windows(timed.filter("k IS NOT NULL"), "ts", gap, metrics, ["k"], heavy=heavy)
    assert as_set(cut) == as_set(plain)


def test_number_rows_is_dense(frame, rows):
    got = [tuple(r) for r in ordering.number_rows(frame, ["s", "id"]).select("position", "id").collect()]
    want = [(i, r[2]) for i, r in enumerate(sorted(rows, key=lambda r: (r[3], r[2])), 1)]
    assert sorted(got) == want


def test_number_rows_descending(frame, rows):
    got = as_set(ordering.number_rows(frame, [F.col("t").desc()]).select("position", "t"))
    assert got == {(i, t) for i, t in enumerate(sorted((r[1] for r in rows), reverse=True), 1)}


def test_latest_and_first(frame, rows):
    groups = by_key(rows)
    assert as_set(ordering.latest_per_key(frame, ["k"], ["t", "id"])) == {g[-1] for g in groups.values()}
    assert as_set(ordering.first_per_key(frame, ["k"], ["t", "id"])) == {g[0] for g in groups.values()}


@pytest.mark.parametrize("salts", [1, 5, 64])
def test_top_n(frame, rows, salts):
    got = ordering.top_n_per_group(frame, ["k"], [F.col("t").desc()], 7, ["id"], salts)
    want = {(g[-i][2], i) for g in by_key(rows).values() for i in range(1, min(7, len(g)) + 1)}
    assert as_set(got.select("id", "rank")) == want


@pytest.mark.parametrize("width", [10, 700])
def test_as_of(spark, frame, rows, width):
    rng = random.Random(3)
    versions = [(k, t, n) for n, (k, t) in enumerate((rng.choice(["hot", "k1", "k2"]), rng.randrange(5000)) for _ in range(60))]
    right = spark.createDataFrame(versions, "k string, vt int, n int")
    got = as_set(
        ordering.as_of_join(frame, right, ["k"], "t", "vt", lambda c: F.floor(c / width), ["n"]).select("id", "version.n")
    )

    def match(row):
        known = [(vt, n) for k, vt, n in versions if k == row[0] and vt <= row[1]]
        return max(known)[1] if known else None

    want = {(r[2], match(r)) for r in rows}
    assert got == want
    timed = frame.withColumn("ts", F.timestamp_seconds("t"))
    heavy = ordering.heavy_keys(timed, ["k"], "ts", rows=25)
    cut = ordering.as_of_join(frame, right, ["k"], "t", "vt", lambda c: heavy.slice(["k"], F.timestamp_seconds(c)), ["n"])
    assert as_set(cut.select("id", "version.n")) == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, frame, how):
    names = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "k string, n int")
    hot = [r[0] for r in spark.createDataFrame([("hot",), ("k9",)], "k string").select(F.xxhash64("k")).collect()]
    want = sorted(map(str, frame.join(names, "k", how).collect()))
    for found in (None, [], hot):
        assert sorted(map(str, skew.skew_join(frame, names, ["k"], how=how, hot=found).collect())) == want


def test_skew_join_of_different_integer_types(spark):
    left = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k int, name string")
    assert skew.skew_join(left, right, ["k"], ["id"]).count() == 67


def test_hot_keys_are_bounded(frame):
    hashes = dict(map(tuple, frame.select(F.xxhash64("k"), "k").distinct().collect()))
    assert [hashes[h] for h in skew.hot_keys(frame, ["k"], at_most=2)] == ["hot", None]


def test_dimension_join_beyond_the_bound(spark, frame):
    names = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, n int")
    plain = sorted(map(str, frame.join(names, "k", "left").select("id", "n").collect()))
    for bound in (0, 100):
        rows = skew.dimension_join(frame, names, ["k"], max_rows=bound).select("id", "n")
        assert sorted(map(str, rows.collect())) == plain


def test_broadcast_only_when_counted_small(spark, frame):
    assert skew.small_side(frame, max_rows=10) is None
    assert skew.small_side(frame, max_rows=1000) is not None


def brute_rate(samples, window):
    want = {}
    for k, group in by_key(samples).items():
        for i, row in enumerate(group):
            inside = [r for r in group[: i + 1] if r[1] >= row[1] - window]
            rises = [b[3] - a[3] if b[3] >= a[3] else b[3] for a, b in zip(inside, inside[1:])]
            span = row[1] - inside[0][1]
            want[row[2]] = round(sum(rises) / span, 9) if span else None
    return want


@pytest.mark.parametrize("bound", [0, 7, 100])
def test_counter_rate(spark, bound):
    rng = random.Random(5)
    keys = ["hot"] * 150 + ["a", "b"] * 20
    times = rng.sample(range(20_000), len(keys))
    samples = [(k, t, i, rng.randrange(50)) for i, (k, t) in enumerate(zip(keys, times))]
    df = spark.createDataFrame(samples, "k string, sec int, id int, value int").withColumn("ts", F.timestamp_seconds("sec"))
    heavy = ordering.heavy_keys(df, ["k"], "ts", rows=bound) if bound else None
    got = {r.id: r.rate for r in series.counter_rate(df, ["k"], 600, heavy=heavy).collect()}
    want = brute_rate(samples, 600)
    assert got.keys() == want.keys()
    for i, rate in want.items():
        assert (got[i] is None) == (rate is None)
        assert rate is None or got[i] == pytest.approx(rate)


def test_counter_reset_and_single_sample(spark):
    df = spark.createDataFrame([("a", 0, 10), ("a", 30, 16), ("a", 60, 4), ("a", 500, 9)], "k string, sec int, value int")
    rows = series.counter_rate(df.withColumn("ts", F.timestamp_seconds("sec")), ["k"], 60).orderBy("sec").collect()
    assert [r.rate for r in rows] == [None, 6 / 30, 10 / 60, None]


def test_changelog_against_a_walk(spark, frame, rows):
    got = as_set(
        keyed.to_changelog(frame, ["k"], ["t", "id"], ["s"], F.col("s") == "c", F.floor(F.col("t") / 100)).select("id", "op", "s")
    )
    want = set()
    for group in by_key(rows).values():
        held = None
        for _, _, i, s in group:
            if s == "c":
                if held is not None:
                    want.add((i, "-D", held))
                held = None
            elif held is None:
                want.add((i, "+I", s))
                held = s
            elif held != s:
                want |= {(i, "-U", held), (i, "+U", s)}
                held = s
    assert got == want
