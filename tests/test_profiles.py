"""Stored profiles: merged equals one pass, and only what changed is read again."""

from __future__ import annotations

import random
import shutil
from pathlib import Path

import pytest
from helpers import as_set, lines_of, task_sum
from pyspark.sql import functions as F

from tidemill.operators import checks, profiles

KINDS = "n int, x double, d decimal(9,2), day date, at timestamp, word string, flag boolean, never string, y int, z string"
COLUMNS = ["n", "x", "d", "day", "at", "word", "flag", "never"]
BY = ["y", "z"]
EXACT = ["column", "rows", "nulls", "min_value", "max_value", "avg_length", "max_length"]


def table(spark, rows: int, years, seed: int = 0):
    draw = random.Random(seed)
    base = spark.range(rows).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 500).cast("int").alias("n"), F.when(F.col("id") % 5 > 0, (F.col("id") % 300) / 8 - 10).alias("x"),
        (F.col("id") % 90 / 4).cast("decimal(9,2)").alias("d"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 400).cast("int")).alias("day"),
        F.timestamp_seconds(F.col("id") * 61).alias("at"), F.concat(F.lit("w"), F.col("id") % 1000).alias("word"), (F.col("id") % 3 == 0).alias("flag"),
        F.lit(None).cast("string").alias("never"), F.element_at(F.array(*[F.lit(y) for y in years]), (F.col("id") % len(years) + 1).cast("int")).alias("y"),
        F.when(F.col("id") % 4 > 0, F.lit(draw.choice(["a b", "a/b"]))).alias("z"),
    )
    return base


def add(df, path: str) -> None:
    df.write.mode("append").partitionBy(*BY).parquet(path)


def exact(df) -> set:
    return as_set(df.select(*EXACT))


def test_merged_states_equal_one_pass(spark, tmp_path):
    path, states = str(tmp_path / "t"), str(tmp_path / "s")
    add(table(spark, 6_000, [1, 2, None]), path)
    assert profiles.refresh_profiles(spark, path, states, COLUMNS, BY) == 6
    stored = profiles.stored_profiles(spark, path, states, COLUMNS, BY)
    merged, wanted = profiles.merge_profiles(stored), checks.column_statistics(spark.read.parquet(path), COLUMNS)
    assert exact(merged) == exact(wanted)
    distinct = {r.column: r.distinct_values for r in wanted.collect()}
    for row in merged.collect():
        assert abs(row.distinct_values - distinct[row.column]) <= 0.06 * distinct[row.column]
        assert (row.quantiles is None) == (row.column in ("word", "flag", "never"))
    cuts = {r.column: r.quantiles for r in merged.collect()}
    for place, share in enumerate(profiles.QUANTILES):
        assert abs(spark.read.parquet(path).filter(F.col("n") <= int(cuts["n"][place])).count() / (6_000 - distinct_nulls(spark, path, "n")) - share) < 0.04
        assert cuts["day"][place][:2] == "20" and cuts["at"][place][:4] == "1970"


def distinct_nulls(spark, path: str, column: str) -> int:
    return spark.read.parquet(path).filter(F.col(column).isNull()).count()


def test_groups_of_states(spark, tmp_path):
    path, states = str(tmp_path / "t"), str(tmp_path / "s")
    add(table(spark, 900, [1, 2, None]), path)
    profiles.refresh_profiles(spark, path, states, ["n", "word"], BY)
    years = profiles.merge_profiles(profiles.stored_profiles(spark, path, states, ["n", "word"], BY), ["y"])
    rows = spark.read.parquet(path)
    for year in (1, 2, None):
        part = F.col("y").eqNullSafe(F.lit(year))
        assert exact(years.filter(part)) == exact(checks.column_statistics(rows.filter(part), ["n", "word"]))


def test_only_changed_partitions_are_read(spark, tmp_path):
    events = spark.conf.get("spark.eventLog.dir").removeprefix("file:")
    path, states = str(tmp_path / "t"), str(tmp_path / "s")

    def refresh() -> tuple[int, int]:
        begun = lines_of(events)
        n = profiles.refresh_profiles(spark, path, states, COLUMNS, BY)
        return n, task_sum(events, begun, "Input Metrics", "Records Read")

    def holds() -> bool:
        merged = profiles.merge_profiles(profiles.stored_profiles(spark, path, states, COLUMNS, BY))
        return exact(merged) == exact(checks.column_statistics(spark.read.parquet(path), COLUMNS))

    add(table(spark, 20_000, [1, 2]), path)
    assert refresh()[0] == 3 and holds()
    n, read = refresh()
    assert n == 0 and read < 200
    add(table(spark, 400, [3]), path)  # new partitions
    n, read = refresh()
    assert n == 2 and 400 <= read < 800 and holds()
    add(table(spark, 10, [3], 1).filter("z IS NULL"), path)  # a partition gets a file
    n, read = refresh()
    assert n == 1 and read < 500 and holds()
    shutil.rmtree(Path(path) / "y=1")  # partitions go
    assert refresh()[0] == 0 and holds()


def test_runs_done_twice_and_lost(spark, tmp_path):
    path, states = str(tmp_path / "t"), str(tmp_path / "s")
    add(table(spark, 300, [1]), path)
    folder = profiles._state_folder(spark, path, states, ["n"], BY)
    Path(folder).mkdir(parents=True)  # what a lost first run may leave
    assert profiles.merge_profiles(profiles.stored_profiles(spark, path, states, ["n"], BY)).first().rows == 0
    assert profiles.refresh_profiles(spark, path, states, ["n"], BY) == 2
    again = [tuple(r) for r in spark.read.parquet(folder).collect()]
    spark.createDataFrame(again, spark.read.parquet(folder).schema).write.mode("append").parquet(folder)  # two runs at once
    assert profiles.merge_profiles(profiles.stored_profiles(spark, path, states, ["n"], BY)).first().rows == 300
    assert profiles.refresh_profiles(spark, path, states, ["n", "word"], BY) == 2  # other columns


def test_no_states_and_refused_columns(spark, tmp_path):
    rows = table(spark, 10, [1])
    empty = profiles.profile_states(rows.limit(0), COLUMNS, BY)
    assert empty.count() == 0
    merged = profiles.merge_profiles(empty).collect()
    assert [r.column for r in merged] == COLUMNS and all((r.rows, r.nulls, r.distinct_values, r.avg_length, r.quantiles) == (0, 0, 0, None, None) for r in merged)
    with pytest.raises(ValueError, match="tags"):
        profiles.profile_states(rows.withColumn("tags", F.array("word")), ["n", "tags"], BY)
    with pytest.raises(ValueError):
        profiles.profile_states(rows, [], BY)


def test_names_that_clash(spark):
    rows = spark.createDataFrame([(1, 2, 3, "u"), (1, None, 4, "v")], "rows int, partition int, columns int, `a.b` string")
    merged = profiles.merge_profiles(profiles.profile_states(rows, ["partition", "columns", "a.b"], ["rows"]), ["rows"])
    assert as_set(merged.select("column", "nulls", "min_value", "max_value")) == {("partition", 1, "2", "2"), ("columns", 0, "3", "4"), ("a.b", 0, "u", "v")}
