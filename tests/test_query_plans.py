"""What the optimizer is expected to do with the queries."""

import io
from contextlib import redirect_stdout

import pytest
from helpers import SMALL
from pyspark.sql import functions as F

from tidemill.operators import checks, ordering, series
from tidemill.plans import QUERIES


def plan(spark, name: str) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        QUERIES[name](spark, SMALL).explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("chart_aggregate", "GreaterThanOrEqual(o_orderdate"), ("big_number", "EqualTo(o_orderstatus,F)"),
        ("time_range", "GreaterThanOrEqual(ts"), ("since", "GreaterThanOrEqual(ts"), ("updated_since", "GreaterThan(ts"),
        ("cursor_page", "LessThanOrEqual(ts"), ("follow_cursor", "GreaterThanOrEqual(ts"), ("state_filter", "In(event_type"),
        ("name_prefix", "StringStartsWith(event_type,s)"), ("metric_statistics", "GreaterThanOrEqual(ts"),
        ("instant_vector", "LessThanOrEqual(ts"), ("first_exposure", "EqualTo(event_type,view)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    text = plan(spark, name)
    assert pushed in text.split("PushedFilters:", 1)[1].split("\n", 1)[0]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("chart_aggregate", {"o_orderpriority", "o_totalprice", "o_orderdate"}), ("count_by", {"event_type"}),
        ("distinct_values", {"o_orderpriority"}), ("latest_per_key", {"event_id", "ts", "user_id", "event_type", "value"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, columns):
    schema = plan(spark, name).split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
    assert {part.split(":")[0] for part in schema.split(",")} <= columns


def test_no_query_multiplies_rows_blindly(spark):
    for name in ("prefix_overlap", "temporal_join", "interval_join", "contains_rows", "exposure_join", "rows_equal"):
        text = plan(spark, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_ordered_limits_are_top_k(spark):
    for name in ("order_by_metric", "stream_events", "cursor_page", "run_order"):
        assert "TakeOrderedAndProject" in plan(spark, name), name


def test_one_shuffle_where_one_is_enough(spark):
    for name in ("count_by", "latest_per_key", "first_exposure", "instant_vector", "distinct_values", "metric_catalog"):
        tree = plan(spark, name).split("\n\n", 1)[0]
        assert tree.count("Exchange") == 1, name


def test_groups_are_reduced_before_the_shuffle(spark):
    for name in ("chart_aggregate", "latest_per_key", "same_multiset", "prefix_rollup", "level_listing"):
        tree = plan(spark, name).split("\n\n", 1)[0]
        lines = [i for i, line in enumerate(tree.splitlines()) if "Exchange" in line]
        assert any("Aggregate" in line for line in tree.splitlines()[lines[-1] + 1:]), name


def test_top_n_ranks_within_salts_first(spark):
    tree = plan(spark, "newest_n_per_stream").split("\n\n", 1)[0]
    assert tree.count("Window (") + tree.count("Window\n") >= 2 and "WindowGroupLimit" in tree


def test_cut_keys_shuffle_by_slice(spark):
    for name in ("state_changes", "to_changelog", "temporal_join"):
        text = plan(spark, name)
        keyed = [line for line in text.splitlines() if "hashpartitioning" in line]
        assert any("_slice" in line for line in keyed), name


def test_heavy_series_shuffle_by_slice(spark):
    rows = [("a", i, i) for i in range(40)] + [("b", 1, 1)]
    samples = spark.createDataFrame(rows, "k string, sec int, value int").withColumn("ts", F.timestamp_seconds("sec"))
    heavy = ordering.heavy_keys(samples, ["k"], "ts", rows=10)
    assert len(heavy.hashes) == 1
    text = series.counter_rate(samples, ["k"], 5, heavy=heavy)._jdf.queryExecution().toString()
    assert any("_slice" in line for line in text.splitlines() if "hashpartitioning" in line)


def test_two_scans_for_any_number_of_columns(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    found = checks.column_statistics(orders, ["o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority"])
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    sketch = checks.column_statistics(orders, ["o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority"], approximate=True)
    assert sketch._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
