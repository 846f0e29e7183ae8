"""The population fixture and its published totals."""

import json
from decimal import Decimal

import pytest

from tidemill.operators import charts

SUM = {"aggregate": "SUM", "column": {"column_name": "population_millions"}, "label": "SUM(population_millions)"}
# fixed values: the published totals below depend on them
POPULATION = [
    ("East Asia & Pacific", "China", 1296, 1371), ("East Asia & Pacific", "Japan", 120, 120),
    ("South Asia", "India", 1120, 1320), ("South Asia", "Pakistan", 140, 160),
    ("Sub-Saharan Africa", "Nigeria", 130, 180), ("Sub-Saharan Africa", "Ethiopia", 65, 95),
    ("Europe & Central Asia", "Germany", 82, 82), ("Europe & Central Asia", "Turkey", 60, 65),
]


@pytest.fixture(scope="module")
def population(spark):
    rows = [(y, r, c, n) for r, c, a, b in POPULATION for y, n in ((2004, a), (2014, b))]
    return spark.createDataFrame(rows, "year int, region string, country string, population_millions int")


def test_big_number(population):
    spec = {"filters": [{"col": "year", "op": "==", "val": 2014}]}
    assert charts.big_number(population, SUM, spec).first()[0] == 3393


def test_regions_in_descending_order(population):
    context = {
        "queries": [
            {
                "filters": [{"col": "year", "op": "==", "val": 2014}], "extras": {"where": "", "having": ""},
                "columns": ["region"], "metrics": [SUM], "orderby": [[SUM, False]], "row_limit": 10000, "series_limit": 0,
            }
        ]
    }
    rows = [tuple(r) for r in charts.chart_from_context(population, json.dumps(context)).collect()]
    assert rows == [
        ("East Asia & Pacific", 1491), ("South Asia", 1480), ("Sub-Saharan Africa", 275), ("Europe & Central Asia", 147),
    ]


def test_trend(population):
    spec = {"columns": ["year"], "metrics": [SUM], "orderby": [["year", True]]}
    assert [tuple(r) for r in charts.chart_aggregate(population, spec).collect()] == [(2004, 3013), (2014, 3393)]


def test_top_series_is_whole(population):
    spec = {"columns": ["year", "country"], "series_columns": ["country"], "series_limit": 2, "metrics": [SUM]}
    rows = {tuple(r) for r in charts.chart_aggregate(population, spec).collect()}
    assert rows == {(2004, "China", 1296), (2014, "China", 1371), (2004, "India", 1120), (2014, "India", 1320)}


def test_unknown_names_are_refused(population):
    with pytest.raises(ValueError):
        charts.filter_column({"col": "year", "op": "~", "val": 1})
    with pytest.raises(ValueError):
        charts.metric_column({"aggregate": "MEDIAN", "column": {"column_name": "year"}})


def test_exact_decimals_survive(spark):
    rows = spark.createDataFrame([(Decimal("73.4"),), (Decimal("75.8"),)], "life decimal(4,1)")
    metric = {"aggregate": "SUM", "column": {"column_name": "life"}, "label": "s"}
    assert charts.big_number(rows, metric).first()[0] == Decimal("149.2")
