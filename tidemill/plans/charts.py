"""Chart queries over orders, line items and customers."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.charts import (
    big_number,
    chart_aggregate,
    chart_from_context,
    distinct_values,
    row_level_rule,
)
from tidemill.plans.registry import Tables, money, query


def _metric(aggregate: str, column: str, label: str) -> dict:
    return {"aggregate": aggregate, "column": {"column_name": column}, "expressionType": "SIMPLE", "label": label}


def _orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("o_totalprice", money("o_totalprice"))


YEAR = {"col": "o_orderdate", "start": datetime(1997, 1, 1), "end": datetime(1998, 1, 1)}
SPEND = _metric("SUM", "o_totalprice", "spend")


@query(
    "chart_aggregate",
    """
    SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    GROUP BY 1 ORDER BY 2 DESC LIMIT 10000
    """,
)
def chart(t: Tables) -> DataFrame:
    spec = {
        "columns": ["o_orderpriority"], "metrics": [SPEND], "time_range": YEAR,
        "orderby": [[SPEND, False]], "row_limit": 10_000,
    }
    return chart_aggregate(_orders(t), spec).withColumn("spend", F.col("spend").cast("double"))


@query(
    "chart_filters",
    """
    SELECT o_orderstatus, o_orderpriority, count(o_orderkey) AS orders,
           count(DISTINCT o_custkey) AS customers, min(o_totalprice) AS least, max(o_totalprice) AS most,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_price
    FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_totalprice >= 1000 AND o_orderpriority NOT IN ('5-LOW')
      AND o_orderpriority LIKE '%-%' AND o_custkey IS NOT NULL AND o_custkey % 7 <> 3
    GROUP BY 1, 2 HAVING count(o_orderkey) > 3 ORDER BY 1, 2 DESC
    """,
)
def filters(t: Tables) -> DataFrame:
    spec = {
        "columns": ["o_orderstatus", "o_orderpriority"],
        "metrics": [
            _metric("COUNT", "o_orderkey", "orders"), _metric("COUNT_DISTINCT", "o_custkey", "customers"),
            _metric("MIN", "price", "least"), _metric("MAX", "price", "most"),
            _metric("AVG", "o_totalprice", "mean_price"),
        ],
        "filters": [
            {"col": "o_orderstatus", "op": "IN", "val": ["F", "O"]},
            {"col": "o_totalprice", "op": ">=", "val": 1000},
            {"col": "o_orderpriority", "op": "NOT IN", "val": ["5-LOW"]},
            {"col": "o_orderpriority", "op": "LIKE", "val": "%-%"},
            {"col": "o_custkey", "op": "IS NOT NULL"},
        ],
        "extras": {"where": "o_custkey % 7 <> 3", "having": "orders > 3"},
        "orderby": [["o_orderstatus", True], ["o_orderpriority", False]],
    }
    return chart_aggregate(_orders(t).withColumn("price", F.col("o_totalprice").cast("double")), spec)


@query(
    "chart_all_groups",
    """
    SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM lineitem GROUP BY 1, 2
    """,
)
def every_group(t: Tables) -> DataFrame:
    """A spec without a row limit gives every group, however many there are."""
    spec = {"columns": ["l_orderkey", "l_linenumber"], "metrics": [_metric("SUM", "price", "price")]}
    items = t.lineitem.select("l_orderkey", "l_linenumber", money("l_extendedprice").alias("price"))
    return chart_aggregate(items, spec).withColumn("price", F.col("price").cast("double"))


@query(
    "big_number",
    """
    SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
    FROM orders WHERE o_orderstatus = 'F'
    """,
)
def total(t: Tables) -> DataFrame:
    spec = {"filters": [{"col": "o_orderstatus", "op": "==", "val": "F"}]}
    return big_number(_orders(t), SPEND, spec).select(F.col("spend").cast("double").alias("spend"))


@query(
    "order_by_metric",
    """
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend, count(*) AS orders
    FROM orders GROUP BY 1 ORDER BY sum(CAST(o_totalprice AS DECIMAL(18,2))) DESC, o_custkey LIMIT 25
    """,
)
def top_customers(t: Tables) -> DataFrame:
    spec = {
        "columns": ["o_custkey"], "metrics": [SPEND, _metric("COUNT", "o_orderkey", "orders")],
        "orderby": [[SPEND, False]], "row_limit": 25,
    }
    return chart_aggregate(_orders(t), spec).withColumn("spend", F.col("spend").cast("double"))


@query(
    "series_limit",
    """
    WITH top AS (
      SELECT nullif(l_suppkey % 7, 3) AS supplier FROM lineitem GROUP BY 1
      ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_suppkey % 7 = 3 THEN 3 ELSE 1 END) DESC, 1 LIMIT 5)
    SELECT year(l_shipdate) AS ship_year, nullif(l_suppkey % 7, 3) AS supplier,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_suppkey % 7 = 3 THEN 3 ELSE 1 END) AS DOUBLE) AS revenue
    FROM lineitem WHERE EXISTS (SELECT 1 FROM top WHERE top.supplier IS NOT DISTINCT FROM nullif(l_suppkey % 7, 3)) GROUP BY 1, 2
    """,
)
def top_series(t: Tables) -> DataFrame:
    """Seven series, of which the greatest has no name."""
    rest = F.col("l_suppkey") % 7
    items = t.lineitem.select(
        F.year("l_shipdate").cast("long").alias("ship_year"), F.nullif(rest, F.lit(3)).alias("supplier"),
        (money("l_extendedprice") * F.when(rest == 3, 3).otherwise(1)).alias("price"),
    )
    spec = {
        "columns": ["ship_year", "supplier"], "series_columns": ["supplier"], "series_limit": 5,
        "metrics": [_metric("SUM", "price", "revenue")], "orderby": [["ship_year", True]],
    }
    return chart_aggregate(items, spec).withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "chart_from_context",
    """
    SELECT n_name, count(DISTINCT c_custkey) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 10
    """,
)
def stored_context(t: Tables) -> DataFrame:
    customers = _metric("COUNT_DISTINCT", "c_custkey", "customers")
    context = json.dumps(
        {
            "datasource": {"id": 1, "type": "table"},
            "queries": [
                {
                    "filters": [{"col": "c_mktsegment", "op": "!=", "val": "HOUSEHOLD"}],
                    "extras": {"having": "", "where": ""}, "columns": ["n_name"], "metrics": [customers],
                    "orderby": [[customers, False]], "row_limit": 10, "series_limit": 0,
                }
            ],
        }
    )
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return chart_from_context(joined, context)


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def priorities(t: Tables) -> DataFrame:
    return distinct_values(t.orders, "o_orderpriority")


@query(
    "row_level_rule",
    """
    SELECT c_mktsegment, count(*) AS customers FROM customer
    WHERE c_acctbal >= 0 AND c_nationkey < 12 GROUP BY 1
    """,
)
def ruled(t: Tables) -> DataFrame:
    rules = {"analyst": F.col("c_acctbal") >= 0, "north": F.col("c_nationkey") < 12, "other": F.lit(False)}
    kept = row_level_rule(t.customer, rules, ["analyst", "north"])
    return kept.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
