"""Chart queries from a declarative spec: filter, group, aggregate, order, limit."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.time import time_literal

_AGGREGATES = {
    "SUM": F.sum,
    "COUNT": F.count,
    "COUNT_DISTINCT": F.count_distinct,
    # on decimals the sum is exact, so the order of rows cannot show
    "AVG": lambda c: F.sum(c).cast("double") / F.count(c),
    "MIN": F.min,
    "MAX": F.max,
}

_COMPARISONS = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "IN": lambda c, v: c.isin(list(v)),
    "NOT IN": lambda c, v: ~c.isin(list(v)),
    "LIKE": lambda c, v: c.like(v),
    "IS NULL": lambda c, v: c.isNull(),
    "IS NOT NULL": lambda c, v: c.isNotNull(),
}


def filter_column(condition: Mapping[str, Any]) -> Column:
    """``{col, op, val}`` as a predicate that the scan can take over."""
    op = str(condition["op"]).upper()
    if op not in _COMPARISONS:
        raise ValueError(f"unknown filter operator {condition['op']!r}")
    return _COMPARISONS[op](F.col(condition["col"]), condition.get("val"))


def metric_label(metric: Mapping[str, Any]) -> str:
    return metric.get("label") or f"{metric['aggregate']}({metric['column']['column_name']})"


def metric_column(metric: Mapping[str, Any]) -> Column:
    """A simple metric: an aggregate over one column, under its label."""
    name = str(metric["aggregate"]).upper()
    if name not in _AGGREGATES:
        raise ValueError(f"unknown aggregate {metric['aggregate']!r}")
    return _AGGREGATES[name](F.col(metric["column"]["column_name"])).alias(metric_label(metric))


def chart_filters(df: DataFrame, query: Mapping[str, Any]) -> DataFrame:
    """Listed filters, the free WHERE text and the time range, all AND-ed."""
    for condition in query.get("filters") or []:
        df = df.filter(filter_column(condition))
    where = (query.get("extras") or {}).get("where")
    if where:
        df = df.filter(F.expr(where))
    bounds = query.get("time_range")
    if bounds:
        column, start, end = bounds["col"], bounds.get("start"), bounds.get("end")
        like = df.schema[column].dataType.simpleString()
        if start is not None:
            df = df.filter(F.col(column) >= time_literal(start, like))
        if end is not None:
            df = df.filter(F.col(column) < time_literal(end, like))
    return df


def _order_column(entry: Sequence[Any]) -> Column:
    key, ascending = entry
    column = F.col(f"`{metric_label(key)}`" if isinstance(key, Mapping) else f"`{key}`")
    return column.asc_nulls_last() if ascending else column.desc_nulls_last()


def chart_aggregate(df: DataFrame, query: Mapping[str, Any]) -> DataFrame:
    """One chart query.

    Grouping pre-aggregates in the map tasks, so a value owning most rows is one
    row per task in the shuffle.  A ``row_limit`` with its order becomes a top-k; without one all groups are given.
    Ties in the requested order are settled by the group columns, for plain rows by all of them.
    """
    columns = list(query.get("columns") or [])
    metrics = [metric_column(m) for m in query.get("metrics") or []]
    scoped = chart_filters(df, query)
    n_series = int(query.get("series_limit") or 0)
    if n_series and columns:
        scoped = keep_top_series(scoped, query.get("series_columns") or columns, query["metrics"][0], n_series)
    if metrics:
        result = scoped.groupBy(*columns).agg(*metrics)
    else:
        result = scoped.select(*columns).distinct() if columns else scoped
    having = (query.get("extras") or {}).get("having")
    if having:
        result = result.filter(F.expr(having))
    order = [_order_column(entry) for entry in query.get("orderby") or []]
    ties = columns if metrics or columns else result.columns
    ordered = result.orderBy(*order, *[F.col(f"`{c}`") for c in ties]) if order or ties else result
    limit = int(query.get("row_limit") or 0)
    return ordered.limit(limit) if limit else ordered


def chart_from_context(df: DataFrame, context: str, index: int = 0) -> DataFrame:
    """The same, from the JSON text of a stored query context."""
    return chart_aggregate(df, json.loads(context)["queries"][index])


def keep_top_series(df: DataFrame, series: Sequence[str], metric: Mapping[str, Any], n: int) -> DataFrame:
    """Rows of the ``n`` series with the greatest total, the NULL series among them if it is one.

    The kept list has at most ``n`` rows; whether it is broadcast is left to Spark.
    """
    total = metric_label(metric)
    ranked = df.groupBy(*series).agg(metric_column(metric)).orderBy(F.col(f"`{total}`").desc(), *series).limit(n)
    kept = ranked.select(*[F.col(f"`{c}`").alias(f"_s{i}") for i, c in enumerate(series)])
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(series)]
    return df.join(kept, reduce(Column.__and__, same), "left_semi")


def big_number(df: DataFrame, metric: Mapping[str, Any], query: Mapping[str, Any] | None = None) -> DataFrame:
    """An ungrouped total."""
    return chart_aggregate(df, {**(query or {}), "columns": [], "metrics": [metric]})


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def row_level_rule(df: DataFrame, rules: Mapping[str, Column], roles: Sequence[str]) -> DataFrame:
    """Every rule registered for one of the roles, AND-ed onto the scan."""
    for role in roles:
        if role in rules:
            df = df.filter(rules[role])
    return df
