"""Metric samples and labelled time series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.time import time_literal
from tidemill.operators.ordering import HeavyKeys, as_of_join, with_previous
from tidemill.session import materialize

# The value a dashboard's "all" selection and interval macro stand for.
ALL_VALUE = ".+"
RATE_INTERVAL = "1m"

_STATISTICS = {
    # on decimals the sum is exact, so the order of rows cannot show
    "Average": lambda c: F.sum(c).cast("double") / F.count(c),
    "Sum": F.sum,
    "Minimum": F.min,
    "Maximum": F.max,
    "SampleCount": F.count,
}


def metric_statistics(
    samples: DataFrame,
    by: Sequence[str],
    start: datetime,
    end: datetime,
    period_seconds: int = 300,
    statistics: Sequence[str] = ("Average",),
    time: str = "ts",
    value: str = "value",
) -> DataFrame:
    """One row per metric and period that holds samples, sorted by time."""
    like = samples.schema[time].dataType.simpleString()
    scoped = samples.filter((F.col(time) >= time_literal(start, like)) & (F.col(time) < time_literal(end, like)))
    bucket = F.window(F.col(time), f"{period_seconds} seconds")
    grouped = scoped.groupBy(*by, bucket.alias("_bucket"))
    result = grouped.agg(*[_STATISTICS[s](value).alias(s) for s in statistics])
    return result.select(F.col("_bucket.start").alias("timestamp"), *by, *statistics).orderBy("timestamp", *by)


def metric_catalog(samples: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct metrics; grouping, because ``distinct`` refuses map columns."""
    return samples.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).drop("_n")


def label_match(
    df: DataFrame, labels: Mapping[str, tuple[str, str]], variables: Mapping[str, str] | None = None
) -> DataFrame:
    """Keep rows whose labels match: ``{column: ("=", text) | ("=~", regex)}``.

    ``$name`` in a pattern is replaced from ``variables`` (``.+`` where it is not
    bound); regexes are anchored at both ends.
    """
    bound = dict(variables or {})
    for column, (op, pattern) in labels.items():
        if pattern.startswith("$"):
            pattern = bound.get(pattern[1:], ALL_VALUE)
        if op == "=":
            df = df.filter(F.col(column) == pattern)
        elif op == "=~":
            df = df.filter(F.col(column).rlike(f"^(?:{pattern})$"))
        else:
            raise ValueError(f"label operators are = and =~, not {op!r}")
    return df


def label_values(df: DataFrame, label: Column, name: str) -> DataFrame:
    return df.select(label.alias(name)).distinct()


def instant_vector(
    samples: DataFrame,
    series: Sequence[str],
    at: datetime,
    look_back: timedelta = timedelta(minutes=5),
    time: str = "ts",
    value: str = "value",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The latest sample of each series in ``(at - look_back, at]``."""
    like = samples.schema[time].dataType.simpleString()
    window = samples.filter(
        (F.col(time) > time_literal(at - look_back, like)) & (F.col(time) <= time_literal(at, like))
    )
    order = F.struct(time, *tiebreak)
    return window.groupBy(*series).agg(F.max_by(F.col(value), order).alias(value))


def aggregate_vector(vector: DataFrame, by: Sequence[str], how: str, value: str = "value") -> DataFrame:
    """``sum by`` or ``max by`` over an instant vector."""
    chosen = {"sum": F.sum, "max": F.max}[how]
    return vector.groupBy(*by).agg(chosen(value).alias(value))


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    window_seconds: int,
    time: str = "ts",
    value: str = "value",
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Per-second rate of a counter at each sample, over the window that ends there.

    The rate is the sum of the increases between the window's samples, a fall
    counting as a reset to zero, over the time between its first and last sample.
    One sample gives NULL.  There is no extrapolation to the window's edges.

    ``(series, time)`` is unique.  The work is linear however dense the samples are: increases are summed once
    from the series' start, and a marker at the start of every window picks up the first sample at or
    after it in one backward sweep.  A ``heavy`` series does the same slice by slice.
    """
    if heavy is not None and heavy.hashes:
        is_heavy = heavy.covers(series)
        light = counter_rate(samples.filter(~is_heavy), series, window_seconds, time, value)
        return light.unionByName(_sliced_rate(samples.filter(is_heavy), series, window_seconds, time, value, heavy))
    stamp = F.unix_micros(F.col(time).cast("timestamp"))
    reach = F.lit(window_seconds * 1_000_000)
    placed = samples.select(
        *series, stamp.alias("_at"), F.col(value).alias("_value"), F.struct(*samples.columns).alias("_row")
    )
    forward = Window.partitionBy(*series).orderBy("_at")
    before = F.lag("_value").over(forward)
    rise = F.when(F.col("_value") < before, F.col("_value")).otherwise(F.col("_value") - before)
    so_far = forward.rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("_rise", F.coalesce(rise, F.col("_value") - F.col("_value"))).withColumn(
        "_sum", F.sum("_rise").over(so_far)
    )
    point = F.struct(F.col("_at").alias("at"), F.col("_sum").alias("sum"))
    sample = F.struct(F.col("_at").alias("time"), point.alias("point"), F.lit(None).cast(samples.schema).alias("row"))
    marker = F.struct((F.col("_at") - reach).alias("time"), F.lit(None).cast("void").alias("point"), F.col("_row").alias("row"))
    merged = summed.select(*series, point.alias("_own"), F.explode(F.array(sample, marker)).alias("_m")).select(
        *series, "_own", "_m.*"
    )
    # backwards, a sample comes ahead of a marker of the same time
    backward = (
        Window.partitionBy(*series)
        .orderBy(F.col("time").desc(), F.col("row").isNotNull())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    started = merged.withColumn("_first", F.last("point", ignorenulls=True).over(backward)).filter("row IS NOT NULL")
    elapsed = (F.col("_own.at") - F.col("_first.at")) / F.lit(1_000_000)
    rate = (F.col("_own.sum") - F.col("_first.sum")).cast("double") / elapsed
    return started.select(
        *[F.col("row")[c].alias(c) for c in samples.columns], F.when(elapsed > 0, rate).alias("rate")
    )


def _sliced_rate(
    samples: DataFrame, series: Sequence[str], window_seconds: int, time: str, value: str, heavy: HeavyKeys
) -> DataFrame:
    """The rate of heavy series: no step holds more than a slice of one.

    The increase over the previous sample, a running sum within the slice on top of the earlier slices' totals, and
    the first sample of the window as an as-of match along the reversed time.
    """
    row = F.struct(*samples.columns).alias("_row")
    slots = samples.select(*series, F.unix_micros(F.col(time).cast("timestamp")).alias("_at"), F.col(value).alias("_value"), row)
    cut = heavy.slice(series, F.timestamp_micros("_at"))
    paired = with_previous(slots, series, ["_at"], ["_value"], cut, name="_before")
    before = F.col("_before._value")
    rise = F.when(F.col("_value") < before, F.col("_value")).otherwise(F.col("_value") - before)
    risen = paired.select(*series, "_at", "_row", F.coalesce(rise, F.col("_value") - F.col("_value")).alias("_rise"))
    # written down: three steps read it, and the slices of a series are many
    risen = materialize(risen.withColumn("_slice", cut))
    totals = risen.groupBy(*series, "_slice").agg(F.sum("_rise").alias("_total"))
    earlier = Window.partitionBy(*series).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn("_carried", F.sum("_total").over(earlier)).drop("_total")
    so_far = Window.partitionBy(*series, "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = risen.withColumn("_sum", F.sum("_rise").over(so_far)).alias("a").join(
        carried.alias("b"), reduce(Column.__and__, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*series, "_slice"]])
    )
    total = F.col("_sum") + F.coalesce("_carried", F.col("_sum") - F.col("_sum"))
    points = summed.select(*[F.col(f"a.{c}").alias(c) for c in series], "_at", "_row", total.alias("_sum"))
    back = lambda c: -heavy.slice(series, F.timestamp_micros(-c))
    versions = points.select(*series, (-F.col("_at")).alias("_then"), F.struct("_at", "_sum").alias("_point"))
    facts = points.withColumn("_now", F.lit(window_seconds * 1_000_000) - F.col("_at"))
    matched = as_of_join(facts, versions, series, "_now", "_then", back, name="_first")
    elapsed = (F.col("_at") - F.col("_first._point._at")) / F.lit(1_000_000)
    rate = (F.col("_sum") - F.col("_first._point._sum")).cast("double") / elapsed
    return matched.select(*[F.col("_row")[c].alias(c) for c in samples.columns], F.when(elapsed > 0, rate).alias("rate"))


def last_not_null(
    samples: DataFrame, series: Sequence[str], time: str = "ts", value: str = "value", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Each series reduced to its last value that is not NULL; NULL when it has none."""
    order = F.when(F.col(value).isNotNull(), F.struct(time, *tiebreak))
    return samples.groupBy(*series).agg(F.max_by(F.col(value), order).alias(value))


def state_changes(
    history: DataFrame, entity: Sequence[str], order: Sequence[str], state: str, slice_by: Column
) -> DataFrame:
    """Rows whose state differs from the entity's previous one; the first row always counts."""
    compared = with_previous(history, entity, order, [state], slice_by)
    changed = F.col("previous").isNull() | ~F.col(state).eqNullSafe(F.col(f"previous.{state}"))
    return compared.filter(changed).withColumn("previous_state", F.col(f"previous.{state}")).drop("previous")
