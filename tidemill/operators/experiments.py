"""Metric sources, metric values and experiment results.

Formulas: Welch's z for means; the delta method for ratios (Deng, Knoblich, Lu,
KDD 2018); CUPED for the pre-period covariate (Deng, Xu, Kohavi, Walker, WSDM
2013); a chi-square statistic for sample-ratio mismatch.

Events are always reduced to one row per unit by a map-side aggregate before
units meet each other, and joins of raw events to units go through ``skew_join``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.stats import chi_square_p, critical_z, two_sided_p
from tidemill.functions.time import time_literal
from tidemill.operators.skew import skew_join, small_side
from tidemill.session import materialize


def canonical_source(
    source: DataFrame,
    timestamp_column: str,
    unit_ids: Mapping[str, str],
    fields: Mapping[str, str] | None = None,
    timestamp_as_day: bool = False,
) -> DataFrame:
    """A source query's rows under canonical names: ``ts``, one column per unit type, then the fields.

    ``unit_ids`` maps unit type to source column and must name at least one;
    ``fields`` maps source column to field name.
    """
    if not unit_ids:
        raise ValueError("a metric source needs at least one unit id")
    wanted = [timestamp_column, *unit_ids.values(), *(fields or {})]
    absent = [c for c in wanted if c not in source.columns]
    if absent:
        raise ValueError(f"the source has no column {', '.join(absent)}")
    moment = F.col(timestamp_column)
    if timestamp_as_day:
        moment = F.date_trunc("day", moment)
    return source.select(
        moment.alias("ts"),
        *[F.col(column).alias(unit) for unit, column in unit_ids.items()],
        *[F.col(column).alias(name) for column, name in (fields or {}).items()],
    )


def first_exposure(
    exposures: DataFrame, unit: str = "unit", group: str = "group", time: str = "ts", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Each unit's first exposure: its group, its time, and whether the unit was ever seen in another group."""
    order = F.struct(time, *tiebreak)
    return exposures.groupBy(unit).agg(
        F.min_by(group, order).alias(group),
        F.min(time).alias("first_ts"),
        (F.min(group) != F.max(group)).alias("crossover"),
    )


def until(df: DataFrame, time: str, day: date | None) -> DataFrame:
    """The rows up to the end of a day; all rows without one."""
    if day is None:
        return df
    end = datetime(day.year, day.month, day.day) + timedelta(days=1)
    return df.filter(F.col(time) < time_literal(end, df.schema[time].dataType.simpleString()))


def exposure_join(
    events: DataFrame, first: DataFrame, event_id: str, unit: str = "unit", time: str = "ts"
) -> DataFrame:
    """Events of exposed units at or after their first exposure."""
    joined = skew_join(events, first, [unit], salt_on=[event_id])
    return joined.filter(F.col(time) >= F.col("first_ts"))


def unit_totals(
    events: DataFrame,
    first: DataFrame,
    event_id: str,
    measures: Mapping[str, Column],
    unit: str = "unit",
    group: str = "group",
    as_of: date | None = None,
    time: str = "ts",
) -> DataFrame:
    """One row per exposed unit with summed measures; units without events keep zeros.

    With ``as_of`` the result is that of the end of this day: later events and units exposed later do not count yet.

    ``measures`` are per-event columns over the joined row (``first_ts`` included),
    zero or NULL where an event does not count.
    """
    events, first = until(events, time, as_of), until(first, "first_ts", as_of)
    joined = skew_join(events, first.select(unit, "first_ts"), [unit], salt_on=[event_id])
    sums = joined.groupBy(unit).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    kept = first.select(unit, group).join(sums, unit, "left")
    return kept.select(unit, group, *[F.coalesce(n, F.lit(0)).alias(n) for n in measures])


def metric_values(events: DataFrame, day: Column, metric: str, value: str, measure: str = "sum") -> DataFrame:
    """The value of each metric per day: ``sum``, ``count`` or ``mean``."""
    chosen = {"sum": F.sum, "count": F.count, "mean": exact_mean}[measure]
    return events.groupBy(day.alias("ds"), F.col(metric)).agg(chosen(value).alias("metric_value"))


def exact_mean(value: Column | str) -> Column:
    """Sum over count; on decimals the sum is exact and the order of rows cannot show."""
    return F.sum(value).cast("double") / F.count(value)


def ratio_metric(events: DataFrame, by: Sequence[str], numerator: Column, denominator: Column) -> DataFrame:
    """Sum over sum, NULL where the denominator is zero."""
    sums = events.groupBy(*by).agg(F.sum(numerator).alias("numerator"), F.sum(denominator).alias("denominator"))
    quotient = F.col("numerator").cast("double") / F.nullif(F.col("denominator").cast("double"), F.lit(0.0))
    return sums.withColumn("ratio", quotient)


def user_warehouse_metric(events: DataFrame, unit: str, by: Sequence[str], value: Column) -> DataFrame:
    """A per-unit total, then its mean over the units."""
    per_unit = events.groupBy(*by, unit).agg(F.sum(value).alias("_total"))
    return per_unit.groupBy(*by).agg(
        F.count(F.lit(1)).alias("units"), exact_mean("_total").alias("mean_per_unit")
    )


def funnel_metric(
    events: DataFrame, steps: Sequence[Column], event_id: str, unit: str = "unit", time: str = "ts"
) -> DataFrame:
    """Units reaching each step in order: a step counts only after the previous one's time.

    One aggregate per step instead of an ordered walk through a unit's events, so
    a unit with most of the events stays spread out.  Each step's one time per unit is
    written down, so no step is worked out again for the next ones.
    """
    reached = materialize(events.filter(steps[0]).groupBy(unit).agg(F.min(time).alias("_at")))
    stages = [reached]
    for step in steps[1:]:
        found = events.filter(step).select(unit, time, event_id)
        side = small_side(reached)
        later = skew_join(found, reached, [unit], salt_on=[event_id]) if side is None else found.join(side, unit)
        reached = materialize(later.filter(F.col(time) > F.col("_at")).groupBy(unit).agg(F.min(time).alias("_at")))
        stages.append(reached)
    rows = [s.agg(F.count(F.lit(1)).alias("units")).withColumn("step", F.lit(i)) for i, s in enumerate(stages, 1)]
    counts = rows[0]
    for row in rows[1:]:
        counts = counts.unionByName(row)
    before = F.lag("units").over(Window.orderBy("step"))
    return counts.select(
        "step", "units", (F.col("units") / F.nullif(before, F.lit(0))).alias("from_previous")
    )


def cumulative_exposures(first: DataFrame, group: str = "group", time: str = "first_ts") -> DataFrame:
    """Units exposed so far per day and group; the running window spans days, not units."""
    daily = first.groupBy(F.to_date(time).alias("ds"), group).agg(F.count(F.lit(1)).alias("new_units"))
    so_far = Window.partitionBy(group).orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("units", F.sum("new_units").over(so_far))


def dimensional_exposures(first: DataFrame, dimension: Column, group: str = "group") -> DataFrame:
    return first.groupBy(dimension.alias("dimension"), group).agg(F.count(F.lit(1)).alias("units"))


def sample_ratio_mismatch(
    first: DataFrame, split: Mapping[str, float], group: str = "group", severities: Mapping[str, float] | None = None
) -> DataFrame:
    """Chi-square of the observed groups against the planned split, its p-value and severity; one row.

    The severity is the first of ``severities`` (name to greatest p-value, most severe first) that the p-value does not exceed, else ``none``.
    """
    observed = [
        F.count(F.when(F.col(group) == name, 1)).alias(f"_n{i}") for i, name in enumerate(split)
    ]
    total_share = sum(split.values())
    counts = first.agg(*observed)
    total = sum((F.col(f"_n{i}") for i in range(1, len(split))), F.col("_n0"))
    parts = []
    for i, share in enumerate(split.values()):
        expected = F.col("_total") * (share / total_share)
        parts.append((F.col(f"_n{i}") - expected) * (F.col(f"_n{i}") - expected) / expected)
    chi = sum(parts[1:], parts[0])
    df = len(split) - 1
    tested = counts.withColumn("_total", total).withColumn("chi_square", chi).select(
        F.col("_total").alias("units"), "chi_square", F.lit(df).alias("df"), chi_square_p(F.col("chi_square"), df).alias("p_value")
    )
    severity = F.lit("none")
    for name, most in reversed((severities or SEVERITIES).items()):
        severity = F.when(F.col("p_value") <= most, name).otherwise(severity)
    return tested.withColumn("severity", severity)


# from this p-value down a mismatch is called by the name; ours, since nobody else's are published
SEVERITIES = {"high": 0.001, "medium": 0.01, "low": 0.05}


def arm_moments(units: DataFrame, value: str, by: Sequence[str] = (), group: str = "group") -> DataFrame:
    """n, mean and sample variance per arm: all a mean comparison needs."""
    y = F.col(value).cast("double")
    return units.groupBy(*by, group).agg(
        F.count(y).alias("n"), exact_mean(value).alias("mean"), F.var_samp(y).alias("variance")
    )


def _pick(arm: str, column: str, group: str) -> Column:
    return F.max(F.when(F.col(group) == arm, F.col(column)))


def compare_arms(
    moments: DataFrame,
    control: str,
    test: str,
    confidence: float = 0.95,
    by: Sequence[str] = (),
    group: str = "group",
) -> DataFrame:
    """Difference, relative lift, interval and two-sided p-value from the arms' moments.

    z = (m_t - m_c) / sqrt(v_t/n_t + v_c/n_c)
    """
    wide = moments.filter(F.col(group).isin(control, test)).groupBy(*by).agg(
        *[_pick(control, c, group).alias(f"control_{c}") for c in ("n", "mean", "variance")],
        *[_pick(test, c, group).alias(f"test_{c}") for c in ("n", "mean", "variance")],
    )
    error = F.sqrt(F.col("test_variance") / F.col("test_n") + F.col("control_variance") / F.col("control_n"))
    difference = F.col("test_mean") - F.col("control_mean")
    reach = F.lit(critical_z(confidence)) * F.col("std_error")
    return (
        wide.withColumn("difference", difference)
        .withColumn("std_error", error)
        .select(
            *by, "control_n", "control_mean", "test_n", "test_mean", "difference",
            (F.col("difference") / F.nullif("control_mean", F.lit(0.0))).alias("lift"),
            "std_error",
            (F.col("difference") - reach).alias("ci_low"),
            (F.col("difference") + reach).alias("ci_high"),
            F.when(F.col("std_error") > 0, two_sided_p(F.col("difference") / F.col("std_error"))).alias("p_value"),
        )
    )


def pulse(
    units: DataFrame, value: str, control: str, test: str, confidence: float = 0.95,
    by: Sequence[str] = (), group: str = "group",
) -> DataFrame:
    """Control against test on a per-unit value, overall or per ``by``."""
    return compare_arms(arm_moments(units, value, by, group), control, test, confidence, by, group)


def ratio_pulse(
    units: DataFrame, numerator: str, denominator: str, control: str, test: str,
    confidence: float = 0.95, by: Sequence[str] = (), group: str = "group",
) -> DataFrame:
    """The same for a ratio of two per-unit totals.

    r = mean(x)/mean(y);  var = (var(x) - 2 r cov(x,y) + r^2 var(y)) / mean(y)^2
    """
    x, y = F.col(numerator).cast("double"), F.col(denominator).cast("double")
    arms = units.groupBy(*by, group).agg(
        F.count(F.lit(1)).alias("n"),
        (exact_mean(numerator) / F.nullif(exact_mean(denominator), F.lit(0.0))).alias("mean"),
        F.var_samp(x).alias("_vx"), F.var_samp(y).alias("_vy"),
        F.covar_samp(x, y).alias("_cxy"), exact_mean(denominator).alias("_my"),
    )
    spread = F.col("_vx") - 2 * F.col("mean") * F.col("_cxy") + F.col("mean") * F.col("mean") * F.col("_vy")
    moments = arms.select(*by, group, "n", "mean", (spread / (F.col("_my") * F.col("_my"))).alias("variance"))
    return compare_arms(moments, control, test, confidence, by, group)


def _arm_pairs(units: DataFrame, value: str, covariate: str, group: str) -> DataFrame:
    """Per arm: n, means, variances and the covariance of a value and its covariate."""
    y, x = F.col(value).cast("double"), F.col(covariate).cast("double")
    return units.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("_my"), F.avg(x).alias("_mx"),
        F.var_samp(y).alias("_vy"), F.var_samp(x).alias("_vx"), F.covar_samp(y, x).alias("_cyx"),
    )


def _pooled(arms: DataFrame) -> DataFrame:
    """The arms with theta = cov(y, x) / var(x) and the covariate's mean over all of them.

    Pooled sums of products are those within the arms plus those between their means; the window spans the arms, a row each.
    """
    everything = Window.partitionBy()
    total = F.sum("n").over(everything)
    mean = lambda c: F.sum(F.col("n") * F.col(c)).over(everything) / total
    placed = arms.withColumn("_cy", mean("_my")).withColumn("covariate_mean", mean("_mx"))
    dx, dy = F.col("_mx") - F.col("covariate_mean"), F.col("_my") - F.col("_cy")
    within = lambda c: (F.col("n") - 1) * F.coalesce(c, F.lit(0.0))
    placed = placed.withColumn("_sxx", F.sum(within("_vx") + F.col("n") * dx * dx).over(everything))
    placed = placed.withColumn("_sxy", F.sum(within("_cyx") + F.col("n") * dx * dy).over(everything))
    theta = F.coalesce(F.col("_sxy") / F.nullif("_sxx", F.lit(0.0)), F.lit(0.0))
    return placed.withColumn("theta", theta).drop("_cy", "_sxx", "_sxy")


def cuped_theta(units: DataFrame, value: str, covariate: str) -> DataFrame:
    """theta = cov(y, x) / var(x) over all units, and the covariate's mean; one row."""
    y, x = F.col(value).cast("double"), F.col(covariate).cast("double")
    return units.agg(
        F.coalesce(F.covar_samp(y, x) / F.nullif(F.var_samp(x), F.lit(0.0)), F.lit(0.0)).alias("theta"),
        F.avg(x).alias("covariate_mean"),
    )


def cuped(
    units: DataFrame, value: str, covariate: str, control: str, test: str,
    confidence: float = 0.95, group: str = "group",
) -> DataFrame:
    """Pulse on the adjusted value y - theta (x - mean(x)); every unit needs both numbers.

    The adjustment is linear, so the arms' means, variances and covariances carry
    everything: one aggregate over the units, then arithmetic on one row per arm.
    """
    arms = _pooled(_arm_pairs(units, value, covariate, group))
    theta = F.col("theta")
    moments = arms.select(
        group, "n", "theta",
        (F.col("_my") - theta * (F.col("_mx") - F.col("covariate_mean"))).alias("mean"),
        (F.col("_vy") - 2 * theta * F.col("_cyx") + theta * theta * F.col("_vx")).alias("variance"),
    )
    return compare_arms(moments, control, test, confidence, ["theta"], group)


def daily_pulse(
    joined: DataFrame, value: Column, control: str, test: str,
    confidence: float = 0.95, unit: str = "unit", group: str = "group", time: str = "ts",
) -> DataFrame:
    """Pulse per day over the units active that day: those with an event, each with its day's total."""
    per_unit = joined.groupBy(F.to_date(time).alias("ds"), unit, group).agg(F.sum(value).alias("_value"))
    return pulse(per_unit, "_value", control, test, confidence, by=["ds"], group=group)


def topline_impact(
    joined: DataFrame, value: Column, control: str, test: str,
    unit: str = "unit", group: str = "group", time: str = "ts",
) -> DataFrame:
    """Per day: (mean_t - mean_c) * n_t, and its share of the day's total."""
    per_unit = joined.groupBy(F.to_date(time).alias("ds"), unit, group).agg(F.sum(value).alias("_value"))
    days = per_unit.groupBy("ds").agg(
        F.sum("_value").cast("double").alias("total"),
        F.count(F.when(F.col(group) == test, 1)).alias("test_units"),
        exact_mean(F.when(F.col(group) == test, F.col("_value"))).alias("_mt"),
        exact_mean(F.when(F.col(group) == control, F.col("_value"))).alias("_mc"),
    )
    impact = (F.col("_mt") - F.col("_mc")) * F.col("test_units")
    return days.select(
        "ds", "test_units", "total", impact.alias("impact"),
        (impact / F.nullif("total", F.lit(0.0))).alias("impact_share"),
    )


def ingestion_status(
    runs: DataFrame, keys: Sequence[str], start: date, end: date,
    day: str = "ds", status: str = "status", order: Sequence[str] = ("ts",), missing: str = "missing",
) -> DataFrame:
    """The last status per day and dataset; days without a run show ``missing``.

    Every dataset row is unfolded into the date range, which bounds the growth.
    """
    scoped = runs.filter(F.col(day).between(F.lit(start), F.lit(end)))
    latest = scoped.groupBy(*keys, day).agg(F.max_by(status, F.struct(*order)).alias(status))
    spine = runs.select(*keys).distinct().withColumn(day, F.explode(F.sequence(F.lit(start), F.lit(end))))
    return spine.join(latest, [*keys, day], "left").withColumn(status, F.coalesce(status, F.lit(missing)))


def high_water(df: DataFrame, time: str, mark: datetime | None) -> DataFrame:
    """What an incremental recompute reads: everything, or the rows at or after the mark's day."""
    if mark is None:
        return df
    day = mark.replace(hour=0, minute=0, second=0, microsecond=0)
    return df.filter(F.col(time) >= time_literal(day, df.schema[time].dataType.simpleString()))
