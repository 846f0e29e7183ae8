"""Event-time operators.  Each one works on a batch and on a stream alike."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.bands import band_join
from tidemill.operators.ordering import HeavyKeys, as_of_join, with_previous
from tidemill.operators.skew import dimension_join


_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"
# merges the sessions of a micro-batch in the map tasks first; a run's setting, see ``bounded_run``
MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def watermarked(df: DataFrame, time: str, delay: str) -> DataFrame:
    """Declare the lateness bound.  A batch needs none and is left alone."""
    return df.withWatermark(time, delay) if df.isStreaming else df


@contextmanager
def multi_source_policy(spark, slowest: bool = True) -> Iterator[None]:
    """Which source drives the watermark of queries over several that are started inside: the slowest, or the fastest.

    Spark knows no idle marking per partition; ``fastest`` keeps an idle source from
    holding back results, at the price of dropping what it brings later.  What was set before is set again at the end.
    """
    before = spark.conf.get(_POLICY)
    spark.conf.set(_POLICY, "min" if slowest else "max")
    try:
        yield
    finally:
        spark.conf.set(_POLICY, before)


def union_sources(sources: Sequence[DataFrame], time: str, delay: str) -> DataFrame:
    """Several streams as one, each with a watermark of its own (see ``multi_source_policy``)."""
    marked = [watermarked(s, time, delay) for s in sources]
    return reduce(DataFrame.unionByName, marked)


def time_windows(
    df: DataFrame, time: str, width: str, metrics: Mapping[str, Column],
    by: Sequence[str] = (), slide: str | None = None, delay: str | None = "0 seconds",
) -> DataFrame:
    """Tumbling windows, or sliding ones with ``slide``; a stream emits a window once the watermark passes its end.

    ``delay=None`` means the rows bring their watermark along.
    """
    window = F.window(F.col(time), width, slide) if slide else F.window(F.col(time), width)
    return _windowed(df if delay is None else watermarked(df, time, delay), window, metrics, by)


def session_windows(
    df: DataFrame, time: str, gap_seconds: int, metrics: Mapping[str, Column], by: Sequence[str],
    delay: str = "0 seconds", heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Runs of events of a key with pauses shorter than the gap; a session ends a gap after its last event.

    A stream run with ``MERGE_SESSIONS`` on merges the sessions of each micro-batch in the map tasks first.  A batch
    brings all events of a key together, so ``heavy`` keys go another way: their
    events are compared slice by slice, those that start a session are few (a key's
    sessions lie a gap apart), and each event takes its start from them.
    """
    gap = f"{gap_seconds} seconds"
    if df.isStreaming or heavy is None or not heavy.hashes:
        return _windowed(watermarked(df, time, delay), F.session_window(F.col(time), gap), metrics, by)
    is_heavy = heavy.covers(by)
    light = _windowed(df.filter(~is_heavy), F.session_window(F.col(time), gap), metrics, by)
    events = df.filter(is_heavy)
    pause = F.expr(f"INTERVAL {gap_seconds} SECONDS")
    # events at one time belong together, so distinct times decide
    times = events.select(*by, time).distinct()
    paired = with_previous(times, by, [time], [time], heavy.slice(by, F.col(time)))
    begins = F.col("previous").isNull() | (F.col(time) > F.col(f"previous.{time}") + pause)
    starts = paired.filter(begins).select(*by, F.col(time).alias("_start"))
    placed = as_of_join(events, starts, by, time, "_start", lambda moment: heavy.slice(by, moment), name="_session")
    sessions = placed.groupBy(F.col("_session._start").alias("window_start"), *by).agg(
        (F.max(time) + pause).alias("window_end"), *[c.alias(n) for n, c in metrics.items()]
    )
    return light.unionByName(sessions.select("window_start", "window_end", *by, *metrics))


def _windowed(df: DataFrame, window: Column, metrics: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    grouped = df.groupBy(window.alias("_w"), *by).agg(*[c.alias(n) for n, c in metrics.items()])
    return grouped.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by, *metrics
    )


def dedupe_by_id(df: DataFrame, ids: Sequence[str], time: str, delay: str) -> DataFrame:
    """Redelivered events count once.  A stream remembers an id for ``delay``; a batch for good."""
    if df.isStreaming:
        return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(ids))
    return df.dropDuplicates(list(ids))


def interval_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
    before_seconds: int, after_seconds: int,
) -> DataFrame:
    """Pairs of a key whose right time lies in [left - before, left + after].  Column names must differ but for keys.

    In batch this is a band join: rows of a key meet in stretches of time, crowded ones in finer cuts, so a
    key's rows are not paired with its whole history and a hot key or minute spreads.  On streams, the time condition lets Spark expire the state.
    """
    low = F.col(left_time) - F.expr(f"INTERVAL {before_seconds} SECONDS")
    high = F.col(left_time) + F.expr(f"INTERVAL {after_seconds} SECONDS")
    if not (left.isStreaming or right.isStreaming):
        return band_join(left, right, keys, low, high, right_time, before_seconds + after_seconds)
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    inside = (F.col(right_time) >= low) & (F.col(right_time) <= high)
    return left.join(other, [*same, inside], "inner").drop(*[f"_r_{k}" for k in keys])


def temporal_batches(
    versions: DataFrame, keys: Sequence[str], fact_time: str, version_time: str,
    slice_of: Callable[[Column], Column], write: Callable[[DataFrame, int], None],
) -> Callable[[DataFrame, int], None]:
    """A per-batch function: each fact of the stream with the version valid at its time.

    Of the versions only those of the batch's keys, up to its latest time, are sorted out; the history of other keys stays where it is.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        facts = batch.persist()
        try:
            touched = facts.select(*keys).distinct()
            needed = versions.join(touched, list(keys), "left_semi").select(*versions.columns)
            latest = facts.agg(F.max(fact_time)).first()[0]
            if latest is not None:
                needed = needed.filter(F.col(version_time) <= F.lit(latest))
            write(as_of_join(facts, needed, keys, fact_time, version_time, slice_of), batch_id)
        finally:
            facts.unpersist()

    return run


def lookup_join(rows: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the static dimension's columns, NULL where it has none; a stream reads it anew for every batch."""
    return dimension_join(rows, dimension, keys)


def regular_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All pairs of equal keys over the whole history.

    On streams neither side ever expires, so use it only where the keys are bounded;
    the interval form is the one that forgets.
    """
    return left.join(right, list(keys), "inner")
