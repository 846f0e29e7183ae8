"""Log events: selection, patterns, statistics, paging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.time import parse_duration, resolve_time, time_literal
from tidemill.operators.ordering import top_n_per_group

MAX_PAGE = 1000


def time_range(df: DataFrame, column: str, start: str, end: str, reference: datetime) -> DataFrame:
    """Rows with ``start <= column < end``; bounds are ISO, ``now`` or look-backs from ``reference``."""
    like = df.schema[column].dataType.simpleString()
    low, high = (time_literal(resolve_time(text, reference), like) for text in (start, end))
    return df.filter((F.col(column) >= low) & (F.col(column) < high))


def since(df: DataFrame, column: str, reference: datetime, look_back: str = "10m") -> DataFrame:
    """Rows not older than ``look_back`` before ``reference``."""
    like = df.schema[column].dataType.simpleString()
    return df.filter(F.col(column) >= time_literal(reference - parse_duration(look_back), like))


def state_filter(df: DataFrame, column: str, states: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(list(states)))


def name_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def tag_filter(df: DataFrame, column: str, tags: Sequence[str], match_all: bool = False) -> DataFrame:
    """Rows carrying any (or every) one of the tags."""
    wanted = F.array(*[F.lit(t) for t in tags])
    if match_all:
        return df.filter(F.size(F.array_except(wanted, F.col(column))) == 0)
    return df.filter(F.arrays_overlap(F.col(column), wanted))


def log_pattern(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text contains every whitespace-separated term."""
    for term in pattern.split():
        df = df.filter(F.col(column).contains(term))
    return df


def updated_since(df: DataFrame, column: str, mark: datetime) -> DataFrame:
    """Rows strictly newer than a high-water mark."""
    return df.filter(F.col(column) > time_literal(mark, df.schema[column].dataType.simpleString()))


def stream_events(
    df: DataFrame, stream: Column, time: str, tiebreak: str, n: int, newest_first: bool = True
) -> DataFrame:
    """``n`` events of one stream; a top-k, not a sort of the stream."""
    order = [F.col(c).desc() if newest_first else F.col(c).asc() for c in (time, tiebreak)]
    return df.filter(stream).orderBy(*order).limit(n)


def newest_n_per_stream(df: DataFrame, streams: Sequence[str], time: str, tiebreak: str, n: int) -> DataFrame:
    """The newest ``n`` events of every stream, rank 1 being the newest."""
    order = [F.col(time).desc(), F.col(tiebreak).desc()]
    return top_n_per_group(df, streams, order, n, salt_on=[tiebreak])


def cursor_page(
    df: DataFrame,
    columns: Sequence[str],
    time: str,
    tiebreak: str,
    start: datetime,
    end: datetime,
    after: tuple[datetime, int] | None = None,
    limit: int = 100,
) -> DataFrame:
    """One page, newest first.  The cursor is the (time, id) of the last row shown.

    A page has at most ``MAX_PAGE`` rows; a greater limit is refused rather than cut.
    """
    if not 0 < limit <= MAX_PAGE:
        raise ValueError(f"a page has 1 to {MAX_PAGE} rows, not {limit}")
    like = df.schema[time].dataType.simpleString()
    page = df.filter((F.col(time) >= time_literal(start, like)) & (F.col(time) < time_literal(end, like)))
    if after is not None:
        moment, row_id = time_literal(after[0], like), F.lit(after[1])
        # the first test alone reaches the scan; the second settles equal times
        page = page.filter(F.col(time) <= moment).filter((F.col(time) < moment) | (F.col(tiebreak) < row_id))
    return page.orderBy(F.col(time).desc(), F.col(tiebreak).desc()).limit(limit).select(*columns)


def follow_cursor(df: DataFrame, time: str, tiebreak: str, last: tuple[datetime, int]) -> DataFrame:
    """Events after the last one shown; an equal time with a greater id still counts as new."""
    moment = time_literal(last[0], df.schema[time].dataType.simpleString())
    return df.filter(F.col(time) >= moment).filter(
        (F.col(time) > moment) | (F.col(tiebreak) > F.lit(last[1]))
    )


def log_stats(
    df: DataFrame,
    by: Mapping[str, Column],
    metrics: Mapping[str, Column],
    limit: int | None = None,
) -> DataFrame:
    """Named aggregates over named grouping columns (a time bin among them): all groups, or the first ``limit`` in order."""
    grouped = df.groupBy(*[column.alias(name) for name, column in by.items()])
    result = grouped.agg(*[column.alias(name) for name, column in metrics.items()])
    return result.orderBy(*by).limit(limit) if by and limit is not None else result


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``, which must end in a tiebreak: a top-k, not a sort."""
    return df.orderBy(*order).limit(n)


def time_bin(time: str, width: str) -> Column:
    return F.window(F.col(time), width)["start"]


def pairs_to_rows(df: DataFrame, pairs: str, fields: Sequence[str]) -> DataFrame:
    """Result rows given as lists of {field, value} turned into columns; absent fields are NULL."""
    from tidemill.functions.json import pairs_to_map

    keep = [c for c in df.columns if c != pairs]
    mapped = df.withColumn("_fields", pairs_to_map(F.col(pairs)))
    return mapped.select(*keep, *[F.try_element_at("_fields", F.lit(f)).alias(f) for f in fields])
