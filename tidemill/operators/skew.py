"""Equi-joins against a keyed side when some keys are hot."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 100
LEAST_SALTS = 32
SMALL_ROWS = 100_000
SMALL_BYTES = 64 << 20


def hot_keys(df: DataFrame, keys: Sequence[str], at_most: int = HOT_KEYS) -> list[int]:
    """Hashes of the ``at_most`` keys with the most rows.

    A key owning more than 1/``at_most`` of the rows is certainly among them.  One
    pass over the key columns with map-side counting; ``at_most`` numbers reach the
    driver, whatever the data's size.
    """
    load = df.groupBy(F.xxhash64(*keys).alias("_key")).agg(F.count(F.lit(1)).alias("_load"))
    return [r._key for r in load.orderBy(F.col("_load").desc(), "_key").limit(at_most).collect()]


def skew_join(
    facts: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    salt_on: Sequence[str] | None = None,
    how: str = "inner",
    salts: int | None = None,
    hot: list[int] | None = None,
) -> DataFrame:
    """``facts`` joined to ``keyed`` on ``keys`` (inner, left, left_semi, left_anti).

    Rows of hot keys, and rows whose key is NULL, are spread over ``salts`` sub-keys
    by a hash of ``salt_on`` (all columns by default).  There are as many salts as
    shuffle partitions, so a hot key can fill the cluster; only the at most hundred
    hot rows of ``keyed`` are repeated for it.  Nothing is dropped, and the cold bulk is joined as usual.

    Both sides decide by the same hash and the same literal list, so any list gives
    the same result, a retried task included; a loop finds it once and passes it as
    ``hot``.  Keys must not be floating point, where equal values may hash apart.
    """
    hot = hot_keys(facts, keys) if hot is None else hot
    if salts is None:
        salts = max(LEAST_SALTS, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    alike = [F.col(k).cast(facts.schema[k].dataType).alias(k) for k in keys]
    keyed = keyed.select(*alike, *[c for c in keyed.columns if c not in keys])
    is_hot = F.xxhash64(*keys).isin(hot)
    absent = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    zero = F.lit(0).cast("long")
    spread = F.pmod(F.xxhash64(*(salt_on or facts.columns)), F.lit(salts))
    copies = F.sequence(zero, F.lit(salts - 1).cast("long"))
    left = facts.withColumn("_salt", F.when(is_hot | absent, spread).otherwise(zero))
    right = keyed.withColumn("_salt", F.explode(F.when(is_hot, copies).otherwise(F.array(zero))))
    return left.join(right, [*keys, "_salt"], how).select(*_output(facts, keyed, keys, how))


def _output(facts: DataFrame, keyed: DataFrame, keys: Sequence[str], how: str) -> list[str]:
    if how in ("left_semi", "left_anti"):
        return facts.columns
    return [*facts.columns, *[c for c in keyed.columns if c not in keys]]


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame | None:
    """A broadcast hint, given only after measuring that the side is small in rows and in bytes; else None.

    One job that reads at most ``max_rows + 1`` rows.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))
    rows, length = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and length <= max_bytes else None


def dimension_join(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_rows: int = SMALL_ROWS,
    hot: Callable[[], list[int]] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """A keyed dimension joined by broadcast where it is measured to be small, else by ``skew_join``.

    ``rows`` is its row count where the caller knows it; such a side must be narrow.
    A stream reads its dimension anew for every batch, so no hint is kept for it: Spark's own stream-static
    join decides batch by batch.
    """
    if facts.isStreaming:
        side = None
    elif rows is not None:
        side = F.broadcast(dimension) if rows <= max_rows else None
    else:
        side = small_side(dimension, max_rows)
    if side is None and not facts.isStreaming:
        return skew_join(facts, dimension, keys, how=how, hot=hot() if hot else None)
    joined = facts.join(dimension if side is None else side, list(keys), how)
    return joined.select(*_output(facts, dimension, keys, how))
