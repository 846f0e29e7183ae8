"""Order-dependent building blocks that hold when one key owns most rows.

A window over ``partitionBy(key)`` puts a whole key into one task.  The functions
here cut a heavy key into slices of its order column, work inside slices, and carry
one summary row per slice across the cuts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import materialize


def order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


@dataclass(frozen=True)
class HeavyKeys:
    """Keys too large for one task, by hash, each with the moments (in microseconds) at which it is cut."""

    cuts: tuple[tuple[int, tuple[int, ...]], ...] = ()

    @property
    def hashes(self) -> tuple[int, ...]:
        return tuple(key for key, _ in self.cuts)

    def covers(self, keys: Sequence[str]) -> Column:
        return F.xxhash64(*keys).isin(list(self.hashes))

    def slice(self, keys: Sequence[str], moment: Column) -> Column:
        """The slice number of a heavy key's row, NULL for all other keys: one more than the key's cuts before the moment."""
        table = F.from_json(F.lit(json.dumps({str(k): c for k, c in self.cuts})), "map<string, array<bigint>>")
        own = F.try_element_at(table, F.xxhash64(*keys).cast("string"))
        at = F.unix_micros(moment.cast("timestamp"))
        # the moment's place among the cuts; a lambda here would hide its columns from the optimizer
        return F.when(self.covers(keys), F.array_position(F.array_sort(F.array_append(own, at)), at))


def heavy_keys(df: DataFrame, keys: Sequence[str], time: str, rows: int | None = None, at_most: int = 1_000) -> HeavyKeys:
    """Keys with more than ``rows`` rows, cut at quantiles of their own times.

    A slice holds about ``rows`` rows however they crowd together; only rows of one and the same
    microsecond are never parted.  ``rows`` is twice an even share of the shuffle partitions by default.  Counts and quantiles
    are reduced in the map tasks; at most ``at_most`` keys, and all in all one cut per ``rows`` rows, reach the driver, and a key left
    out owns at most 1/``at_most`` of the rows.
    """
    moment = F.unix_micros(F.col(time).cast("timestamp"))
    key = F.xxhash64(*keys).alias("key")
    load = df.groupBy(key).agg(F.count(moment).alias("n"))
    if rows is None:
        total = load.agg(F.sum("n")).first()[0] or 0
        rows = max(1, 2 * total // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = {r.key: r.n for r in load.filter(F.col("n") > rows).orderBy(F.col("n").desc(), "key").limit(at_most).collect()}
    if not found:
        return HeavyKeys()
    parts = -(-max(found.values()) // rows)
    shares = [i / parts for i in range(1, parts)]
    own = df.filter(F.xxhash64(*keys).isin(list(found))).groupBy(key)
    cut = {r.key: r.at for r in own.agg(F.percentile_approx(moment, shares, 50 * parts).alias("at")).collect()}
    return HeavyKeys(tuple((k, _spread(cut[k], -(-n // rows))) for k, n in found.items()))


def _spread(cuts: Sequence[int], slices: int) -> tuple[int, ...]:
    """The cuts that part a key into about ``slices`` slices, out of even ones for more slices; equal ones once."""
    parts = len(cuts) + 1
    return tuple(sorted({cuts[i * parts // slices - 1] for i in range(1, slices) if i * parts // slices}))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key.

    ``order`` must end in a tiebreak.  An aggregate, not a window: every map task
    hands over at most one row per key, so a hot key costs no more than a cold one.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order_struct(order)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the least ``order`` tuple per key."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order_struct(order)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def top_n_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    n: int,
    salt_on: Sequence[str],
    salts: int | None = None,
    rank_name: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of each group, ranked, in two steps.

    Each (group, salt) keeps its own first ``n``; the final ranking then sees at
    most ``salts * n`` rows of a group, whatever the group's size.  There are as many salts as shuffle partitions.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
    local = Window.partitionBy(*groups, "_salt").orderBy(*order)
    final = Window.partitionBy(*groups).orderBy(*order)
    return (
        salted.withColumn("_local", F.row_number().over(local))
        .filter(F.col("_local") <= n)
        .drop("_salt", "_local")
        .withColumn(rank_name, F.row_number().over(final))
        .filter(F.col(rank_name) <= n)
    )


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    slice_by: Column,
    name: str = "previous",
) -> DataFrame:
    """Add ``name``: a struct of ``columns`` from the preceding row of the same key.

    NULL on a key's first row.  ``slice_by`` must not decrease along ``order`` (a
    day or an hour of the time column, see ``HeavyKeys.slice``) and is NULL for keys
    that are not to be cut; ``(keys, order)`` must be unique.  Rows shuffle once by
    (keys, slice).  The last row of each slice travels into the next one as an extra
    leading row: one per cut key and slice, and the window that passes them on spans
    a key's slices, whose number the time range sets.
    """
    image = F.struct(*[F.col(c) for c in columns])
    rows = df.select(
        *keys,
        slice_by.alias("_slice"),
        F.lit(1).alias("_kind"),
        *[F.col(c).alias(f"_o_{c}") for c in order],
        image.alias("_image"),
        F.struct(*df.columns).alias("_row"),
    )
    order_key = [f"_o_{c}" for c in order]
    cut = rows.filter(F.col("_slice").isNotNull())
    tails = cut.groupBy(*keys, "_slice").agg(F.max_by("_image", order_struct(order_key)).alias("_tail"))
    across = Window.partitionBy(*keys).orderBy("_slice")
    carried = (
        tails.withColumn("_image", F.lag("_tail").over(across))
        .filter(F.col("_image").isNotNull())
        .select(*keys, "_slice", F.lit(0).alias("_kind"), "_image")
    )
    inner = Window.partitionBy(*keys, "_slice").orderBy("_kind", *order_key)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn("_before", F.lag("_image").over(inner))
        .filter(F.col("_kind") == 1)
        .select(*[F.col("_row")[c].alias(c) for c in df.columns], F.col("_before").alias(name))
    )


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    version_time: str,
    slice_of: Callable[[Column], Column],
    version_tiebreak: Sequence[str] = (),
    name: str = "version",
) -> DataFrame:
    """Add ``name``: the latest row of ``versions`` at or before each fact, per key.

    Facts without an earlier version keep a NULL.  No key-by-key pairing happens:
    facts and versions are merged in time order inside (key, slice), and the last
    version of the earlier slices enters as one leading row.  ``slice_of`` gives the
    slice of a time on either side, NULL for keys that are not to be cut.
    """
    alike = [F.col(k).cast(facts.schema[k].dataType).alias(k) for k in keys]
    versions = versions.select(*alike, *[c for c in versions.columns if c not in keys])
    payload = F.struct(*versions.columns)
    none = F.lit(None)
    right = versions.select(
        *keys,
        slice_of(F.col(version_time)).alias("_slice"),
        F.col(version_time).alias("_time"),
        F.lit(1).alias("_kind"),
        F.struct(version_time, *version_tiebreak).alias("_tie"),
        payload.alias("_version"),
    )
    left = facts.select(
        *keys,
        slice_of(F.col(fact_time)).alias("_slice"),
        F.col(fact_time).alias("_time"),
        F.lit(2).alias("_kind"),
        F.struct(*facts.columns).alias("_fact"),
    )
    # one row per (key, slice) on either side, with the slice's last version if it has one
    cut = F.col("_slice").isNotNull()
    tails = right.filter(cut).groupBy(*keys, "_slice").agg(F.max_by("_version", "_tie").alias("_tail"))
    visited = left.filter(cut).select(*keys, "_slice").distinct().withColumn("_tail", none.cast(tails.schema["_tail"].dataType))
    summary = tails.unionByName(visited).groupBy(*keys, "_slice").agg(F.first("_tail", ignorenulls=True).alias("_tail"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.withColumn("_version", F.last("_tail", ignorenulls=True).over(before))
        .filter(F.col("_version").isNotNull())
        .select(*keys, "_slice", F.lit(0).alias("_kind"), "_version")
    )
    merged = right.unionByName(left, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    # the carried row has no time and sorts first; at equal times versions precede facts
    inner = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(F.col("_time").asc_nulls_first(), "_kind", "_tie")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        merged.withColumn(name, F.last("_version", ignorenulls=True).over(inner))
        .filter(F.col("_kind") == 2)
        .select(*[F.col("_fact")[c].alias(c) for c in facts.columns], name)
    )


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """A dense global row number from 1 in ``order``, without a one-task window.

    Rows are range-partitioned on the whole order tuple (a hot leading value is
    split by the later columns) and sorted in place.  The sorted rows are
    checkpointed, because a retried range exchange may cut elsewhere.  Offsets are
    one row per partition, which also bounds the broadcast and the single window.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("_mark", F.monotonically_increasing_id()))
    # the mark holds the partition in its upper 31 bits, the row in its lower 33
    placed = placed.withColumn("_part", F.shiftright("_mark", 33)).withColumn(
        "_row", F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_row") + 1).alias(name)
    )
