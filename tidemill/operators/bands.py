"""Joins of rows to the rows of another side that lie in a band of time, also where one moment holds most of them."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordering import heavy_keys

#: a cell with more than this many even shares of the shuffle partitions is divided
SHARES = 2


def _crowds(cells: DataFrame, cell: Sequence[str], rows: int) -> dict[int, int]:
    """Into how many parts each crowded cell goes, by hash.  There are at most as many as ``rows`` goes into all rows."""
    load = cells.groupBy(F.xxhash64(*cell).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    return {r.cell: -(-r.n // rows) for r in load.filter(F.col("n") > rows).collect()}


def _parts(crowds: dict[int, int], cell: Sequence[str]) -> Column:
    """The number of parts of a row's cell, 1 for cells that are not divided."""
    if not crowds:
        return F.lit(1)
    table = F.from_json(F.lit(json.dumps({str(k): n for k, n in crowds.items()})), "map<string, int>")
    found = F.try_element_at(table, F.xxhash64(*cell).cast("string"))
    return F.when(F.xxhash64(*cell).isin(list(crowds)), found).otherwise(F.lit(1))


def band_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], low: Column, high: Column, right_time: str, width_seconds: int
) -> DataFrame:
    """Pairs of a key whose right time lies from ``low`` to ``high``, expressions on ``left`` that are at most ``width_seconds`` apart.

    Both sides meet in cells of a key and a stretch of time as wide as the band.  A cell that holds much of the right side is cut at
    quantiles of its own times, and a left row goes only to the cuts that its band touches, so apart from a band's two ends all rows that meet are pairs.  A cut
    in which still too many rows of a side meet (those of one moment, or many bands over a few rows) is divided by that side's hash, and
    the other side's rows go to all its parts.  So a row is repeated no more often than its pairs fill tasks, and no task holds a
    crowd.  Columns of the two sides must differ but for the keys; NULL keys and times pair with nothing.  What is counted beforehand are keys and
    times; the cuts and parts that reach the driver are at most a few per shuffle partition.
    """
    spark = left.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stretch = lambda c: F.floor(F.unix_seconds(c.cast("timestamp")) / F.lit(max(width_seconds, 1)))
    cell, cut = [*keys, "_stretch"], [*keys, "_stretch", "_cut"]
    left = left.withColumns({"_low": low, "_high": high})
    named = right.select(*[F.col(k).cast(left.schema[k].dataType).alias(k) for k in keys], *[c for c in right.columns if c not in keys])
    placed = named.filter(F.col(right_time).isNotNull()).withColumn("_stretch", stretch(F.col(right_time)))
    rows = max(1, SHARES * (right.count() // shares))
    heavy = heavy_keys(placed, cell, right_time, rows=rows, at_most=shares)
    whole = F.lit(1).cast("int")

    def cut_of(moment: Column) -> Column:
        return F.coalesce(heavy.slice(cell, moment), whole).cast("int") if heavy.cuts else whole

    placed = placed.withColumn("_cut", cut_of(F.col(right_time)))
    spread = left.withColumn("_stretch", F.explode(F.sequence(stretch(F.col("_low")), stretch(F.col("_high")))))
    if heavy.cuts:
        spread = spread.withColumn("_cut", F.explode(F.sequence(cut_of(F.col("_low")), cut_of(F.col("_high")))))
    else:
        spread = spread.withColumn("_cut", whole)
    ours = _crowds(spread, cut, max(1, SHARES * (left.count() // shares)))
    theirs = _crowds(placed, cut, SHARES * rows)
    own = lambda n, columns: F.pmod(F.xxhash64(*columns), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    spread = spread.withColumn("_ours", own(_parts(ours, cut), left.columns)).withColumn("_theirs", every(_parts(theirs, cut)) if theirs else F.lit(0))
    placed = placed.withColumn("_theirs", own(_parts(theirs, cut), right.columns)).withColumn("_ours", every(_parts(ours, cut)) if ours else F.lit(0))
    joined = spread.join(placed, [*cut, "_ours", "_theirs"], "inner")
    inside = (F.col(right_time) >= F.col("_low")) & (F.col(right_time) <= F.col("_high"))
    return joined.filter(inside).drop("_low", "_high", "_stretch", "_cut", "_ours", "_theirs")
