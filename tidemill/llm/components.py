"""Connected components of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in ``links`` (a, b); the component is its smallest node.

    A round moves the larger neighbours of each node, then the smaller ones, to the smallest node around it, until only
    stars are left; that takes a logarithmic number of rounds, and never more links than at the start.
    A node's minimum is aggregated map-side and joined back as a table of its own, so a hub's links
    may be split over tasks.  NULLs and self-links are ignored; no links give no rows.
    """
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a IS NOT NULL AND b IS NOT NULL AND u > v")
    links, state = _kept(links.distinct())
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        up = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialize(up.filter("u > v").distinct())
        least = materialize(links.groupBy("u").agg(F.min("v").alias("m")))
        down = links.join(least, "u")
        down = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        links, now = _kept(down.filter("u > v").distinct())
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _kept(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links, cut from their lineage, and what tells them from other links."""
    links = materialize(links)
    mark = F.xxhash64("u", "v")
    row = links.agg(F.count(F.lit(1)), F.sum(F.shiftright(mark, 20)), F.bit_xor(mark)).first()
    return links, tuple(row)
