"""SimHash near-duplicates through covering locality-sensitive hashing.

Every bit position of a fingerprint gets a non-zero label of radius + 1 bits.  The table of a
non-zero vector v keeps the positions whose label has an odd inner product with v.  The labels
of at most ``radius`` differing positions span a proper subspace, so some v is orthogonal to all
of them: that table keeps none of the differing positions, and the pair collides there.  No pair
within the radius is ever missed, and there are 2^(radius+1) - 1 tables, whatever the data.
"""

from __future__ import annotations

from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm.components import connected_components
from tidemill.llm.rows import map_rows, texts
from tidemill.session import materialize

BITS = 64
#: shingles hashed at a time, which bounds the memory for a text of any length
AT_ONCE = 1 << 16


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """A text's fingerprint as a signed 64-bit integer; zero without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only ASCII blanks part words
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else iter([b" ".join(words)])
    ones, total = np.zeros(BITS, np.int64), 0
    while True:
        hashes = np.fromiter(map(xxh64_intdigest, islice(grams, AT_ONCE), repeat(seed)), np.uint64)
        if not len(hashes):
            break
        total += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, bits): one row per input row."""

    def start():
        return lambda rows: [(i, fingerprint(t, width, seed)) for i, t in rows]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(texts(docs, id_col, text_col), [("doc_id", kind), ("bits", "bigint")], start)


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask per table, as unsigned integers."""
    vectors = 2 ** (radius + 1) - 1
    labels = [i % vectors + 1 for i in range(bits)]
    return [sum(1 << i for i, label in enumerate(labels) if (label & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def near_pairs(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``bits`` whose closure joins all within the radius.

    A bucket of two is verified as the pair that it is.  In a larger one nobody is compared
    with everybody: each member calls at every value within half the radius on the bucket's
    free positions, and those that meet there are linked to the smallest.  Two members meet
    exactly if they are within the radius, and a value is called at by a bounded number of members,
    so a bucket that holds a third of the corpus costs no more per member than any other.
    """
    if radius % 2 or not 0 < radius <= 4:
        raise ValueError("the radius must be 2 or 4")
    masks = covering_masks(radius)
    tables = [F.struct(F.lit(t).alias("t"), F.col("bits").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)]
    stored = nodes.select("bits", F.explode(F.array(*tables)).alias("at")).select("bits", "at.*")
    buckets = stored.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("bits").alias("a"), F.max("bits").alias("b"))
    buckets = materialize(buckets.filter("n > 1"))
    pairs = buckets.filter("n = 2").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
    crowded = buckets.filter("n > 2").select("t", "key")
    members = stored.join(crowded, ["t", "key"], "left_semi")
    calls = members.select("t", "bits", F.explode(_around(masks, radius // 2)).alias("meet"))
    met = calls.groupBy("t", "meet").agg(F.collect_list("bits").alias("who")).filter(F.size("who") > 1)
    linked = met.select(F.array_min("who").alias("a"), F.explode("who").alias("b")).filter("a < b")
    return pairs.unionByName(linked).distinct()


def _around(masks: list[int], steps: int) -> Column:
    """Every value that differs from ``bits`` in at most ``steps`` free positions of table ``t``."""
    flips = []
    for mask in masks:
        free = [1 << i for i in range(BITS) if not mask >> i & 1]
        reach = {0}
        for _ in range(steps):
            reach |= {r ^ f for r in reach for f in free}
        flips.append(F.array(*[F.lit(_signed(r)) for r in sorted(reach)]))
    chosen = F.element_at(F.array(*flips), F.col("t") + 1)
    return F.transform(chosen, lambda flip: F.col("bits").bitwiseXOR(flip))


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2, seed: int = 42
) -> DataFrame:
    """(doc_id, bits, component_id, root): one row per input row.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; the component id
    is the smallest id reachable, ``root`` the smallest fingerprint.  A NULL, empty or blank text has fingerprint zero and is
    linked like any other; repeated rows link with each other; a NULL id is kept and never a component's id
    (a component of NULL ids alone has the NULL id).  An empty table gives no rows.  Copies collapse to their
    fingerprint before any table is built, and no column but these two is read.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, width, seed))
    nodes = materialize(marked.groupBy("bits").agg(F.min("doc_id").alias("least")))
    roots = connected_components(near_pairs(nodes, radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "bits"), "bits", "left")
    rooted = rooted.withColumn("root", F.coalesce("component", "bits"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(smallest, "root").select("bits", "component_id", "root"))
    return marked.join(named, "bits").select("doc_id", "bits", "component_id", "root")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of ``docs`` per component, one with the smallest id, with all its columns, whatever those are called.

    The choice is made on ids and fingerprints.  Rows are found again by their id; only where several rows share
    the id (or it is NULL) by their fingerprint too, and of rows that share both one is taken.
    """
    found = materialize(simhash_components(docs, id_col, text_col, **settings))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "bits")).alias("best")
    chosen = materialize(found.groupBy("root").agg(best).select("best.doc_id", "best.bits"))
    single = materialize(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n = 1 AND doc_id IS NOT NULL").select("doc_id"))
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("doc_id"))
    plain = packed.join(materialize(chosen.join(single, "doc_id", "left_semi").select("doc_id")), "doc_id", "left_semi").select("row.*")
    shared = materialize(chosen.join(single, "doc_id", "left_anti"))
    if shared.isEmpty():
        return plain
    same = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
    rows = packed.alias("l").join(shared.select("doc_id").distinct().alias("r"), same, "left_semi").select("row.*")
    width, seed = settings.get("width", 3), settings.get("seed", 42)
    place = docs.columns.index(text_col)
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("bits", T.LongType())])
    arrow = to_arrow_schema(schema)

    def mark(batches):
        for batch in batches:
            row = pa.StructArray.from_arrays(batch.columns, fields=list(arrow[0].type))
            bits = [fingerprint(t or "", width, seed) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([row, pa.array(bits, pa.int64())], schema=arrow)

    again = rows.mapInArrow(mark, schema).withColumn("doc_id", F.col(f"row.`{id_col}`")).dropDuplicates(["doc_id", "bits"])
    again = again.alias("l").join(shared.alias("r"), same & (F.col("l.bits") == F.col("r.bits")), "left_semi")
    return plain.unionAll(again.select("row.*"))
