"""Object inventories: listings, sync plans, roll-ups, copy and delete plans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.paths import ancestor_prefixes, join_key, relative_to
from tidemill.operators.ordering import number_rows
from tidemill.operators.skew import skew_join

DELETE_BATCH = 1000


def inventory_under(objects: DataFrame, bucket: str, prefix: str = "") -> DataFrame:
    """Objects of a bucket below a prefix; directory placeholders are left out."""
    kept = objects.filter((F.col("bucket") == bucket) & F.col("key").startswith(prefix))
    return kept.filter(~F.col("is_directory")) if "is_directory" in objects.columns else kept


def level_listing(
    objects: DataFrame, bucket: str, prefix: str = "", limit: int | None = None, limit_scope: str = "objects"
) -> DataFrame:
    """One level below a prefix: sub-prefixes (ending in ``/``) first, then objects, each by name.

    ``limit_scope`` says what the limit counts: ``objects`` or ``all``.  Sub-prefixes
    are reduced in the map tasks, so a prefix holding most objects is one row.
    """
    below = inventory_under(objects, bucket, prefix).withColumn("_rest", relative_to(F.col("key"), prefix))
    nested = F.locate("/", F.col("_rest")) > 0
    prefixes = (
        below.filter(nested)
        .select(F.concat(F.lit(prefix), F.substring_index("_rest", "/", 1), F.lit("/")).alias("key"))
        .distinct()
        .select(F.lit(0).alias("_rank"), "key", F.lit(None).cast("long").alias("size"))
    )
    leaves = below.filter(~nested).select(F.lit(1).alias("_rank"), "key", F.col("size").cast("long").alias("size"))
    if limit is not None and limit_scope == "objects":
        leaves = leaves.orderBy("key").limit(limit)
    listing = prefixes.unionByName(leaves).orderBy("_rank", "key")
    if limit is not None and limit_scope == "all":
        listing = listing.limit(limit)
    return listing.select("key", "size", (F.col("_rank") == 0).alias("is_prefix"))


def object_stat(objects: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per wanted (bucket, key); absent objects keep NULL metadata and ``found`` false."""
    seen = objects.withColumn("found", F.lit(True))
    return wanted.join(seen, ["bucket", "key"], "left").withColumn("found", F.coalesce("found", F.lit(False)))


def sync_diff(source: DataFrame, target: DataFrame, base: str = "") -> DataFrame:
    """Source files to upload: no object under the mapped key has the same size.

    ``source`` has (relative, size), ``target`` has (key, size).  An unknown size
    equals an unknown size.  Keys are unique per side, so the join cannot skew.
    """
    mapped = source.withColumn("key", join_key(F.lit(base), F.col("relative")))
    same = (F.col("s.key") == F.col("t.key")) & F.col("s.size").eqNullSafe(F.col("t.size"))
    return mapped.alias("s").join(target.select("key", "size").alias("t"), same, "left_anti")


def prefix_rollup(objects: DataFrame, depth: int = 1) -> DataFrame:
    """Object count and bytes below every prefix down to ``depth`` segments (the bucket itself included)."""
    levels = F.slice(ancestor_prefixes(F.col("key")), 1, depth + 1)
    return (
        objects.select("bucket", F.explode(levels).alias("prefix"), "size")
        .groupBy("bucket", "prefix")
        .agg(F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    )


def prefix_overlap(sources: DataFrame, targets: DataFrame, target_id: str) -> DataFrame:
    """Targets equal to a source or lying below it: (bucket, source_key, target_key, target id).

    Each target is unfolded into its own ancestor prefixes, at most its depth, which
    turns the prefix test into an equi-join; no pairs are tried.
    """
    key = F.col("key")
    open_ended = (key == "") | key.endswith("/")
    left = sources.select(
        "bucket",
        key.alias("source_key"),
        F.explode(
            F.when(open_ended, F.array(F.struct(F.lit("below").alias("how"), key.alias("at")))).otherwise(
                F.array(
                    F.struct(F.lit("below").alias("how"), F.concat(key, F.lit("/")).alias("at")),
                    F.struct(F.lit("equal").alias("how"), key.alias("at")),
                )
            )
        ).alias("_token"),
    ).select("bucket", "source_key", "_token.how", "_token.at")
    below = F.transform(
        ancestor_prefixes(key), lambda p: F.struct(F.lit("below").alias("how"), p.alias("at"))
    )
    right = targets.select(
        "bucket",
        key.alias("target_key"),
        F.col(target_id),
        F.explode(F.concat(below, F.array(F.struct(F.lit("equal").alias("how"), key.alias("at"))))).alias("_token"),
    ).select("bucket", "target_key", target_id, "_token.how", "_token.at")
    joined = skew_join(right, left, ["bucket", "how", "at"], salt_on=[target_id])
    return joined.select("bucket", "source_key", "target_key", target_id)


def delete_batches(objects: DataFrame, order: Sequence[str | Column] = ("bucket", "key"), size: int = DELETE_BATCH):
    """Objects numbered into delete requests of at most ``size`` keys."""
    numbered = number_rows(objects, list(order), "_n")
    return numbered.withColumn("batch", F.floor((F.col("_n") - 1) / F.lit(size)).cast("long")).drop("_n")


def apply_copy_plan(plan: DataFrame, delete_source: bool = False) -> DataFrame:
    """Carry out a plan of (source_uri, target_uri) in the tasks; one status row per entry.

    Copying twice gives the same target, and a source already moved away by a
    retried task is accepted when its target exists.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            errors = []
            for source_uri, target_uri in zip(batch["source_uri"], batch["target_uri"]):
                try:
                    source_fs, source = fs.FileSystem.from_uri(source_uri)
                    target_fs, target = fs.FileSystem.from_uri(target_uri)
                    gone = source_fs.get_file_info(source).type == fs.FileType.NotFound
                    if not (delete_source and gone and target_fs.get_file_info(target).type == fs.FileType.File):
                        target_fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                        fs.copy_files(source, target, source_filesystem=source_fs, destination_filesystem=target_fs)
                        if delete_source:
                            source_fs.delete_file(source)
                    errors.append(None)
                except Exception as error:  # noqa: BLE001 - one bad entry must not hide the others
                    errors.append(str(error))
            yield pd.DataFrame(
                {"source_uri": batch["source_uri"], "target_uri": batch["target_uri"], "error": errors}
            )

    return plan.select("source_uri", "target_uri").mapInPandas(
        run, "source_uri string, target_uri string, error string"
    )
