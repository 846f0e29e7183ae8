"""Which files of a keyed table may hold a key.

Keys fall into buckets by their hash.  A batch is written so that a bucket's rows share a file, and next to the batch lie its
filters: for every file and bucket a bitmap of the hashes of the keys in it.  The keys looked for become one bitmap per bucket, and
only files with a bit in common are opened.  Filters may be missing (a batch that ended before they were written);
such files are always opened, so a filter saves reading and never loses a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import path_exists

#: buckets of a table, a power of two; and bits of a bucket's bitmap, as many as one bitmap of Spark's holds
BUCKETS = 1 << 10
BITS = 1 << 15


def bucket_of(keys: Sequence[str]) -> Column:
    """The upper bits of the key's hash; ``bit_of`` takes the lower ones."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - BUCKETS.bit_length() + 1).cast("int")


def bit_of(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit(BITS - 1))


def by_buckets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows laid out for writing: a bucket in one partition, as many partitions as the rows' size asks for."""
    placed = rows.withColumn("_bucket", bucket_of(keys)).hint("rebalance", F.col("_bucket"))
    return placed.sortWithinPartitions("_bucket", *keys).drop("_bucket")


def write_filters(spark: SparkSession, folder: str, batch: str, keys: Sequence[str]) -> None:
    """The filters of a written batch, a folder below ``folder``; its key columns are all that is read."""
    stored = spark.read.parquet(f"{folder}/{batch}")
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    marked = stored.select(name.alias("file"), bucket_of(keys).alias("bucket"), bit_of(keys).alias("bit"))
    filters = marked.groupBy("file", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    filters.write.mode("overwrite").parquet(f"{folder}.filters/{batch}")


def files_with(folder: str, files: Sequence[str], touched: DataFrame, keys: Sequence[str]) -> list[str]:
    """Those of the table's ``files`` that may hold a key of ``touched``, in their order.

    The keys looked for are at most ``BUCKETS`` bitmaps of 4 KB, whatever their number, and so may be broadcast.
    """
    spark = touched.sparkSession
    if not files or not path_exists(spark, f"{folder}.filters"):
        return list(files)
    wanted = touched.select(bucket_of(keys).alias("bucket"), bit_of(keys).alias("bit"))
    wanted = wanted.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("wanted"))
    filters = spark.read.parquet(f"{folder}.filters")
    batch = [c for c in filters.columns if c not in ("file", "bucket", "bits")]
    met = filters.join(F.broadcast(wanted), "bucket").select(*batch, "file", "bucket", F.explode(F.array("bits", "wanted")).alias("bits"))
    common = met.groupBy(*batch, "file", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
    told = common.groupBy(*batch, "file").agg((F.max("n") > 0).alias("hit"))
    # one short row per file of the table, as many as its listing has
    known = filters.select(*batch, "file").distinct().join(told, [*batch, "file"], "left").collect()
    of = lambda r: "/".join([*[f"{c}={r[c]}" for c in batch], r.file])
    skipped = {of(r) for r in known if not r.hit}
    depth = len(batch) + 1
    return [f for f in files if "/".join(f.split("/")[-depth:]) not in skipped]


def read_files(spark: SparkSession, folder: str, files: Iterable[str]) -> DataFrame:
    """Rows of some files of a partitioned folder, partition columns included."""
    return spark.read.option("basePath", folder).parquet(*files)
