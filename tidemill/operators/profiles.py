"""Column profiles as stored states that merge: a table that grew is profiled by its new partitions alone."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.rows import cell_text
from tidemill.session import materialize, path_exists

#: logarithm of the buckets of a distinct sketch (4 KB at most); a relative error of about 1.6 %
DISTINCT_SIZE = 12
#: size of a quantile sketch; ranks are off by less than 1.7 % with 99 % confidence
QUANTILE_SIZE = 200
QUANTILES = (0.25, 0.5, 0.75)

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BROKEN = (T.FloatType, T.DoubleType, T.DecimalType)
_FILES = ["part", "files", "size", "stamp"]


def profile_states(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(part, partition, rows, columns): one state per partition, in one pass.

    ``partition`` has the values of ``by``, ``part`` the same as JSON, NULLs included.  ``columns`` has per column the NULLs, bounds, summed and
    greatest text length, a sketch of the distinct values and, for numbers, dates and times, one of the quantiles.
    All of it is reduced in the map tasks, so a partition of any size sends one state per task.  No rows give no states.
    """
    if not columns or not by:
        raise ValueError("columns to describe and columns to part by are needed")
    nested = [c for c in columns if isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    if nested:
        raise ValueError(f"no plain values: {', '.join(nested)}")
    kept = df.select(F.struct(*[F.col(f"`{b}`") for b in by]).alias("partition"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)])
    states = []
    for i, c in enumerate(columns):
        kind, value = df.schema[c].dataType, F.col(f"_{i}")
        length = F.when(value.isNotNull(), F.length(cell_text(kept, f"_{i}")))
        hashed = F.xxhash64(value + F.lit(0.0) if isinstance(kind, (T.FloatType, T.DoubleType)) else value)  # the two zeros are one value
        members = [
            F.count_if(value.isNull()).alias("nulls"), F.min(value).alias("least"), F.max(value).alias("greatest"),
            F.coalesce(F.sum(length), F.lit(0)).cast("long").alias("letters"), F.max(length).alias("longest"),
            F.hll_sketch_agg(F.when(value.isNotNull(), hashed), F.lit(DISTINCT_SIZE)).alias("distinct"),
        ]
        scaled = _scaled(value, kind)
        if scaled is not None:
            add = F.kll_sketch_agg_double if isinstance(kind, _BROKEN) else F.kll_sketch_agg_bigint
            members.append(add(scaled, F.lit(QUANTILE_SIZE)).alias("ranks"))
        states.append(F.struct(*members).alias(c))
    told = kept.groupBy("partition").agg(F.count(F.lit(1)).alias("rows"), F.struct(*states).alias("columns"))
    return told.select(_part(F.col("partition")).alias("part"), "partition", "rows", "columns")


def merge_profiles(states: DataFrame, by: Sequence[str] = (), quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(by..., column, rows, nulls, distinct_values, min_value, max_value, avg_length, max_length, quantiles): the profile of all states, or one per value of ``by``.

    Counts, bounds and lengths are exact, distinct values and quantiles as near as their sketches.  ``quantiles`` are texts;
    they are NULL for columns that are no numbers, dates or times, or have no values.  Without states, all columns have no rows.
    """
    kinds = states.schema["columns"].dataType
    merged = []
    for i, field in enumerate(kinds):
        def member(name: str, c: str = field.name) -> Column:
            return F.col(f"columns.`{c}`.{name}")

        merged += [
            F.coalesce(F.sum(member("nulls")), F.lit(0)).alias(f"_nulls{i}"), F.min(member("least")).cast("string").alias(f"_least{i}"),
            F.max(member("greatest")).cast("string").alias(f"_greatest{i}"), F.sum(member("letters")).alias(f"_letters{i}"),
            F.max(member("longest")).alias(f"_longest{i}"), F.hll_union_agg(member("distinct")).alias(f"_distinct{i}"),
        ]
        if "ranks" in field.dataType.names:
            join = F.kll_merge_agg_double if isinstance(field.dataType["least"].dataType, _BROKEN) else F.kll_merge_agg_bigint
            merged.append(join(member("ranks")).alias(f"_ranks{i}"))
    groups = [F.col(f"partition.`{b}`").alias(b) for b in by]
    one = states.groupBy(*groups).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_rows"), *merged)
    rows = []
    for i, field in enumerate(kinds):
        filled = F.col("_rows") - F.col(f"_nulls{i}")
        cuts = F.lit(None).cast("array<string>")
        if "ranks" in field.dataType.names:
            cuts = F.when(filled > 0, _cuts(F.col(f"_ranks{i}"), field.dataType["least"].dataType, quantiles))
        rows.append(F.struct(
            F.lit(field.name).alias("column"), F.col("_rows").alias("rows"), F.col(f"_nulls{i}").alias("nulls"),
            F.coalesce(F.hll_sketch_estimate(f"_distinct{i}"), F.lit(0)).alias("distinct_values"), F.col(f"_least{i}").alias("min_value"),
            F.col(f"_greatest{i}").alias("max_value"), F.when(filled > 0, F.col(f"_letters{i}") / filled).alias("avg_length"),
            F.col(f"_longest{i}").alias("max_length"), cuts.alias("quantiles"),
        ))
    return one.select(*[F.col(f"`{b}`") for b in by], F.inline(F.array(*rows)))


def refresh_profiles(spark: SparkSession, table: str, states: str, columns: Sequence[str], by: Sequence[str]) -> int:
    """Bring the states of a partitioned Parquet folder up to date; gives the number of partitions that were read.

    A state stands for the very files it was made of (their paths, sizes and times): partitions with other files than those are read, all
    else is left closed.  States are only ever added, so a run that is lost or done twice does no harm; what no longer fits is passed over by
    ``stored_profiles``.  Other columns or types begin states of their own.  The names of the partitions to read reach the driver.
    """
    rows, folder = spark.read.parquet(table), _state_folder(spark, table, states, columns, by)
    due = _partition_files(spark, table, by)
    if path_exists(spark, folder):
        due = due.join(_kept(rows, folder, columns, by).select(*_FILES), _FILES, "left_anti")
    due = materialize(due)
    parts = [r.part for r in due.select("part").collect()]
    if parts:
        chosen = rows.filter(_part(F.struct(*[F.col(f"`{b}`") for b in by])).isin(parts))
        profile_states(chosen, columns, by).join(due, "part").write.mode("append").parquet(folder)
    return len(parts)


def stored_profiles(spark: SparkSession, table: str, states: str, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The states that fit the folder's files as they are now, one per partition; what changed since the last refresh is not among them."""
    rows, folder = spark.read.parquet(table), _state_folder(spark, table, states, columns, by)
    if not path_exists(spark, folder):
        return profile_states(rows.limit(0), columns, by)
    kept = _kept(rows, folder, columns, by).join(_partition_files(spark, table, by), _FILES, "left_semi").dropDuplicates(["part"])
    return kept.select("part", "partition", "rows", "columns")


def _kept(rows: DataFrame, folder: str, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """All states ever stored; the schema is given, since a lost first run may have left no file."""
    schema = T.StructType([*profile_states(rows, columns, by).schema, *[T.StructField(f, T.LongType()) for f in _FILES[1:]]])
    return rows.sparkSession.read.schema(schema).parquet(folder)


def _part(partition: Column) -> Column:
    return F.to_json(partition, {"ignoreNullFields": "false"})


def _partition_files(spark: SparkSession, table: str, by: Sequence[str]) -> DataFrame:
    """(part, files, size, stamp): what a partition's files are, by their listing; none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(table)
    part = _part(F.struct(*[F.col(f"`{b}`") for b in by])).alias("part")
    return files.groupBy(part).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("size"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("stamp")
    )


def _state_folder(spark: SparkSession, table: str, states: str, columns: Sequence[str], by: Sequence[str]) -> str:
    schema = spark.read.parquet(table).schema
    named = repr([(c, schema[c].dataType.simpleString()) for c in [*columns, *by]] + [len(columns), DISTINCT_SIZE, QUANTILE_SIZE])
    return f"{states.rstrip('/')}/{sha256(named.encode()).hexdigest()[:16]}"


def _scaled(value: Column, kind: T.DataType) -> Column | None:
    """What a quantile sketch takes for a value; None for kinds without."""
    if isinstance(kind, _WHOLE):
        return value.cast("long")
    if isinstance(kind, _BROKEN):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    return None


def _cuts(sketch: Column, kind: T.DataType, quantiles: Sequence[float]) -> Column:
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    if isinstance(kind, _BROKEN):
        return F.kll_sketch_get_quantile_double(sketch, ranks).cast("array<string>")
    found = F.kll_sketch_get_quantile_bigint(sketch, ranks)
    if isinstance(kind, T.DateType):
        return F.transform(found, lambda v: F.date_from_unix_date(v.cast("int")).cast("string"))
    if isinstance(kind, T.TimestampType):
        return F.transform(found, lambda v: F.timestamp_micros(v).cast("string"))
    return found.cast("array<string>")
