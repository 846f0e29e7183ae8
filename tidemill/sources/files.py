"""File sources."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.paths import relative_to
from tidemill.session import qualified

HEAD_BYTES = 65_536
HEAD_LINES = 10
# Fixed value: everything that ends a line of text.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def file_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files below a folder that are not empty: (bucket, key, uri, size, updated, is_directory).  Contents are not read.

    Spark lists them on the driver and passes over empty ones; ``listing.folder_inventory`` lists in the tasks and has both.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    root = qualified(spark, path).rstrip("/") + "/"
    files = reader.load(path).select("path", "length", "modificationTime")
    return files.select(
        F.lit(root).alias("bucket"), relative_to(F.col("path"), root).alias("key"), uri_of("path").alias("uri"),
        F.col("length").alias("size"), F.col("modificationTime").alias("updated"), F.lit(False).alias("is_directory"),
    )


def uri_of(path: Column | str) -> Column:
    """A reported file path as a URI; local ones are reported as ``file:/x``."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def head_text(content: Column, lines: int = HEAD_LINES, size: int = HEAD_BYTES) -> Column:
    """The first lines of the first ``size`` bytes, joined by newlines."""
    text = cat_text(content, size)
    # a line end closes a line, so it opens no empty last one
    rows = F.split(F.regexp_replace(text, f"(?:{LINE_END})\\z", ""), LINE_END)
    return F.array_join(F.slice(rows, 1, lines), "\n")


def cat_text(content: Column, size: int | Column) -> Column:
    """The first ``size`` bytes as text; bytes that are no UTF-8 become U+FFFD."""
    cut = F.substring(content, F.lit(1), size if isinstance(size, Column) else F.lit(size))
    return F.make_valid_utf8(cut.cast("string"))


def object_head(spark: SparkSession, path: str, lines: int = HEAD_LINES, size: int = HEAD_BYTES) -> DataFrame:
    """The head of every file below a path.  No more than ``size`` bytes of a file are read."""
    return first_bytes(spark, path, size).select("path", "length", head_text(F.col("content"), lines, size).alias("head"))


def first_bytes(spark: SparkSession, path: str, size: int = HEAD_BYTES) -> DataFrame:
    """(path, length, content): the first ``size`` bytes of every file below a path, read in the tasks, from file systems that Arrow knows."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    schema = "path string, length bigint, content binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = []
            for uri in batch.column(0).to_pylist():
                system, place = arrow_fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
                with system.open_input_file(place) as file:
                    heads.append(file.read(size))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, pa.binary())], names=["path", "length", "content"])

    return files.select("path", "length").mapInArrow(read, schema)


def select_object(
    spark: SparkSession, path: str, sql: str, fmt: str = "parquet",
    header: bool = True, json_type: str = "LINES", schema: str | None = None, multi_line: bool = False,
) -> DataFrame:
    """SQL over files, which are the relation ``s3object``.

    CSV without a header has the columns ``_1``, ``_2``...; JSON is one document per
    line (LINES) or per file (DOCUMENT); compression follows the file suffix.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        frame = reader.csv(path, header=header, multiLine=multi_line)
        if not header and schema is None:
            frame = frame.toDF(*[f"_{i}" for i in range(1, len(frame.columns) + 1)])
    elif fmt == "json":
        frame = reader.json(path, multiLine=json_type == "DOCUMENT")
    elif fmt == "parquet":
        frame = reader.parquet(path)
    else:
        raise ValueError(f"format is csv, json or parquet, not {fmt!r}")
    frame.createOrReplaceTempView("s3object")
    return spark.sql(sql)


def datagen(spark: SparkSession, start: int, end: int, length: int, seed: int = 0, source: str = "datagen") -> DataFrame:
    """A bounded sequence ``start..end`` with random text of a fixed length."""
    return spark.range(start, end + 1).select(
        "id", F.randstr(F.lit(length), seed).alias("payload"), F.lit(source).alias("source")
    )


def fixture_files(spark: SparkSession, path: str, schema: str, streaming: bool = False) -> DataFrame:
    """JSON files as a reproducible source, in batch or as a stream."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).json(path)


def discover_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """(table, column, type, is_partition): every folder below ``root`` that holds files is a table.

    Folders named ``key=value`` are partitions, whose types are inferred.  Schemas are read by Spark, one table after the other.
    """
    steps = F.filter(F.split(F.col("key"), "/"), lambda s: s.rlike("^[^=]+="))
    named = F.transform(steps, lambda s: F.substring_index(s, "=", 1))
    listed = file_inventory(spark, root).filter(F.col("key").contains("/")).select(F.substring_index("key", "/", 1).alias("table"), named.alias("keys"))
    tables = listed.groupBy("table").agg(F.array_distinct(F.flatten(F.collect_set("keys"))).alias("keys")).orderBy("table")
    rows = []
    for table, keys in tables.collect():  # one row per table
        schema = spark.read.format(fmt).load(f"{root.rstrip('/')}/{table}").schema
        rows += [(table, f.name, f.dataType.simpleString(), f.name in keys) for f in schema]
    return spark.createDataFrame(rows, "table string, column string, type string, is_partition boolean")


def discover_partitions(spark: SparkSession, path: str) -> DataFrame:
    """(values, files, size): the partitions of a table's folder by the ``key=value`` steps of its files' paths."""
    steps = F.filter(F.split(F.col("key"), "/"), lambda s: s.rlike("^[^=]+="))
    pairs = F.transform(steps, lambda s: F.struct(F.substring_index(s, "=", 1).alias("k"), F.url_decode(F.regexp_replace(s, "^[^=]+=", "")).alias("v")))
    listed = file_inventory(spark, path).select(pairs.alias("pairs"), "size")
    grouped = listed.groupBy("pairs").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("size"))
    return grouped.select(F.map_from_entries("pairs").alias("values"), "files", "size")


def discover_schema(discovered: DataFrame, known: DataFrame) -> DataFrame:
    """Column changes between a discovered and a known catalog: (table, column, change).

    Both sides are (table, column, type).  A table absent from one side counts as
    created or deleted; other differences make it updated.
    """
    both = discovered.alias("d").join(
        known.alias("k"), ["table", "column"], "full"
    ).select("table", "column", F.col("d.type").alias("new_type"), F.col("k.type").alias("old_type"))
    changed = both.filter(~F.col("new_type").eqNullSafe(F.col("old_type")))
    tables = both.groupBy("table").agg(
        F.count("new_type").alias("_new"), F.count("old_type").alias("_old")
    )
    status = F.when(F.col("_old") == 0, "created").when(F.col("_new") == 0, "deleted").otherwise("updated")
    return changed.join(tables, "table").select("table", "column", "old_type", "new_type", status.alias("change"))


def schema_table(df: DataFrame, table: str) -> DataFrame:
    rows = [(table, f.name, f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "table string, column string, type string")


def parse_json_strict(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Parsed rows; a malformed text fails the job."""
    return df.withColumn("parsed", F.from_json(column, schema, {"mode": "FAILFAST"}))


def parse_json_lenient(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Parsed rows plus ``rejected``, which marks malformed texts; their ``parsed`` is NULL."""
    with_error = f"{schema}, _corrupt_record string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = df.withColumn("_p", F.from_json(column, with_error, options))
    rejected = F.col("_p._corrupt_record").isNotNull()
    return parsed.withColumn("rejected", rejected).withColumn(
        "parsed", F.when(~rejected, F.col("_p").dropFields("_corrupt_record"))
    ).drop("_p")


def not_null_policy(df: DataFrame, columns: Sequence[str], policy: str = "error") -> DataFrame:
    """NOT NULL at a sink: ``error`` stops the job at the first NULL, ``drop`` leaves such rows out."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    if policy == "drop":
        return df.filter(~missing)
    if policy != "error":
        raise ValueError("policy is 'error' or 'drop'")
    message = F.lit(f"NULL in a NOT NULL column of ({', '.join(columns)})")
    return df.filter(F.when(missing, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def not_null_rejects(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows the policy leaves out, with the names of their NULL columns."""
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("null_columns", names).filter(F.size("null_columns") > 0)
