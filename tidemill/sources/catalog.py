"""The session catalog as DataFrames."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_COLUMNS = "database string, table string, column string, type string, is_partition boolean"


def catalog_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def catalog_tables(spark: SparkSession, database: str, pattern: str = ".*") -> DataFrame:
    """Tables of a database whose name contains a match."""
    return spark.sql(f"SHOW TABLES IN `{database}`").filter(F.col("tableName").rlike(pattern))


def catalog_columns(spark: SparkSession, database: str, table: str) -> DataFrame:
    rows = [
        (database, table, c.name, c.dataType, c.isPartition)
        for c in spark.catalog.listColumns(f"`{database}`.`{table}`")
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def catalog_search(spark: SparkSession, keyword: str, databases: list[str] | None = None) -> DataFrame:
    """Columns whose database, table or column name contains the keyword, in any case."""
    rows = []
    for database in databases or [d.name for d in spark.catalog.listDatabases()]:
        for t in spark.catalog.listTables(database):
            name = f"`{database}`.`{t.name}`" if not t.isTemporary else f"`{t.name}`"
            rows += [(database, t.name, c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(name)]
    found = spark.createDataFrame(rows, _COLUMNS)
    return found.filter(F.concat_ws(" ", "database", "table", "column").rlike("(?i)" + re.escape(keyword)))


# Fixed value: the folder name of the NULL partition.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_filter(spark: SparkSession, table: str, predicate: str | None = None) -> DataFrame:
    """Registered partitions of a table, empty ones included: the partition columns and each one's ``location``.

    Everything comes from the catalog; no data file is opened.  The predicate may name partition columns only.
    The catalog is asked for the location of each partition that the predicate leaves.
    """
    keys = [(c.name, c.dataType) for c in spark.catalog.listColumns(table) if c.isPartition]

    def value(i: int) -> Column:
        shown = F.regexp_extract(F.get(F.split("partition", "/"), F.lit(i)), "^[^=]*=(.*)$", 1)
        return F.when(shown != NO_VALUE, F.url_decode(F.replace(shown, F.lit("+"), F.lit("%2B"))))

    rows = spark.sql(f"SHOW PARTITIONS {table}").select(*[value(i).cast(kind).alias(name) for i, (name, kind) in enumerate(keys)])
    rows = rows.filter(F.expr(predicate)) if predicate else rows
    found = [(*r, _partition_location(spark, table, dict(zip([k for k, _ in keys], r)))) for r in rows.collect()]
    return spark.createDataFrame(found, ", ".join(f"`{name}` {kind}" for name, kind in [*keys, ("location", "string")]))


def _partition_location(spark: SparkSession, table: str, values: dict) -> str:
    spec = ", ".join("`{}`={}".format(k, "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'") for k, v in values.items())
    database, _, name = table.rpartition(".")
    within = f" IN {database}" if database else ""
    text = spark.sql(f"SHOW TABLE EXTENDED{within} LIKE '{name.strip('`')}' PARTITION ({spec})").first()["information"]
    return re.search(r"^Location: (.*)$", text, re.M).group(1)


def table_preview(spark: SparkSession, table: str, order: list[str], n: int = 100) -> DataFrame:
    return spark.table(table).orderBy(*order).limit(n)


def table_metadata(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {table}")


def upload_table(
    spark: SparkSession, path: str, table: str, fmt: str = "csv", schema: str | None = None,
    location: str | None = None, **options: str,
) -> DataFrame:
    """Load files as a table, kept in the warehouse or at ``location``; without a schema, CSV types are inferred."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv" and schema is None:
        options = {"inferSchema": "true", **options}
    if fmt == "csv":
        options = {"header": "true", **options}
    writer = reader.format(fmt).options(**options).load(path).write.mode("errorifexists")
    (writer.option("path", location) if location else writer).saveAsTable(table)
    return spark.table(table)


#: behind a table's name: the table that keeps its versions
VERSIONS = "__versions"
_VERSION = "version int, updated timestamp, position int, column string, type string, is_partition boolean"


def _beside(table: str) -> str:
    """The name of the table that keeps the versions."""
    database, dot, name = table.rpartition(".")
    return f"{database}{dot}`{name.strip('`')}{VERSIONS}`"


def record_version(spark: SparkSession, table: str, updated: datetime, location: str | None = None) -> int:
    """Keep the table's columns as its next version, unless they are those of the last one; gives the version's number, from 1.

    Versions lie in a table of their own beside it (in the warehouse, or at ``location``), one row per column, and are only ever
    added; their numbers follow the order of recording.
    """
    columns = [(i, c.name, c.dataType, bool(c.isPartition)) for i, c in enumerate(spark.catalog.listColumns(table))]
    last = 0
    if spark.catalog.tableExists(_beside(table)):
        known = spark.table(_beside(table))
        last = known.agg(F.max("version")).first()[0] or 0
        rows = known.filter(F.col("version") == last).select("position", "column", "type", "is_partition").collect()  # a table's columns
        if sorted(map(tuple, rows)) == columns:
            return last
    rows = spark.createDataFrame([(last + 1, updated, *c) for c in columns], _VERSION).coalesce(1)
    writer = rows.write.mode("append")
    (writer.option("path", location) if location else writer).saveAsTable(_beside(table))
    return last + 1


def table_versions(spark: SparkSession, table: str) -> DataFrame:
    """(version, updated, columns): one row per version."""
    shown = F.struct("position", F.concat_ws(" ", "column", "type").alias("shown"))
    listed = F.transform(F.array_sort(F.collect_list(shown)), lambda c: c["shown"])
    return spark.table(_beside(table)).groupBy("version", "updated").agg(F.array_join(listed, ", ").alias("columns"))


def version_changes(spark: SparkSession, table: str) -> DataFrame:
    """(version, column, change, before, after): columns added, removed and retyped from one version to the next."""
    stored = spark.table(_beside(table)).select("version", "column", "type")
    last = stored.agg(F.max("version").alias("last"))
    old = stored.select((F.col("version") + 1).alias("version"), "column", F.col("type").alias("before"))
    old = old.join(F.broadcast(last), F.col("version") <= F.col("last")).drop("last")  # one row
    both = old.join(stored.withColumnRenamed("type", "after"), ["version", "column"], "full")
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(F.col("before") != F.col("after"), "retyped")
    return both.select("version", "column", change.alias("change"), "before", "after").filter((F.col("version") > 1) & F.col("change").isNotNull())


def version_as_of(spark: SparkSession, table: str, moment: datetime) -> int | None:
    """The version that was in force at a moment; None before the first."""
    earlier = spark.table(_beside(table)).filter(F.col("updated") <= F.lit(moment))
    return earlier.agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, table: str, version: int) -> DataFrame:
    """The table's rows as a version names, orders and types its columns; a column that the table has no longer is NULL."""
    rows = spark.table(_beside(table)).filter(F.col("version") == version).orderBy("position").select("column", "type").collect()
    if not rows:
        raise ValueError(f"{table} has no version {version}")
    stored = spark.table(table)
    there = set(stored.columns)
    return stored.select(*[(F.col(f"`{r.column}`").try_cast(r.type) if r.column in there else F.lit(None).cast(r.type)).alias(r.column) for r in rows])


def analyze_table(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """Collect and show the catalog's own column statistics."""
    chosen = ", ".join(f"`{c}`" for c in columns) if columns else None
    target = f"FOR COLUMNS {chosen}" if chosen else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {target}")
    return spark.sql(f"DESCRIBE EXTENDED {table}")
