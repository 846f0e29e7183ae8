"""File and table queries: the given tables written out in other forms and read back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.checks import column_statistics
from tidemill.operators.objects import apply_copy_plan
from tidemill.plans.registry import Tables, money, query
from tidemill.session import qualified, scratch_path
from tidemill.sources import catalog, files, listing, sinks
from tidemill.sources.connectors import decode_topic


def _table_name(label: str) -> str:
    return f"tidemill_{label}_{uuid.uuid4().hex[:12]}"


@query(
    "select_object_csv",
    "SELECT event_type, count(*) AS n, min(event_id) AS least FROM events WHERE user_id < 50 GROUP BY 1",
)
def from_csv(t: Tables) -> DataFrame:
    """Gzipped CSV without a header, so the columns are positional."""
    path = scratch_path(t.spark, "csv")
    t.events.select("event_id", "user_id", "event_type").write.csv(path, compression="gzip")
    sql = "SELECT _3 AS event_type, count(*) AS n, min(CAST(_1 AS BIGINT)) AS least FROM s3object WHERE CAST(_2 AS INT) < 50 GROUP BY _3"
    return files.select_object(t.spark, path, sql, "csv", header=False)


@query("select_object_json", "SELECT event_type, sum(event_id)::BIGINT AS total FROM events GROUP BY 1")
def from_json(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    t.events.select("event_id", "event_type").write.json(path, compression="bzip2")
    sql = "SELECT event_type, sum(event_id) AS total FROM s3object GROUP BY event_type"
    return files.select_object(t.spark, path, sql, "json", schema="event_id bigint, event_type string")


@query("select_object_parquet", "SELECT p_brand, max(p_size) AS largest FROM part WHERE p_type = 'ECONOMY' GROUP BY 1")
def from_parquet(t: Tables) -> DataFrame:
    sql = "SELECT p_brand, max(p_size) AS largest FROM s3object WHERE p_type = 'ECONOMY' GROUP BY p_brand"
    return files.select_object(t.spark, f"{t.folder}/part.parquet", sql)


@query(
    "file_inventory",
    "SELECT DISTINCT 'event_type=' || event_type AS folder, CAST(1 AS BIGINT) AS files, true AS filled FROM events",
)
def written_files(t: Tables) -> DataFrame:
    """One file per event type, listed without reading it."""
    path = scratch_path(t.spark, "inventory")
    t.events.repartition("event_type").write.partitionBy("event_type").parquet(path)
    listed = files.file_inventory(t.spark, path, "*.parquet")
    return listed.groupBy(F.substring_index("key", "/", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), (F.min("size") > 0).alias("filled")
    )


@query(
    "folder_inventory",
    """
    SELECT DISTINCT 'event_type=' || event_type || '/ds=' || strftime(ts, '%Y-%m-%d') AS folder, CAST(1 AS BIGINT) AS files, true AS filled, true AS as_listed FROM events
    """,
)
def listed_by_tasks(t: Tables) -> DataFrame:
    """One file per event type and day, listed folder by folder in the tasks; ``as_listed``: the same sizes and times as in Spark's own listing."""
    path = scratch_path(t.spark, "folders")
    days = t.events.withColumn("ds", F.date_format("ts", "yyyy-MM-dd"))
    days.repartition("event_type", "ds").write.partitionBy("event_type", "ds").parquet(path)
    ours = listing.folder_inventory(t.spark, path, "*.parquet")
    other = files.file_inventory(t.spark, path, "*.parquet").select("key", F.struct("uri", "size", "updated").alias("other"))
    both = ours.join(other, "key", "full")
    return both.groupBy(F.substring_index("key", "/", 2).alias("folder")).agg(
        F.count("bucket").alias("files"), (F.min("size") > 0).alias("filled"), F.every(F.struct("uri", "size", "updated").eqNullSafe(F.col("other"))).alias("as_listed")
    )


@query(
    "datagen",
    """
    SELECT count(*) AS row_count, count(DISTINCT event_id) AS ids, min(event_id) AS least, max(event_id) AS greatest,
           8 AS text_length, CAST(1 AS BIGINT) AS sources FROM events
    """,
)
def generated(t: Tables) -> DataFrame:
    """As many generated rows as there are event ids."""
    last = t.events.agg(F.max("event_id")).first()[0]
    rows = files.datagen(t.spark, 0, last, 8)
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("id").alias("ids"), F.min("id").alias("least"),
        F.max("id").alias("greatest"), F.max(F.length("payload")).alias("text_length"), F.count_distinct("source").alias("sources"),
    )


@query("fixture_files", "SELECT event_id, event_type, value FROM events")
def fixtures(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "fixtures")
    t.events.select("event_id", "event_type", "value").write.json(path)
    return files.fixture_files(t.spark, path, "event_id bigint, event_type string, value double")


@query(
    "discover_schema",
    """
    SELECT * FROM (VALUES ('events', 'value', 'string', 'double', 'updated'), ('events', 'extra', 'int', NULL, 'updated'),
      ('old', 'a', 'int', NULL, 'deleted'), ('events', 'event_type', NULL, 'string', 'updated')) v("table", "column", old_type, new_type, change)
    UNION ALL SELECT DISTINCT 'priority_' || left(o_orderpriority, 1), 'o_clerk', NULL, 'string', 'created' FROM orders
    """,
)
def discovered(t: Tables) -> DataFrame:
    """Tables found below a folder (one for each priority that orders have), against a catalog that lags behind."""
    path = scratch_path(t.spark, "crawl")
    t.events.select("event_id", "event_type", "value").write.partitionBy("event_type").json(f"{path}/events")
    for (priority,) in t.orders.select("o_orderpriority").distinct().collect():
        own = t.orders.filter(F.col("o_orderpriority") == priority).select(F.concat(F.lit("clerk "), "o_orderkey").alias("o_clerk"))
        own.write.json(f"{path}/priority_{priority[0]}")
    found = files.discover_tables(t.spark, path, "json").drop("is_partition")
    known = t.spark.createDataFrame(
        [("events", "event_id", "bigint"), ("events", "value", "string"), ("events", "extra", "int"), ("old", "a", "int")],
        "table string, column string, type string",
    )
    return files.discover_schema(found, known)


@query(
    "discover_partitions",
    "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, CAST(1 AS BIGINT) AS files, true AS filled FROM events GROUP BY 1, 2",
)
def found_partitions(t: Tables) -> DataFrame:
    """Partitions read off the paths of written files."""
    path = scratch_path(t.spark, "parts")
    days = t.events.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    days.repartition("event_type", "day").write.partitionBy("event_type", "day").json(path)
    found = files.discover_partitions(t.spark, path)
    return found.select(F.col("values")["event_type"].alias("event_type"), F.col("values")["day"].alias("day"), "files", (F.col("size") > 0).alias("filled"))


@query(
    "object_head_files",
    """
    SELECT source, md5(array_to_string(string_split(string_agg(text, chr(10) ORDER BY doc_id), chr(10))[1:4], chr(10))) AS digest,
           CAST(sum(strlen(text) + 1) AS BIGINT) AS length FROM documents GROUP BY 1
    """,
)
def heads(t: Tables) -> DataFrame:
    """The first lines of the file that holds a source's texts; of a file no more than its first 64 KiB are read."""
    path = scratch_path(t.spark, "heads")
    t.documents.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "text").write.partitionBy("source").text(path)
    read = files.object_head(t.spark, path, lines=4)
    source = F.regexp_extract("path", "/source=([^/]*)/", 1)
    return read.select(source.alias("source"), F.md5(F.encode("head", "UTF-8")).alias("digest"), "length")


@query("upload_table", "SELECT c_mktsegment, count(*) AS customers, max(c_custkey) AS last FROM customer GROUP BY 1")
def uploaded(t: Tables) -> DataFrame:
    path, name = scratch_path(t.spark, "upload"), _table_name("upload")
    sinks.result_export(t.customer, path)
    table = catalog.upload_table(t.spark, path, name, location=scratch_path(t.spark, "table"))
    return table.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), F.max("c_custkey").cast("long").alias("last"))


@query("table_preview", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 100")
def preview(t: Tables) -> DataFrame:
    name = _table_name("preview")
    t.orders.createOrReplaceTempView(name)
    return catalog.table_preview(t.spark, name, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query(
    "table_versions",
    """
    SELECT v.version, v.shape, c.changes, count(o.o_orderkey) AS rows, sum(CASE WHEN v.version < 3 THEN o.o_custkey END)::BIGINT AS keys
    FROM orders o, (VALUES (1, 'o_orderkey bigint, o_custkey bigint'), (2, 'o_orderkey bigint, o_custkey bigint, note string'), (3, 'o_orderkey bigint, note string, rank int')) v(version, shape)
    JOIN (VALUES (1, ''), (2, 'added note'), (3, 'added rank,removed o_custkey')) c(version, changes) USING (version)
    GROUP BY 1, 2, 3
    """,
)
def versions(t: Tables) -> DataFrame:
    """A table whose columns change twice, with the versions recorded on the way; all rows as each version names them."""
    from datetime import datetime

    name, kept_at = _table_name("versions"), scratch_path(t.spark, "history")
    t.orders.select("o_orderkey", "o_custkey").write.option("path", scratch_path(t.spark, "versions")).saveAsTable(name)
    seen = []
    for day, change in enumerate((None, "ADD COLUMNS (note STRING)", None, "REPLACE"), 1):
        if change == "REPLACE":
            # the catalog's table is made anew over other files, as a rewrite does
            kept = t.spark.table(name).select("o_orderkey", "note", F.lit(1).alias("rank"))
            path = scratch_path(t.spark, "versions")
            kept.write.parquet(path)
            t.spark.sql(f"DROP TABLE {name}")
            t.spark.catalog.createTable(name, path, "parquet")
        elif change:
            t.spark.sql(f"ALTER TABLE {name} {change}")
        number = catalog.record_version(t.spark, name, datetime(2024, 1, day), kept_at)
        if number not in seen:
            seen.append(number)
            held = catalog.read_version(t.spark, name, number)
            keys = F.sum("o_custkey") if "o_custkey" in held.columns else F.lit(None)
            told = held.agg(F.count("o_orderkey").alias("rows"), keys.cast("long").alias("keys")).withColumn("version", F.lit(number))
            found = told if number == 1 else found.unionByName(told)
    changes = catalog.version_changes(t.spark, name).groupBy("version").agg(F.array_sort(F.collect_list(F.concat_ws(" ", "change", "column"))).alias("c"))
    listed = catalog.table_versions(t.spark, name).join(changes, "version", "left")
    return listed.join(found, "version").select(
        "version", F.col("columns").alias("shape"), F.coalesce(F.array_join("c", ","), F.lit("")).alias("changes"), "rows", "keys"
    )


@query("result_export", "SELECT doc_id, md5(text) AS digest FROM documents")
def exported(t: Tables) -> DataFrame:
    """Whole texts, line breaks and quotes included, through CSV and back."""
    path = scratch_path(t.spark, "export")
    sinks.result_export(t.documents.select("doc_id", "text"), path)
    read = t.spark.read.schema("doc_id bigint, text string").csv(path, header=True, multiLine=True, escape='"')
    return read.select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("digest"))


@query(
    "full_refresh",
    "SELECT 'COMPLETED' AS status, count(*) AS rows_ingested, count(*) AS stored FROM orders",
)
def refreshed(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "refresh")
    report = sinks.full_refresh(t.orders, path)
    stored = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored"))
    return stored.select(F.lit(report["status"]).alias("status"), F.lit(report["rows_ingested"]).cast("long").alias("rows_ingested"), "stored")


@query(
    "incremental_recompute",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS ds, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 2 ELSE 1 END AS version,
           count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2
    """,
)
def recomputed(t: Tables) -> DataFrame:
    """All days once, then only those from a high-water mark on; the later run replaces just its days."""
    from datetime import datetime

    from tidemill.operators.experiments import high_water

    path = scratch_path(t.spark, "recompute")

    def days(events: DataFrame, version: int) -> DataFrame:
        return events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("ds")).agg(
            F.lit(version).alias("version"), F.count(F.lit(1)).alias("events"), F.sum(money("value")).cast("double").alias("total")
        )

    sinks.incremental_recompute(days(high_water(t.events, "ts", None), 1), path)
    sinks.incremental_recompute(days(high_water(t.events, "ts", datetime(2024, 1, 20, 15)), 2), path)
    stored = t.spark.read.parquet(path)
    return stored.select(F.col("ds").cast("string").alias("ds"), "version", "events", "total")


@query(
    "partition_filter",
    """
    SELECT DISTINCT o_orderpriority, year(o_orderdate)::INT AS y, 'y=' || year(o_orderdate) AS folder FROM orders
    WHERE year(o_orderdate) >= 1996 AND o_orderpriority <> '5-LOW'
    UNION ALL SELECT DISTINCT o_orderpriority, 2050, 'empty' FROM orders WHERE o_orderpriority <> '5-LOW'
    """,
)
def partitions(t: Tables) -> DataFrame:
    name = _table_name("partitions")
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    spread = rows.repartition("o_orderpriority", "y")
    spread.write.partitionBy("o_orderpriority", "y").option("path", scratch_path(t.spark, "part")).saveAsTable(name)
    for row in t.orders.select("o_orderpriority").distinct().collect():  # one empty partition each, kept elsewhere
        place = f"{scratch_path(t.spark, 'none')}/empty"
        t.spark.sql(f"ALTER TABLE {name} ADD PARTITION (o_orderpriority='{row[0]}', y=2050) LOCATION '{place}'")
    found = catalog.partition_filter(t.spark, name, "y >= 1996 AND o_orderpriority <> '5-LOW'")
    return found.select("o_orderpriority", "y", F.substring_index("location", "/", -1).alias("folder"))


@query(
    "partition_maintenance",
    """
    SELECT o_orderstatus, count(*) AS orders, 1 AS failed_actions FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
    UNION ALL SELECT 'X', count(*), 1 FROM orders WHERE o_orderstatus = 'F'
    """,
)
def maintained(t: Tables) -> DataFrame:
    """One partition added from elsewhere, one dropped, one drop refused."""
    name, extra = _table_name("maintenance"), scratch_path(t.spark, "extra")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    rows.write.partitionBy("o_orderstatus").option("path", scratch_path(t.spark, "kept")).saveAsTable(name)
    rows.filter(F.col("o_orderstatus") == "F").select("o_orderkey").write.parquet(extra)
    report = sinks.partition_maintenance(
        t.spark, name,
        [("add", {"o_orderstatus": "X"}, extra), ("drop", {"o_orderstatus": "P"}, None), ("drop", {"o_orderstatus": "none"}, None)],
    )
    failed = report.filter(F.col("error").isNotNull()).count()
    return t.spark.table(name).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.lit(failed).alias("failed_actions")
    )


@query("bulk_copy", "SELECT event_type, count(*) AS events, max(event_id) AS last FROM events GROUP BY 1")
def copied(t: Tables) -> DataFrame:
    """Written files copied by a plan, then read from where they went."""
    source, target = scratch_path(t.spark, "from"), scratch_path(t.spark, "to")
    t.events.write.parquet(source)
    listed = files.file_inventory(t.spark, source, "*.parquet")
    root = files.uri_of(F.lit(qualified(t.spark, target)))
    plan = listed.select(F.col("uri").alias("source_uri"), F.concat_ws("/", root, "key").alias("target_uri"))
    failed = apply_copy_plan(plan).filter(F.col("error").isNotNull()).count()
    if failed:
        raise RuntimeError(f"{failed} copies failed")
    return t.spark.read.parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last")
    )


@query(
    "bounded_topic_slice",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 4 AS partition FROM events WHERE ts >= TIMESTAMP '2024-01-15'",
)
def topic(t: Tables) -> DataFrame:
    """Events as topic records from a timestamp on, decoded like the topic source does."""
    value = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(","), F.substring("props", F.lit(2), F.length("props")))
    raw = t.events.select(
        value.cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("event_id") % 4).alias("partition"), F.col("event_id").alias("offset"),
    ).filter(F.col("timestamp") >= F.lit("2024-01-15 00:00:00").cast("timestamp"))
    return decode_topic(raw, "event_id bigint, k bigint").select("event_id", "k", "partition")


@query(
    "parse_error_policy",
    """
    SELECT event_id, event_id % 10 = 3 AS rejected, CASE WHEN event_id % 10 <> 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events
    """,
)
def lenient(t: Tables) -> DataFrame:
    text = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("<"), "props")).otherwise(F.col("props"))
    rows = files.parse_json_lenient(t.events.select("event_id", text.alias("text")), "text", "k bigint")
    return rows.select("event_id", "rejected", F.col("parsed.k").alias("k"))


@query("parse_strict", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def strict(t: Tables) -> DataFrame:
    return files.parse_json_strict(t.events, "props", "k bigint").select("event_id", F.col("parsed.k").alias("k"))


@query(
    "not_null_policy",
    "SELECT event_id, event_type FROM events WHERE event_type <> 'error' AND user_id % 10 <> 0",
)
def not_null(t: Tables) -> DataFrame:
    return files.not_null_policy(_holes(t), ["kind", "user"], "drop").select("event_id", F.col("kind").alias("event_type"))


@query(
    "not_null_rejects",
    """
    SELECT event_id, concat_ws(',', CASE WHEN event_type = 'error' THEN 'kind' END, CASE WHEN user_id % 10 = 0 THEN 'user' END) AS null_columns
    FROM events WHERE event_type = 'error' OR user_id % 10 = 0
    """,
)
def rejects(t: Tables) -> DataFrame:
    rows = files.not_null_rejects(_holes(t), ["kind", "user"])
    return rows.select("event_id", F.array_join("null_columns", ",").alias("null_columns"))


def _holes(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user"),
    )


@query(
    "catalog_scan",
    """
    SELECT 'orders' AS "table", 'o_custkey' AS "column", 'bigint' AS type, count(o_custkey) AS filled FROM orders
    UNION ALL SELECT 'customer', 'c_custkey', 'bigint', count(c_custkey) FROM customer
    UNION ALL SELECT 'lineitem', 'l_suppkey', 'bigint', count(l_suppkey) FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_partkey', 'bigint', count(l_partkey) FROM lineitem
    UNION ALL SELECT 'part', 'p_partkey', 'bigint', count(p_partkey) FROM part
    """,
)
def scanned(t: Tables) -> DataFrame:
    """Tables of a catalog found by a name pattern, their columns by keyword, and how far each column is filled."""
    database = _table_name("catalog")
    t.spark.sql(f"CREATE DATABASE {database}")
    for name in ("orders", "customer", "lineitem", "part", "nation"):
        t.spark.sql(f"CREATE TABLE {database}.{name} USING parquet OPTIONS (path '{t.folder}/{name}.parquet')")
    tables = catalog.catalog_tables(t.spark, database, "^[clop]").select(F.col("tableName").alias("table"))
    keyed = [catalog.catalog_search(t.spark, word, [database]) for word in ("custkey", "l_suppkey", "partkey")]
    columns = reduce(DataFrame.unionByName, keyed).join(tables, "table", "left_semi")
    filled = []
    for name in ("orders", "customer", "lineitem", "part"):
        rows = t.spark.table(f"{database}.{name}")
        counts = column_statistics(rows, [c for c in rows.columns if c.endswith("key")], approximate=True)
        filled.append(counts.select(F.lit(name).alias("table"), "column", (F.col("rows") - F.col("nulls")).alias("filled")))
    return columns.join(reduce(DataFrame.unionByName, filled), ["table", "column"]).select("table", "column", "type", "filled")
