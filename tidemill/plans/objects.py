"""Object-store queries: a page is an object, its URL without the scheme the key, its HTML the content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.paths import bucket_of, is_prefix, key_of, name_of
from tidemill.operators import objects
from tidemill.plans.registry import Tables, query
from tidemill.sources.files import cat_text, head_text

_OBJECTS = """
    WITH o AS (SELECT 'pages' AS bucket, page_id, regexp_extract(url, '^[a-z]+://(.*)$', 1) AS key,
                      length(html) AS size FROM pages)
"""


def _objects(t: Tables) -> DataFrame:
    return t.pages.select(
        F.lit("pages").alias("bucket"), "page_id", F.regexp_extract("url", "^[a-z]+://(.*)$", 1).alias("key"),
        F.length("html").cast("long").alias("size"),
    )


@query(
    "object_inventory",
    _OBJECTS + "SELECT key, size FROM o WHERE starts_with(key, 'blog.') AND NOT regexp_matches(key, '/$')",
)
def inventory(t: Tables) -> DataFrame:
    listed = _objects(t).withColumn("is_directory", is_prefix(F.col("key")))
    return objects.inventory_under(listed, "pages", "blog.").select("key", "size")


@query(
    "level_listing",
    _OBJECTS + """
    , r AS (SELECT key, size, strpos(key, '/') AS slash FROM o)
    SELECT DISTINCT substr(key, 1, slash) AS key, CAST(NULL AS BIGINT) AS size, true AS is_prefix FROM r WHERE slash > 0
    UNION ALL SELECT key, size, false FROM r WHERE slash = 0
    """,
)
def level(t: Tables) -> DataFrame:
    return objects.level_listing(_objects(t), "pages")


@query(
    "level_listing_limited",
    """
    WITH r AS (SELECT 'all/' || page_id || CASE WHEN page_id % 3 = 0 THEN '/x' ELSE '' END AS key, length(html) AS size FROM pages),
    s AS (SELECT key, size, substr(key, 5) AS rest FROM r),
    l AS (SELECT 'all/' || split_part(rest, '/', 1) || '/' AS key, NULL AS size, true AS is_prefix FROM s WHERE contains(rest, '/')
          UNION ALL SELECT key, size, false FROM s WHERE NOT contains(rest, '/'))
    SELECT * FROM l ORDER BY is_prefix DESC, key LIMIT 100
    """,
)
def limited(t: Tables) -> DataFrame:
    nested = F.when(F.col("page_id") % 3 == 0, "/x").otherwise("")
    listed = _objects(t).withColumn("key", F.concat(F.lit("all/"), F.col("page_id").cast("string"), nested))
    return objects.level_listing(listed, "pages", "all/", limit=100, limit_scope="all")


@query(
    "object_stat",
    """
    SELECT doc_id, regexp_extract(url, '^[a-z]+://(.*)$', 1) AS key, length(html) AS size, page_id IS NOT NULL AS found
    FROM documents LEFT JOIN pages ON page_id = doc_id
    """,
)
def stat(t: Tables) -> DataFrame:
    ids = _objects(t).select(F.col("page_id").cast("string").alias("key"), "bucket", "size", F.col("key").alias("path"))
    wanted = t.documents.select(F.lit("pages").alias("bucket"), F.col("doc_id").cast("string").alias("key"))
    rows = objects.object_stat(ids, wanted)
    return rows.select(F.col("key").cast("long").alias("doc_id"), F.col("path").alias("key"), "size", "found")


@query(
    "object_head",
    """
    SELECT doc_id, array_to_string(list_slice(string_split(text, chr(10)), 1, 10), chr(10)) AS head FROM documents
    """,
)
def head(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", head_text(F.encode("text", "UTF-8")).alias("head"))


@query(
    "object_cat",
    "SELECT page_id, md5(html) AS digest FROM pages",
)
def cat(t: Tables) -> DataFrame:
    content = F.encode("html", "UTF-8")
    return t.pages.select("page_id", F.md5(F.encode(cat_text(content, F.octet_length("html")), "UTF-8")).alias("digest"))


@query(
    "sync_diff",
    """
    WITH s AS (SELECT page_id, regexp_extract(url, '^[a-z]+://(.*)$', 1) AS relative, length(html) AS size FROM pages),
    t AS (SELECT 'backup/' || relative AS key, size + CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END AS size
          FROM s WHERE page_id % 7 <> 0)
    SELECT relative, 'backup/' || relative AS key, s.size FROM s
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.key = 'backup/' || s.relative AND t.size = s.size)
    """,
)
def diff(t: Tables) -> DataFrame:
    source = _objects(t).select("page_id", F.col("key").alias("relative"), "size")
    grown = F.when(F.col("page_id") % 5 == 0, 1).otherwise(0)
    target = source.filter(F.col("page_id") % 7 != 0).select(
        F.concat(F.lit("backup/"), "relative").alias("key"), (F.col("size") + grown).alias("size")
    )
    return objects.sync_diff(source, target, "backup//").select("relative", "key", "size")


@query(
    "prefix_rollup",
    _OBJECTS + """
    , p AS (SELECT key, size, string_split(key, '/') AS parts FROM o),
    l AS (SELECT '' AS prefix, size FROM p
          UNION ALL SELECT parts[1] || '/', size FROM p WHERE len(parts) > 1
          UNION ALL SELECT parts[1] || '/' || parts[2] || '/', size FROM p WHERE len(parts) > 2)
    SELECT 'pages' AS bucket, prefix, count(*) AS objects, CAST(sum(size) AS BIGINT) AS bytes FROM l GROUP BY 1, 2
    """,
)
def rollup(t: Tables) -> DataFrame:
    return objects.prefix_rollup(_objects(t), depth=2)


@query(
    "prefix_overlap",
    _OBJECTS + """
    , src AS (SELECT DISTINCT split_part(key, '/', 1) AS key FROM o WHERE page_id % 3 = 0
              UNION SELECT DISTINCT key FROM o WHERE page_id % 4 = 1 AND regexp_matches(key, '/$')),
    dst AS (SELECT page_id, key FROM o)
    SELECT 'pages' AS bucket, src.key AS source_key, dst.key AS target_key, page_id FROM src JOIN dst
    ON dst.key = src.key OR starts_with(dst.key, CASE WHEN src.key = '' OR ends_with(src.key, '/') THEN src.key ELSE src.key || '/' END)
    """,
)
def overlap(t: Tables) -> DataFrame:
    listed = _objects(t)
    hosts = listed.filter(F.col("page_id") % 3 == 0).select("bucket", F.substring_index("key", "/", 1).alias("key"))
    folders = listed.filter((F.col("page_id") % 4 == 1) & F.col("key").endswith("/")).select("bucket", "key")
    return objects.prefix_overlap(hosts.unionByName(folders).distinct(), listed, "page_id")


@query(
    "delete_batches",
    """
    SELECT o_orderkey, (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // 1000 AS batch FROM orders
    """,
)
def batches(t: Tables) -> DataFrame:
    listed = t.orders.select("o_custkey", "o_orderkey")
    return objects.delete_batches(listed, ["o_custkey", "o_orderkey"]).select("o_orderkey", "batch")


@query(
    "path_parts",
    """
    WITH u AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS bucket,
                      regexp_extract(url, '^[a-z]+://[^/]*/(.*)$', 1) AS key FROM pages)
    SELECT page_id, bucket, key, key = '' OR ends_with(key, '/') AS is_prefix,
           string_split(rtrim(key, '/'), '/')[-1] AS name FROM u
    """,
)
def parts(t: Tables) -> DataFrame:
    rows = t.pages.select("page_id", bucket_of(F.col("url")).alias("bucket"), key_of(F.col("url")).alias("key"))
    return rows.select("*", is_prefix(F.col("key")).alias("is_prefix"), name_of(F.col("key")).alias("name"))
