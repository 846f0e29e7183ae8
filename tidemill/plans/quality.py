"""Row shaping, set comparison and data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import sha256_text
from tidemill.operators import checks, profiles, rows
from tidemill.plans.registry import Tables, query
from tidemill.session import scratch_path


def _types(t: Tables, keep: F.Column) -> DataFrame:
    return t.events.filter(keep).select("event_type", "user_id")


@query("curate_columns", "SELECT s_name, CAST(NULL AS VARCHAR) AS nickname, s_suppkey FROM supplier")
def curated(t: Tables) -> DataFrame:
    return rows.curate_columns(t.supplier, ["s_name", "nickname", "s_suppkey"])


@query(
    "union_of_keys",
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS phone FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, 'none' FROM supplier
    """,
)
def unions(t: Tables) -> DataFrame:
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    firms = t.supplier.select(F.lit("none").alias("phone"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return rows.union_of_keys(people, firms)


@query(
    "property_rows",
    """
    SELECT p_partkey, 'p_name' AS property, p_name AS value FROM part
    UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 'tags', '["' || p_brand || '"]' FROM part
    UNION ALL SELECT p_partkey, 'gone', '' FROM part
    """,
)
def properties(t: Tables) -> DataFrame:
    parts = t.part.select(
        "p_partkey", "p_name", "p_size", F.array("p_brand").alias("tags"), F.lit(None).cast("string").alias("gone")
    )
    return rows.property_rows(parts, ["p_partkey"])


@query("select_fields", "SELECT o_orderkey, o_orderstatus FROM orders")
def fields(t: Tables) -> DataFrame:
    return rows.select_fields(t.orders, "o_orderkey, o_orderstatus")


@query(
    "rows_to_text",
    """
    SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","even":' || (event_id % 2 = 0) || ',"none":null}' AS line FROM events
    """,
)
def as_json(t: Tables) -> DataFrame:
    even = (F.col("event_id") % 2 == 0).alias("even")
    return rows.rows_to_json(t.events.select("event_id", "event_type", even, F.lit(None).cast("string").alias("none")))


@query(
    "rows_to_text_csv",
    """
    SELECT event_id || ',' || event_type || ',"' || replace(props, '"', '""') || '",' ||
      CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END || ',"{""id"": ' || event_id || ', ""even"": ' || (event_id % 2 = 0) ||
      ', ""gone"": null, ""tags"": [""' || event_type || '"", null]}",' AS line FROM events
    """,
)
def as_csv(t: Tables) -> DataFrame:
    even = (F.col("event_id") % 2 == 0).alias("even")
    tags = F.array("event_type", F.lit(None)).alias("tags")
    nested = F.struct(F.col("event_id").alias("id"), even, F.lit(None).cast("string").alias("gone"), tags).alias("nested")
    return rows.rows_to_csv(t.events.select("event_id", "event_type", "props", even, nested, F.lit(None).cast("string").alias("none")))


@query(
    "missing_targets",
    """
    SELECT DISTINCT user_id FROM events WHERE event_type = 'signup'
    EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 60
    """,
)
def missing(t: Tables) -> DataFrame:
    left = t.events.filter(F.col("event_type") == "signup")
    right = t.events.filter((F.col("event_type") == "purchase") & (F.col("value") > 60))
    return rows.missing_targets(left, right, "user_id")


_COUNTS = """
    WITH l AS (SELECT event_type, user_id, count(*) AS n FROM events WHERE event_id % 3 <> 0 GROUP BY 1, 2),
    r AS (SELECT event_type, user_id, count(*) AS n FROM events WHERE event_id % 3 <> 1 GROUP BY 1, 2),
    b AS (SELECT event_type, user_id, coalesce(l.n, 0) AS left_rows, coalesce(r.n, 0) AS right_rows
          FROM l FULL JOIN r USING (event_type, user_id))
"""


@query("same_multiset", _COUNTS + "SELECT * FROM b WHERE left_rows <> right_rows")
def multiset(t: Tables) -> DataFrame:
    third = F.col("event_id") % 3
    return checks.same_multiset(_types(t, third != 0), _types(t, third != 1))


@query(
    "same_multiset_digests",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, CAST(1 AS BIGINT) AS left_rows, CAST(0 AS BIGINT) AS right_rows FROM lineitem WHERE l_orderkey % 997 = 3 AND l_linenumber = 1
    UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey + 1, 0, 1 FROM lineitem WHERE l_orderkey % 997 = 3 AND l_linenumber = 1
    UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, 1, 2 FROM lineitem WHERE l_orderkey % 1009 = 5 AND NOT (l_orderkey % 997 = 3 AND l_linenumber = 1)
    """,
)
def multiset_digests(t: Tables) -> DataFrame:
    """All shipments against a copy in which a few are changed and a few are there twice; only their ranges are compared."""
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    changed = (F.col("l_orderkey") % 997 == 3) & (F.col("l_linenumber") == 1)
    copy = items.withColumn("l_suppkey", F.when(changed, F.col("l_suppkey") + 1).otherwise(F.col("l_suppkey")))
    copy = copy.unionByName(items.filter((F.col("l_orderkey") % 1009 == 5) & ~changed))
    return checks.same_multiset_by_digests(items, copy)


@query(
    "same_set",
    _COUNTS + """
    SELECT event_type, user_id, least(left_rows, 1) AS left_rows, least(right_rows, 1) AS right_rows FROM b
    WHERE least(left_rows, 1) <> least(right_rows, 1)
    """,
)
def sets(t: Tables) -> DataFrame:
    third = F.col("event_id") % 3
    return checks.same_set(_types(t, third != 0), _types(t, third != 1))


@query(
    "ordered_dedupe",
    "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2",
)
def dedupe(t: Tables) -> DataFrame:
    listed = t.events.select("user_id", "event_type", "event_id")
    return rows.ordered_dedupe(listed, ["user_id", "event_type"], ["event_id"])


@query(
    "union_levels",
    """
    SELECT DISTINCT split_part(p_brand, '#', 1) || '/' AS key, true AS is_prefix FROM part
    UNION ALL SELECT p_name || '-' || p_partkey, false FROM part
    """,
)
def levels(t: Tables) -> DataFrame:
    prefixes = t.part.select(F.concat(F.substring_index("p_brand", "#", 1), F.lit("/")).alias("key"))
    leaves = t.part.select(F.concat_ws("-", "p_name", F.col("p_partkey").cast("string")).alias("key"))
    return rows.union_levels(prefixes, leaves)


@query(
    "contains_rows",
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (
      SELECT 1 FROM customer WHERE CAST(c_custkey AS VARCHAR) = CAST(o_custkey AS VARCHAR) AND c_acctbal > 0)
    """,
)
def contained(t: Tables) -> DataFrame:
    actual = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").cast("string").alias("o_custkey"))
    return rows.contains_rows(actual, t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"])


@query(
    "rows_equal",
    """
    WITH l AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS position, event_type AS cell FROM events),
    r AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS position,
                 CASE WHEN event_id % 50 = 7 THEN 'changed' ELSE event_type END AS cell FROM events WHERE event_id % 5000 <> 4321)
    SELECT position, l.cell AS left_cell, r.cell AS right_cell FROM l FULL JOIN r USING (position)
    WHERE l.cell IS DISTINCT FROM r.cell
    """,
)
def ordered_equal(t: Tables) -> DataFrame:
    left = t.events.select("ts", "event_id", "event_type")
    changed = F.when(F.col("event_id") % 50 == 7, "changed").otherwise(F.col("event_type"))
    right = left.filter(F.col("event_id") % 5000 != 4321).withColumn("event_type", changed)
    found = rows.rows_equal(left, right, ["ts", "event_id"], ["ts", "event_id"], ["event_type"])
    return found.select("position", F.col("left_cells")[0].alias("left_cell"), F.col("right_cells")[0].alias("right_cell"))


@query(
    "resolve_unique",
    """
    WITH n AS (SELECT p_name, count(*) AS matches, min(p_partkey) AS id FROM part WHERE p_size < 4 GROUP BY 1)
    SELECT d.p_name, coalesce(matches, 0) AS matches, CASE WHEN matches = 1 THEN id END AS resolved_id,
      CASE WHEN matches IS NULL THEN 'no match' WHEN matches = 1 THEN 'ok' ELSE 'several matches' END AS verdict
    FROM (SELECT DISTINCT p_name FROM part) d LEFT JOIN n USING (p_name)
    """,
)
def resolved(t: Tables) -> DataFrame:
    candidates = t.part.filter(F.col("p_size") < 4).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return rows.resolve_unique(candidates, t.part.select("p_name").distinct(), {"p_name": "name"})


@query(
    "scope_prefix",
    "SELECT url FROM pages WHERE starts_with(url, 'https://blog') OR starts_with(url, 'http://www')",
)
def scoped(t: Tables) -> DataFrame:
    return rows.scope_prefix(t.pages.select("url"), "url", ["https://blog", "http://www"])


@query(
    "scope_report",
    """
    SELECT count(*) FILTER (WHERE starts_with(url, 'https://')) AS shown,
           count(*) FILTER (WHERE NOT starts_with(url, 'https://')) AS hidden FROM pages
    """,
)
def scope_counts(t: Tables) -> DataFrame:
    return rows.scope_report(t.pages, "url", ["https://"])


@query("id_regex", "SELECT page_id, url FROM pages WHERE regexp_matches(url, 'blog\\..*[05]$')")
def by_regex(t: Tables) -> DataFrame:
    return rows.id_regex(t.pages.select("page_id", "url"), "url", r"blog\..*[05]$")


@query("count_by", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def counted(t: Tables) -> DataFrame:
    return checks.count_by(t.events, "event_type")


@query(
    "duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def repeated(t: Tables) -> DataFrame:
    return checks.duplicates(t.lineitem, "l_orderkey", "l_linenumber")


_COLUMNS = {"o_orderkey": "o_orderkey", "status": "nullif(o_orderstatus, 'P')", "o_orderpriority": "o_orderpriority"}


@query(
    "column_statistics",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(*) AS rows, count(*) - count({e}) AS nulls, count(DISTINCT {e}) AS distinct_values,
            CAST(min({e}) AS VARCHAR) AS min_value, CAST(max({e}) AS VARCHAR) AS max_value,
            sum(length(CAST({e} AS VARCHAR))) / count({e}) AS avg_length, CAST(max(length(CAST({e} AS VARCHAR))) AS INTEGER) AS max_length FROM orders"""
        for name, e in _COLUMNS.items()
    ),
)
def described(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return checks.column_statistics(orders, list(_COLUMNS))


@query(
    "column_statistics_one_pass",
    """
    SELECT 'o_orderstatus' AS "column", count(*) AS rows, CAST(0 AS BIGINT) AS nulls, min(o_orderstatus) AS min_value, max(o_orderstatus) AS max_value,
      count(DISTINCT o_orderstatus) AS exact, true AS near FROM orders
    UNION ALL SELECT 'o_custkey', count(*), 0, CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR), count(DISTINCT o_custkey), true FROM orders
    """,
)
def described_once(t: Tables) -> DataFrame:
    """The sketch's distinct count next to the exact one: it stays within three times its standard error of 5 %."""
    names = ["o_orderstatus", "o_custkey"]
    sketch = checks.column_statistics(t.orders, names, approximate=True)
    exact = checks.column_statistics(t.orders, names).select("column", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.15 * F.col("exact")
    return sketch.join(exact, "column").select("column", "rows", "nulls", "min_value", "max_value", "exact", near.alias("near"))


_PROFILED = ["o_orderkey", "o_orderstatus", "o_orderdate", "clerk"]


@query(
    "profile_after_append",
    """
    WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, nullif(o_custkey % 9, 4) AS clerk, year(o_orderdate) AS y FROM orders),
    v AS (SELECT 'o_orderkey' AS "column", CAST(o_orderkey AS VARCHAR) AS v, o_orderkey AS n FROM o
          UNION ALL SELECT 'o_orderstatus', o_orderstatus, NULL FROM o UNION ALL SELECT 'o_orderdate', CAST(o_orderdate AS VARCHAR), NULL FROM o
          UNION ALL SELECT 'clerk', CAST(clerk AS VARCHAR), clerk FROM o),
    s AS (SELECT count(DISTINCT y) FILTER (WHERE y < 1998) AS first_read, count(DISTINCT y) FILTER (WHERE y >= 1998) + 1 AS then_read FROM o)
    SELECT "column", count(*) AS rows, count(*) - count(v) AS nulls, CASE WHEN count(n) > 0 THEN CAST(min(n) AS VARCHAR) ELSE min(v) END AS min_value,
      CASE WHEN count(n) > 0 THEN CAST(max(n) AS VARCHAR) ELSE max(v) END AS max_value, sum(length(v)) / count(v) AS avg_length,
      CAST(max(length(v)) AS INTEGER) AS max_length, true AS near, any_value(first_read) AS first_read, any_value(then_read) AS then_read FROM v, s GROUP BY 1
    """,
)
def profiled(t: Tables) -> DataFrame:
    """Orders by year: profiled without the last years and part of the first, then brought up to date from the new and changed years alone.

    ``near``: the distinct count is within 6 % of the exact one, and between 46 and 54 % of the values lie below the middle cut or reach up to it.
    """
    path, states = scratch_path(t.spark, "profiled"), scratch_path(t.spark, "profiles")
    clerk = F.nullif(F.col("o_custkey") % 9, F.lit(4)).alias("clerk")
    orders = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), clerk, F.year("o_orderdate").alias("y"))
    late = (F.col("y") >= 1998) | ((F.col("y") == 1995) & (F.col("o_orderkey") % 2 == 1))
    read = []
    for part in (orders.filter(~late), orders.filter(late)):
        part.repartition("y", F.col("o_orderkey") % 8).write.mode("append").partitionBy("y").parquet(path)
        read.append(profiles.refresh_profiles(t.spark, path, states, _PROFILED, ["y"]))
    merged = profiles.merge_profiles(profiles.stored_profiles(t.spark, path, states, _PROFILED, ["y"]))
    merged = merged.withColumn("cut", F.get("quantiles", F.lit(1)))
    exact = checks.column_statistics(orders, _PROFILED).select("column", F.col("distinct_values").alias("exact"))
    pairs = F.explode(F.create_map(*[x for c in _PROFILED for x in (F.lit(c), F.col(c).cast("string"))])).alias("column", "v")
    cuts = F.broadcast(merged.filter("cut IS NOT NULL").select("column", "cut"))  # one row per column
    less, same = _below(F.col("v"), F.col("cut")), F.col("v") == F.col("cut")
    ranks = orders.select(pairs).filter("v IS NOT NULL").join(cuts, "column").groupBy("column").agg(
        (F.count_if(less) / F.count(F.lit(1))).alias("below"), (F.count_if(less | same) / F.count(F.lit(1))).alias("upto")
    )
    near = (F.abs(F.col("distinct_values") - F.col("exact")) <= 0.06 * F.col("exact")) & F.coalesce((F.col("below") <= 0.54) & (F.col("upto") >= 0.46), F.col("cut").isNull())
    told = merged.join(exact, "column").join(ranks, "column", "left")
    return told.select(
        "column", "rows", "nulls", "min_value", "max_value", "avg_length", "max_length", near.alias("near"),
        F.lit(read[0]).cast("long").alias("first_read"), F.lit(read[1]).cast("long").alias("then_read"),
    )


def _below(value: F.Column, cut: F.Column) -> F.Column:
    """Texts of numbers by their numbers, dates by their spelling."""
    number = value.try_cast("double")
    return F.when(number.isNotNull(), number < cut.try_cast("double")).otherwise(value < cut)


@query(
    "text_expectations",
    r"""
    WITH p AS (SELECT * FROM (VALUES ('^[A-Z]', 'required'), ('no such text', 'required'), ('(?i)token\s*=', 'forbidden'),
               ('@@@@', 'forbidden')) v(pattern, kind)),
    m AS (SELECT pattern, kind, count(*) FILTER (WHERE regexp_matches(text, '(?m)' || pattern)) AS matches FROM p, documents GROUP BY 1, 2)
    SELECT *, CASE kind WHEN 'required' THEN matches > 0 ELSE matches = 0 END AS passed FROM m
    """,
)
def expectations(t: Tables) -> DataFrame:
    return checks.text_expectations(
        t.documents, "text", required=["^[A-Z]", "no such text"], forbidden=[r"(?i)token\s*=", "@@@@"]
    )


@query(
    "manifest_check",
    r"""
    SELECT doc_id || '.sql' AS subject, 'invalid query entry' AS violation FROM documents WHERE doc_id % 50 = 3
    UNION ALL SELECT doc_id || '.sql', 'query file is missing' FROM documents WHERE doc_id % 50 = 5
    UNION ALL SELECT doc_id || '.sql', 'checksum mismatch' FROM documents WHERE doc_id % 50 = 7
    UNION ALL SELECT doc_id || '.sql', 'file is not in the manifest' FROM documents WHERE doc_id % 50 = 9
    UNION ALL SELECT doc_id || '.sql', 'omitted ''e''' FROM documents WHERE doc_id % 50 NOT IN (3, 5, 9) AND NOT contains(text, 'e')
    UNION ALL SELECT doc_id || '.json', 'source retained a secret word' FROM documents
      WHERE regexp_matches(text, '(?i)(password|authorization|access[_-]?token|api[_-]?key|clientsecret)')
    UNION ALL SELECT 'manifest', 'total was ' || count(*) FROM documents WHERE doc_id % 50 <> 9
    UNION ALL SELECT 'manifest', 'succeeded was ' || count(*) FROM documents WHERE doc_id % 50 NOT IN (3, 9)
    UNION ALL SELECT 'files', 'no file has ''#no such word#'''
    """,
)
def manifest(t: Tables) -> DataFrame:
    """Planted faults, by the rest modulo 50: 3 failed entry, 5 no file, 7 wrong digest, 9 no entry."""
    rest = F.col("doc_id") % 50
    file = F.concat(F.col("doc_id").cast("string"), F.lit(".sql")).alias("file")
    entries = t.documents.filter(rest != 9).select(
        file, F.lit("sql").alias("language"), F.when(rest == 3, "failed").otherwise("ok").alias("status"),
        F.when(rest == 7, F.lit("0")).otherwise(sha256_text(F.col("text"))).alias("sha256"),
    )
    files = t.documents.filter(rest != 5).select(file, "text")
    sources = t.documents.select(F.concat(F.col("doc_id").cast("string"), F.lit(".json")).alias("file"), "text")
    return checks.manifest_check(
        entries, files, sources, expected_count=-1, language="sql", required_text=["e"], required_any=["a", "#no such word#"]
    )


@query(
    "content_equal",
    """
    SELECT page_id, sha256(html) AS left_sha256, sha256(html || 'x') AS right_sha256 FROM pages WHERE page_id % 9 = 2
    UNION ALL SELECT page_id, sha256(html), NULL FROM pages WHERE page_id % 9 = 4
    """,
)
def contents(t: Tables) -> DataFrame:
    rest = F.col("page_id") % 9
    copy = t.pages.filter(rest != 4).withColumn("html", F.when(rest == 2, F.concat("html", F.lit("x"))).otherwise(F.col("html")))
    return checks.content_equal(t.pages, copy, "page_id", "html")


@query(
    "content_equal_ranges",
    """
    SELECT page_id, sha256(html) AS left_sha256, sha256(html || 'x') AS right_sha256 FROM pages WHERE page_id % 9 = 2
    UNION ALL SELECT page_id, sha256(html), NULL FROM pages WHERE page_id % 9 = 4
    """,
)
def contents_by_ranges(t: Tables) -> DataFrame:
    rest = F.col("page_id") % 9
    copy = t.pages.filter(rest != 4).withColumn("html", F.when(rest == 2, F.concat("html", F.lit("x"))).otherwise(F.col("html")))
    return checks.content_equal(t.pages, copy, "page_id", "html", by_ranges=True)


@query(
    "referential_check",
    """
    SELECT l_partkey AS key, count(*) AS rows FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 11) GROUP BY 1
    """,
)
def references(t: Tables) -> DataFrame:
    return checks.referential_check(t.lineitem, "l_partkey", t.part.filter(F.col("p_size") != 11), "p_partkey")


@query(
    "exactly_one",
    "SELECT user_id, count(DISTINCT event_type) AS distinct_values FROM events GROUP BY 1 HAVING count(DISTINCT event_type) <> 1",
)
def single(t: Tables) -> DataFrame:
    return checks.exactly_one(t.events, ["user_id"], "event_type")


@query(
    "layout_missing",
    "SELECT doc_id AS dashboard_id, 'chart<' || position || '>' AS chart_id FROM documents, range(3) r(position) "
    "WHERE position = n_chars % 4 OR n_chars % 11 = 5",
)
def layout(t: Tables) -> DataFrame:
    """Three charts per document's board; the layout leaves one out, except where the rest is 3; every eleventh is broken."""
    def chart(i) -> F.Column:
        return F.concat(F.lit("chart<"), i.cast("string"), F.lit(">"))

    places = F.array(*[F.lit(i) for i in range(3)])
    boards = t.documents.select(F.col("doc_id").alias("dashboard_id"), (F.col("n_chars") % 4).alias("_left_out"), (F.col("n_chars") % 11 == 5).alias("_broken"))
    charts = boards.select("dashboard_id", F.explode(F.transform(places, chart)).alias("chart_id"))
    kept = F.transform(F.filter(places, lambda i: i != F.col("_left_out")), chart)
    whole = F.to_json(F.struct(kept.alias("children")))
    layouts = boards.select("dashboard_id", F.when(F.col("_broken"), F.concat(F.lit("{broken "), whole)).otherwise(whole).alias("layout"))
    return checks.layout_missing(charts, layouts)


@query(
    "series_present",
    """
    SELECT q.user_id, count(DISTINCT event_type) AS series, count(event_type) > 0 AS passed
    FROM (SELECT c_custkey AS user_id FROM customer) q LEFT JOIN events e USING (user_id) GROUP BY 1
    """,
)
def present(t: Tables) -> DataFrame:
    """Every customer is a query, every pair of user and event type a series."""
    series = t.events.select("user_id", "event_type").distinct()
    return checks.series_present(t.customer.select(F.col("c_custkey").alias("user_id")), series, "user_id")


@query(
    "nonempty_output",
    """
    SELECT 'errors' AS output, count(*) AS rows, count(*) > 0 AS passed FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'impossible', count(*), count(*) > 0 FROM events WHERE value < 0
    """,
)
def nonempty(t: Tables) -> DataFrame:
    outputs = {"errors": t.events.filter(F.col("event_type") == "error"), "impossible": t.events.filter(F.col("value") < 0)}
    return checks.nonempty_output(outputs)


@query(
    "field_expectations",
    """
    SELECT event_id, 'k' AS field, '7' AS expected, CAST(json_extract(props, '$.k') AS VARCHAR) AS actual
    FROM events WHERE CAST(json_extract(props, '$.k') AS VARCHAR) <> '7'
    UNION ALL SELECT event_id, 'status.phase', 'done', '' FROM events
    """,
)
def expected_fields(t: Tables) -> DataFrame:
    return checks.field_expectations(t.events, "props", ["event_id"], {"k": "7", "status.phase": "done"})


@query(
    "budget_check",
    """
    WITH m AS (SELECT user_id, count(*) AS calls, count(*) FILTER (WHERE event_type = 'error') AS failures FROM events GROUP BY 1)
    SELECT user_id, 'calls' AS measure, calls AS value, CAST(66 AS BIGINT) AS "limit" FROM m WHERE calls > 66
    UNION ALL SELECT user_id, 'failures', failures, 13 FROM m WHERE failures > 13
    """,
)
def budgets(t: Tables) -> DataFrame:
    measures = t.events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("event_type") == "error").alias("failures")
    )
    return checks.budget_check(measures, {"calls": 66, "failures": 13}, ["user_id"])


@query(
    "run_checks",
    """
    SELECT 'duplicate line keys' AS "check", count(*) = 0 AS passed, count(*) AS violations FROM
      (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'orders without customer', count(*) = 0, count(*) FROM
      (SELECT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1)
    UNION ALL SELECT 'big orders', count(*) = 0, count(*) FROM orders WHERE o_totalprice > 100000
    UNION ALL SELECT 'broken check', false, 0
    UNION ALL SELECT 'failing check', false, 0
    """,
)
def all_checks(t: Tables) -> DataFrame:
    """One check cannot be planned, one fails while it runs, one finds far more than a screenful."""
    return _checked(t).report.select("check", "passed", "violations")


def _checked(t: Tables) -> checks.CheckReport:
    big = t.orders.filter(F.col("o_totalprice") > 100_000).select("o_orderkey")
    return checks.run_checks(
        t.spark,
        {
            "duplicate line keys": lambda: checks.duplicates(t.lineitem, "l_orderkey", "l_linenumber"),
            "orders without customer": lambda: checks.referential_check(t.orders, "o_custkey", t.customer, "c_custkey"),
            "failing check": lambda: t.orders.select(F.raise_error(F.lit("no luck")).alias("x")),
            "big orders": lambda: big,
            "broken check": lambda: t.orders.select("no_such_column"),
        },
    )


@query(
    "check_evidence",
    """
    SELECT 'big orders' AS "check", '{"o_orderkey":' || o_orderkey || '}' AS "row" FROM orders WHERE o_totalprice > 100000
    UNION ALL SELECT 'orders without customer', '{"key":' || o_custkey || ',"rows":' || count(*) || '}' FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey
    UNION ALL SELECT 'duplicate line keys', '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"count":' || count(*) || '}'
      FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
)
def evidence(t: Tables) -> DataFrame:
    return _checked(t).evidence
