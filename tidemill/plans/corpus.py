"""Query-corpus queries.

Every document is a dashboard: its source is the datasource, its language a panel
title, and its panels hold one target of each kind.  The document texts themselves
go through the text functions whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import json as j
from tidemill.functions import text as tx
from tidemill.operators import corpus
from tidemill.plans.registry import Tables, query

# what each source number stands for, by its rest modulo 4
KINDS = ["prometheus", "loki", "influxdb", "tempo"]


def _object(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _list(*texts: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]"))


def _splice(doc: Column, **parts: Column) -> Column:
    """A JSON object with further members given as JSON text."""
    inner = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), p) for n, p in parts.items()])
    return F.concat(F.substring(doc, F.lit(1), F.length(doc) - 1), F.lit(","), inner, F.lit("}"))


def dashboards(t: Tables) -> DataFrame:
    """(doc_id, doc): a dashboard with a panel, a row and a panel inside the row."""
    d = F.col("doc_id")
    text = d.cast("string")
    sql = F.concat(F.lit("select * from t where lang = '$lang' and src = '${source:raw}' limit "), text)
    first = _splice(
        _object(id=F.lit(1), title=F.col("lang"), datasource=F.col("source")),
        targets=_list(
            _object(refId=F.lit("A"), rawSql=sql),
            _object(expr=F.concat(F.lit("rate(chars_"), F.col("n_chars").cast("string"), F.lit("[$__rate_interval])"))),
            _object(refId=F.lit("C"), query=F.lit("from(bucket)"), queryType=F.lit("flux"), hide=d % 3 == 0),
        ),
    )
    nested = _splice(
        _object(id=F.lit(3), title=F.concat(F.lit("In "), F.col("source"))),
        targets=_list(
            _object(refId=F.lit("M"), type=F.lit("math"), expression=F.lit("$A / $B"), datasource=F.lit("__expr__"),
                    token=F.lit("hidden-word")),
            _object(query=F.lit("series"), datasource=F.lit("$ds")),
        ),
    )
    row = _splice(
        _object(id=F.lit(2), title=F.lit("Row"), transparent=d % 5 == 0, collapsed=F.lit(True)), panels=_list(nested)
    )
    body = _splice(
        _object(title=F.concat_ws(" ", F.lit("Board"), F.col("source"), text), password=F.lit("hidden-word")),
        panels=_list(first, row),
    )
    wrapped = F.concat(F.lit('{"dashboard":'), body, F.lit(',"meta":{"folderUid":"f"}}'))
    return t.documents.select("doc_id", F.when(d % 2 == 0, wrapped).otherwise(body).alias("doc"))


def datasources(t: Tables) -> DataFrame:
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), number % 4 + 1)
    return t.documents.select("source").distinct().select(F.col("source").alias("uid"), kind.alias("type"))


def _targets(t: Tables) -> DataFrame:
    numbered = corpus.number_targets(corpus.flatten_panels(dashboards(t)))
    return corpus.inherit_datasource(numbered, datasources(t), default_uid="src1")


_TARGETS = """
    WITH d AS (SELECT *, CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) % 4 AS k FROM documents),
    e AS (
      SELECT doc_id, 1 AS panel_id, 1 AS query_index, 'A' AS ref_id, false AS hidden, source AS uid, k, 'sql' AS language,
        '-- Dashboard=Board ' || source || ' ' || doc_id || ';' || chr(10) || '-- Panel=' || lang || ';' || chr(10) || '-- RefId=A;'
        || chr(10) || 'select * from t where lang = ''$lang'' and src = ''${source:raw}'' limit ' || doc_id || ';' || chr(10) AS text,
        'lang,source' AS variables, '1-' || lang || '-a.sql' AS file FROM d
      UNION ALL
      SELECT doc_id, 1, 2, '2', false, source, k, CASE k WHEN 1 THEN 'logql' WHEN 3 THEN 'traceql' ELSE 'promql' END,
        'rate(chars_' || n_chars || '[$__rate_interval])' || chr(10), '__rate_interval',
        '1-' || lang || '-2.' || CASE k WHEN 1 THEN 'logql' WHEN 3 THEN 'traceql' ELSE 'promql' END FROM d
      UNION ALL
      SELECT doc_id, 1, 3, 'C', doc_id % 3 = 0, source, k, 'flux', 'from(bucket)' || chr(10), '', '1-' || lang || '-c.flux' FROM d
      UNION ALL
      SELECT doc_id, 3, 1, 'M', false, '__expr__', NULL, 'grafana-expression',
        '{' || chr(10) || '  "refId": "M",' || chr(10) || '  "type": "math",' || chr(10) || '  "expression": "$A / $B",' || chr(10)
        || '  "datasource": "__expr__"' || chr(10) || '}' || chr(10), 'A,B', '3-in-' || source || '-m.expr.json' FROM d
      UNION ALL
      SELECT doc_id, 3, 2, '2', false, 'src1', 1, 'unknown',
        '{' || chr(10) || '  "query": "series",' || chr(10) || '  "datasource": "$ds"' || chr(10) || '}' || chr(10), 'ds',
        '3-in-' || source || '-2.query.json' FROM d)
"""


@query(
    "flatten_panels",
    """
    SELECT doc_id, 0 AS panel_position, '1' AS panel_id, lang AS panel_title, false AS panel_hidden, 3 AS n_targets FROM documents
    UNION ALL SELECT doc_id, 1, '2', 'Row', doc_id % 5 = 0, 0 FROM documents
    UNION ALL SELECT doc_id, 2, '3', 'In ' || source, false, 2 FROM documents
    """,
)
def panels(t: Tables) -> DataFrame:
    rows = corpus.flatten_panels(dashboards(t))
    targets = F.coalesce(F.size("targets"), F.lit(0))
    return rows.select(
        "doc_id", "panel_position", "panel_id", "panel_title", "panel_hidden",
        F.when(targets < 0, 0).otherwise(targets).alias("n_targets"),
    )


@query(
    "library_panels",
    """
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '7' ELSE '2' END AS panel_id,
           CASE WHEN doc_id % 2 = 0 THEN 'Own' ELSE 'Shared ' || source END AS panel_title,
           CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1 END AS n_targets
    FROM documents
    """,
)
def library(t: Tables) -> DataFrame:
    """Panels that take their body from a shared one; even documents reference an unknown one."""
    uid = F.when(F.col("doc_id") % 2 == 0, F.lit("unknown")).otherwise(F.col("source"))
    panel = F.when(F.col("doc_id") % 2 == 0, _splice(_object(id=F.lit(7), title=F.lit("Own")),
                   libraryPanel=_object(uid=uid))).otherwise(
        F.concat(F.lit('{"id":2,"libraryPanel":'), _object(uid=uid), F.lit("}"))
    )
    docs = t.documents.select(
        "doc_id", F.concat(F.lit('{"title":"b","panels":['), panel, F.lit("]}")).alias("doc")
    )
    models = t.documents.select("source").distinct().select(
        F.col("source").alias("uid"),
        _splice(_object(title=F.concat_ws(" ", F.lit("Shared"), "source")),
                targets=_list(_object(refId=F.lit("A"), expr=F.lit("up")))).alias("model"),
    )
    rows = corpus.flatten_panels(docs, library=models)
    targets = F.coalesce(F.size("targets"), F.lit(0))
    return rows.select("doc_id", "panel_id", "panel_title", F.when(targets < 0, 0).otherwise(targets).alias("n_targets"))


@query("number_queries", _TARGETS + "SELECT doc_id, CAST(panel_id AS VARCHAR) AS panel_id, query_index, ref_id FROM e")
def numbered(t: Tables) -> DataFrame:
    rows = corpus.number_targets(corpus.flatten_panels(dashboards(t)))
    return rows.select("doc_id", "panel_id", "query_index", "ref_id")


@query(
    "inherit_datasource",
    _TARGETS + """
    SELECT doc_id, CAST(panel_id AS VARCHAR) AS panel_id, query_index, uid AS datasource_uid,
           CASE k WHEN 0 THEN 'prometheus' WHEN 1 THEN 'loki' WHEN 2 THEN 'influxdb' WHEN 3 THEN 'tempo' END AS datasource_type
    FROM e
    """,
)
def inherited(t: Tables) -> DataFrame:
    return _targets(t).select("doc_id", "panel_id", "query_index", "datasource_uid", "datasource_type")


@query("hide_filter", _TARGETS + "SELECT doc_id, CAST(panel_id AS VARCHAR) AS panel_id, ref_id FROM e WHERE NOT hidden")
def visible(t: Tables) -> DataFrame:
    return corpus.hide_filter(_targets(t)).select("doc_id", "panel_id", "ref_id")


@query("classify_query", _TARGETS + "SELECT language, count(*) AS queries FROM e GROUP BY 1")
def classified(t: Tables) -> DataFrame:
    language = corpus.classify_query(F.col("_field"), F.col("datasource_type"))
    rows = corpus.with_fields(_targets(t)).select(language.alias("language"))
    return rows.groupBy("language").agg(F.count(F.lit(1)).alias("queries"))


@query(
    "query_corpus",
    _TARGETS + """
    SELECT doc_id, CAST(panel_id AS VARCHAR) AS panel_id, ref_id, language, file, variables, text, sha256(text) AS sha256 FROM e
    """,
)
def entries(t: Tables) -> DataFrame:
    rows = corpus.corpus_entries(_targets(t))
    return rows.select(
        "doc_id", "panel_id", "ref_id", "language", "file", F.array_join("variables", ",").alias("variables"),
        "text", "sha256",
    )


@query(
    "manifest_summary",
    """
    SELECT count(*) AS total, count(*) FILTER (WHERE doc_id % 4 <> 0) AS succeeded,
           count(*) FILTER (WHERE doc_id % 4 = 0) AS failed
    FROM (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM documents WHERE doc_id % 4 IN (1, 3))
    """,
)
def summary(t: Tables) -> DataFrame:
    return corpus.manifest_summary(_assets(t))


def _assets(t: Tables) -> DataFrame:
    """One chart per document, listed twice, on a board per source; details by the rest modulo 4."""
    rest = F.col("doc_id") % 4
    listed = t.documents.select(
        F.col("source").alias("dashboard_id"), F.concat(F.lit("Board "), "source").alias("dashboard_title"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("position"), F.col("doc_id").alias("chart_id"),
        F.concat_ws(" ", "lang", F.col("doc_id").cast("string")).alias("chart_title"), F.lit(False).alias("hidden"),
    )
    own = F.concat(F.lit("select "), F.col("doc_id").cast("string"))
    two = _splice(
        _object(slice_name=F.lit("x")),
        result=_list(
            _object(query=own, rows=F.lit(1)),
            _object(sql=F.lit("not a query"), language=F.lit("sql")),
            _splice(_object(sql_query=F.lit("WITH a AS (SELECT 1) SELECT * FROM a;")), again=_object(query=own)),
        ),
    )
    one = _object(query=own)
    detail = F.when(rest.isin(1, 3), two).when(rest == 0, F.lit('{"slice_name": "empty"}')).otherwise(one)
    return corpus.asset_expand(listed, t.documents.select(F.col("doc_id").alias("chart_id"), detail.alias("doc")))


@query(
    "asset_expand",
    """
    WITH e AS (
      SELECT *, 1 AS query_index, 'select ' || doc_id || ';' AS body FROM documents WHERE doc_id % 4 <> 0
      UNION ALL SELECT *, 2, 'WITH a AS (SELECT 1) SELECT * FROM a;' FROM documents WHERE doc_id % 4 IN (1, 3))
    SELECT doc_id AS chart_id, query_index, 'ok' AS status, NULL AS error,
           doc_id || '-' || lang || '-' || doc_id || '-q' || query_index || '.sql' AS file,
           '-- Dashboard=Board ' || source || ';' || chr(10) || '-- Chart=' || lang || ' ' || doc_id || ';' || chr(10) || body || chr(10) AS text
    FROM e
    UNION ALL SELECT doc_id, NULL, 'failed', 'no compiled SQL returned', NULL, NULL FROM documents WHERE doc_id % 4 = 0
    """,
)
def assets(t: Tables) -> DataFrame:
    return _assets(t).select("chart_id", "query_index", "status", "error", "file", "text")


@query(
    "redact_keys",
    """
    SELECT doc_id, '{"lang": "' || lang || '", "nested": [{"keep": ' || n_chars || '}]}' AS doc FROM documents
    """,
)
def redacted_keys(t: Tables) -> DataFrame:
    inner = _object(Password=F.lit("x"), keep=F.col("n_chars"), apikey=F.lit("y"))
    doc = _splice(_object(lang=F.col("lang"), TOKEN=F.col("source")), nested=_list(inner))
    return t.documents.select("doc_id", j.redact_keys(doc, j.METRIC_DASHBOARD_SECRET_KEYS).alias("doc"))


@query(
    "redact_text",
    r"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text,
        '\b[A-Z][A-Z0-9_]*(?:PASSWORD|PASSWD|SECRET|TOKEN|API_KEY|PRIVATE_KEY)[A-Z0-9_]*\b', '<redacted-env>', 'g'),
        '(?i)(bearer\s+)[A-Za-z0-9._~+/=-]+', '\1<redacted>', 'g'),
        '(?i)((?:password|secret|token|api[_-]?key)\s*[:=]\s*)[^\s,;]+', '\1<redacted>', 'g')) AS digest,
      regexp_matches(text, '(?i)(?:password|secret|token|api[_-]?key)\s*[:=]\s*[^\s,;]+') AS masked
    FROM documents
    """,
)
def redacted_text(t: Tables) -> DataFrame:
    masked = tx.redact_text(F.col("text"))
    return t.documents.select(
        "doc_id", F.md5(F.encode(masked, "UTF-8")).alias("digest"), (masked != F.col("text")).alias("masked")
    )


@query(
    "slug",
    """
    SELECT doc_id, coalesce(nullif(left(trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-'), 80), ''), 'query') AS slug
    FROM documents
    """,
)
def slugs(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.slug(F.col("text")).alias("slug"))


@query(
    "template_variables",
    """
    SELECT conv_id, turn, '_x1,' || role || CASE WHEN role = 'user' THEN '' ELSE ',user' END AS variables FROM conversations
    """,
)
def variables(t: Tables) -> DataFrame:
    text = F.concat(
        F.lit("where a = ${user:csv} and b in ($_x1) and c = '${"), F.col("role"), F.lit(":sqlstring}' and 5 = $5 -- "),
        F.regexp_replace("text", r"\$", ""),
    )
    # names sort as text: assistant and system come before user
    return t.conversations.select("conv_id", "turn", F.array_join(tx.template_variables(text), ",").alias("variables"))


@query(
    "looks_like_sql",
    r"""
    SELECT doc_id, regexp_matches(CASE doc_id % 4 WHEN 0 THEN 'Select ' WHEN 1 THEN 'selected ' WHEN 2 THEN 'explain' || chr(10) ELSE '' END
             || text, '(?is)^(select|with|show|explain)\b') AS is_sql FROM documents
    """,
)
def sql_like(t: Tables) -> DataFrame:
    lead = F.element_at(F.array(F.lit("Select "), F.lit("selected "), F.lit("explain\n"), F.lit("")), (F.col("doc_id") % 4 + 1).cast("int"))
    return t.documents.select("doc_id", tx.looks_like_sql(F.concat(lead, "text")).alias("is_sql"))


@query(
    "sql_document",
    r"""
    SELECT doc_id, md5('-- Dashboard=' || trim(replace(regexp_replace(text, '[\r\n]+', ' ', 'g'), ';', ',')) || ';' || chr(10) ||
      '-- Panel=' || source || ';' || chr(10) || 'select 1' || CASE WHEN doc_id % 2 = 0 THEN ';' ELSE ';' END || chr(10)) AS digest
    FROM documents
    """,
)
def documents_sql(t: Tables) -> DataFrame:
    sql = F.when(F.col("doc_id") % 2 == 0, F.lit(" select 1;\n")).otherwise(F.lit("select 1"))
    text = tx.sql_document({"Dashboard": F.col("text"), "Panel": F.col("source")}, sql)
    return t.documents.select("doc_id", F.md5(F.encode(text, "UTF-8")).alias("digest"))


@query("sha256_text", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def digests(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.sha256_text(F.col("text")).alias("sha256"))


@query(
    "last_line",
    """
    SELECT doc_id, string_split(trim(text, ' ' || chr(9) || chr(10) || chr(13)), chr(10))[-1] AS last FROM documents
    """,
)
def last_lines(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.last_line(F.col("text")).alias("last"))


@query(
    "find_sql",
    """
    SELECT doc_id, 'select ' || doc_id || CASE WHEN doc_id % 2 = 1 THEN '|show tables' ELSE '' END AS queries FROM documents
    """,
)
def found(t: Tables) -> DataFrame:
    own = F.concat(F.lit("  select "), F.col("doc_id").cast("string"))
    extra = F.when(F.col("doc_id") % 2 == 1, "show tables").otherwise("showing tables")
    doc = _splice(
        _object(text=F.col("text"), Query=own),
        rows=_list(_object(sql=extra), F.lit("[1, 2]"), _object(sql_query=own)),
    )
    return t.documents.select("doc_id", F.array_join(j.find_sql(doc), "|").alias("queries"))


@query(
    "json_path",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, '' AS missing, event_type AS first,
           '{"kind":"' || event_type || '"}' AS whole FROM events
    """,
)
def path(t: Tables) -> DataFrame:
    doc = _splice(F.col("props"), status=_object(list=F.array(F.struct(F.col("event_type").alias("kind")))))
    rows = t.events.select("event_id", doc.alias("doc"))
    return rows.select(
        "event_id", j.json_path(F.col("doc"), "{.k}").alias("k"), j.json_path(F.col("doc"), ".status.phase").alias("missing"),
        j.json_path(F.col("doc"), ".status.list[0].kind").alias("first"),
        j.json_path(F.col("doc"), "{.status.list[0]}").alias("whole"),
    )


@query(
    "variable_bind",
    """
    SELECT event_id, 'rate(' || event_type || '{user=~"' || '.+' || '"}[1m]) by $jobs' AS bound FROM events
    """,
)
def bound(t: Tables) -> DataFrame:
    template = F.concat(F.col("event_type"), F.lit('{user=~"$job"}[$__rate_interval]) by {{by}}'))
    text = tx.bind_variables(F.concat(F.lit("rate("), template), {"job": ".+", "__rate_interval": "1m"})
    return t.events.select("event_id", tx.fill_placeholders(text, {"by": "$jobs"}).alias("bound"))


@query(
    "corpus_export",
    _TARGETS + "SELECT language, file, count(*) AS copies, max(sha256(text)) AS greatest FROM e GROUP BY 1, 2",
)
def exported(t: Tables) -> DataFrame:
    """The corpus written out, then queries and manifest joined back on their digests."""
    from tidemill.session import scratch_path

    target = scratch_path(t.spark, "corpus")
    corpus.corpus_export(corpus.corpus_entries(_targets(t)), target)
    texts = t.spark.read.parquet(f"{target}/queries").select("text").distinct()
    texts = texts.select(tx.sha256_text(F.col("text")).alias("sha256"))
    manifest = t.spark.read.parquet(f"{target}/manifest")
    return manifest.join(texts, "sha256").groupBy("language", "file").agg(
        F.count(F.lit(1)).alias("copies"), F.max("sha256").alias("greatest")
    )
