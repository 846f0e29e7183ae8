"""Query corpora from dashboard documents: panels, targets, datasources, entries."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.json import (
    METRIC_DASHBOARD_SECRET_KEYS,
    json_objects,
    member,
    member_object,
    member_text,
    redact_keys,
    sql_texts,
)
from tidemill.functions.text import sha256_text, slug, sql_document, template_variables
from tidemill.operators.ordering import first_per_key
from tidemill.operators.skew import dimension_join, skew_join
from tidemill.session import materialize, path_exists, publish_folder

# Query languages and the file suffix of each.
SUFFIXES = {
    "grafana-expression": ".expr.json",
    "sql": ".sql",
    "logql": ".logql",
    "traceql": ".traceql",
    "promql": ".promql",
    "flux": ".flux",
    "influxql": ".influxql",
    "graphite": ".graphite",
    "unknown": ".query.json",
}
# Datasource references that are not looked up.
MIXED, EXPRESSION = "-- Mixed --", "__expr__"

_PANEL = "id string, title string, hide boolean, transparent boolean, collapsed boolean, datasource string, targets array<string>"


def _panel_of(objects: Column, panel: Column) -> Column:
    """A panel's own members, from one of the document's objects."""
    texts = [member(panel, n)["text"].alias(n) for n in ("id", "title")]
    flags = [F.coalesce(member(panel, n)["text"] == "true", F.lit(False)).alias(n) for n in ("hide", "transparent", "collapsed")]
    shared = member_text(member_object(objects, panel, "libraryPanel"), "uid")
    targets = F.from_json(member(panel, "targets")["text"], "array<string>")
    return F.struct(*texts, *flags, member(panel, "datasource")["text"].alias("datasource"), shared.alias("shared_uid"), targets.alias("targets"))


def flatten_panels(documents: DataFrame, doc: str = "doc", library: DataFrame | None = None, uid: str | None = None) -> DataFrame:
    """One row per panel at any depth, parents before children, in reading order.

    The document may sit under ``dashboard`` or ``spec``; one without a title has its ``uid`` column's text as title.  ``library`` (uid, model and, if
    there is one, name) supplies the body of shared panels, which keep their own id and title, or else the shared element's name, only
    where the model has none.  Everything happens inside the row.
    """
    objects, root = F.col("_objects"), F.get(F.col("_objects"), F.lit(0))
    place = (
        F.when(member(root, "dashboard")["kind"] == "object", "dashboard").when(member(root, "spec")["kind"] == "object", "spec").otherwise("")
    )
    own = F.coalesce(member_object(objects, root, "dashboard"), member_object(objects, root, "spec"), root)
    lead = F.when(F.col("_place") == "", "").otherwise(F.concat("_place", F.lit("/")))
    panels = F.filter(objects, lambda o: o["path"].startswith(lead) & F.substr(o["path"], F.length(lead) + 1).rlike(r"^panels\[\](/panels\[\])*$"))
    title = F.nullif(member(own, "title")["text"], F.lit(""))
    parsed = documents.withColumn("_objects", json_objects(F.col(doc), ("targets", "datasource"))).withColumn("_place", place)
    rows = parsed.select(
        *documents.columns,
        (F.coalesce(title, F.col(uid).cast("string")) if uid else title).alias("dashboard_title"),
        F.posexplode(F.transform(panels, lambda p: _panel_of(objects, p))).alias("panel_position", "panel"),
    )
    keep = [c for c in documents.columns if c != doc]
    if library is not None:
        name = F.col("name") if "name" in library.columns else F.lit(None).cast("string")
        models = library.select(F.col("uid").alias("_uid"), F.from_json("model", _PANEL).alias("_model"), name.alias("_name"))
        rows = dimension_join(rows.withColumn("_uid", F.col("panel.shared_uid")), models, ["_uid"])
        merged = F.struct(
            F.coalesce("_model.id", "panel.id").alias("id"),
            F.coalesce("_model.title", F.nullif("panel.title", F.lit("")), "_name").alias("title"),
            *[F.coalesce(f"_model.{f}", F.lit(False)).alias(f) for f in ("hide", "transparent", "collapsed")],
            F.col("_model.datasource").alias("datasource"), F.col("panel.shared_uid").alias("shared_uid"), F.col("_model.targets").alias("targets"),
        )
        rows = rows.withColumn("panel", F.when(F.col("_model").isNotNull(), merged).otherwise(F.col("panel")))
    hidden = F.col("panel.hide") | (F.col("panel.transparent") & F.col("panel.collapsed"))
    return rows.select(
        *keep, "dashboard_title", "panel_position",
        F.col("panel.id").alias("panel_id"), F.col("panel.title").alias("panel_title"),
        hidden.alias("panel_hidden"), F.col("panel.datasource").alias("panel_datasource"),
        F.col("panel.targets").alias("targets"),
    )


def number_targets(panels: DataFrame) -> DataFrame:
    """One row per query of a panel with its 1-based index and reference id (the index when none is given)."""
    rows = panels.select(
        *[c for c in panels.columns if c != "targets"],
        F.posexplode("targets").alias("_at", "target"),
    ).filter(F.col("target").startswith("{"))
    given = F.nullif(F.get_json_object("target", "$.refId"), F.lit(""))
    hide = F.coalesce(F.get_json_object("target", "$.hide") == "true", F.lit(False))
    return rows.select(
        *[c for c in rows.columns if c not in ("_at",)],
        (F.col("_at") + 1).alias("query_index"),
        F.coalesce(given, (F.col("_at") + 1).cast("string")).alias("ref_id"),
        (hide | F.col("panel_hidden")).alias("hidden"),
    )


def hide_filter(rows: DataFrame, flag: str = "hidden", include_hidden: bool = False) -> DataFrame:
    """Hidden rows go unless asked for."""
    return rows if include_hidden else rows.filter(~F.coalesce(flag, F.lit(False)))


def _reference(value: Column, fallback_uid: Column) -> Column:
    """(uid, type) of a datasource entry that is an object, a plain uid, a ``$variable`` or absent."""
    as_object = F.from_json(value, "uid string, type string")
    plain = value.isNotNull() & (value != "") & ~value.startswith("$")
    return (
        F.when(value.startswith("{"), F.struct(as_object["uid"].alias("uid"), as_object["type"].alias("type")))
        .when(plain, F.struct(value.alias("uid"), F.lit(None).cast("string").alias("type")))
        .otherwise(F.struct(fallback_uid.alias("uid"), F.lit(None).cast("string").alias("type")))
    )


def inherit_datasource(targets: DataFrame, datasources: DataFrame, default_uid: str | None = None) -> DataFrame:
    """Add ``datasource_uid`` and ``datasource_type`` to targets.

    A target without its own reference takes its panel's, and a panel without one
    the default; a ``$variable`` text counts as none.  ``datasources`` is (uid,
    type), one row each.
    """
    default = F.lit(default_uid).cast("string")
    rows = targets.withColumn("_panel", _reference(F.col("panel_datasource"), default))
    own = F.get_json_object("target", "$.datasource")
    rows = rows.withColumn("_ref", _reference(own, F.col("_panel.uid")))
    uid = F.col("_ref.uid")
    fixed = uid.isNull() | uid.isin(MIXED, EXPRESSION, "") | uid.startswith("$")
    rows = rows.withColumn("datasource_uid", uid).withColumn("_lookup", F.when(~fixed, uid))
    known = datasources.select(F.col("uid").alias("_lookup"), F.col("type").alias("_type"))
    joined = dimension_join(rows, known, ["_lookup"])
    return joined.withColumn("datasource_type", F.coalesce("_type", "_ref.type")).drop(
        "_panel", "_ref", "_lookup", "_type"
    )


_TEXT_FIELDS = ("type", "expr", "query", "queryType", "target", "rawSql", "rawSQL", "sql")


def with_fields(targets: DataFrame) -> DataFrame:
    """Add ``_field``: the text members of each target, NULL where a member is no JSON string.

    The target is parsed once, in a projection of its own.
    """

    def text(name: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get("_target", f"$.{name}", "variant"))
        return F.when(kind == "STRING", F.try_variant_get("_target", f"$.{name}", "string"))

    # the first non-empty of the three SQL members counts, even when it is no text
    raw = [F.nullif(F.try_variant_get("_target", f"$.{n}", "string"), F.lit("")) for n in _TEXT_FIELDS[5:]]
    sql = F.when(raw[0].isNotNull(), text("rawSql")).when(raw[1].isNotNull(), text("rawSQL")).otherwise(text("sql"))
    own = F.try_variant_get("_target", "$.datasource", "string")
    parsed = targets.withColumn("_target", F.try_parse_json("target"))
    members = [text(n).alias(n) for n in _TEXT_FIELDS[:5]]
    return parsed.withColumn(
        "_field",
        F.struct(
            *members,
            sql.alias("sql"),
            F.coalesce(F.try_variant_get("_target", "$.datasource.uid", "string"), own).alias("uid"),
            F.try_variant_get("_target", "$.datasource.type", "string").alias("kind"),
        ),
    ).drop("_target")


def classify_query(field: Column, datasource_type: Column) -> Column:
    """The query language of a target from its ``_field`` struct: the first rule that fits.

    The rules are kept as they are followed elsewhere: a type that holds ``influx`` also holds ``flux``, so
    ``influxql`` has a suffix, but no target reaches it.
    """
    kind = F.lower(F.coalesce(F.nullif(datasource_type, F.lit("")), field["kind"], F.lit("")))

    def filled(value: Column) -> Column:
        return F.coalesce(F.btrim(value, F.lit(" \t\r\n")) != "", F.lit(False))

    expr, query = filled(field["expr"]), filled(field["query"])
    return (
        F.when((field["type"] == "math") | (field["uid"] == EXPRESSION), "grafana-expression")
        .when(filled(field["sql"]), "sql")
        .when(expr & kind.contains("loki"), "logql")
        .when(expr & (kind.contains("tempo") | kind.contains("trace")), "traceql")
        .when(expr, "promql")
        .when(query & (F.coalesce(field["queryType"] == "flux", F.lit(False)) | kind.contains("flux")), "flux")
        .when(query & kind.contains("influx"), "influxql")
        .when((query | filled(field["target"])) & kind.contains("graphite"), "graphite")
        .otherwise("unknown")
    )


def corpus_entries(targets: DataFrame) -> DataFrame:
    """Manifest entries with their text, from targets that carry a datasource.

    Query texts keep their templates; expressions and unknown targets become their
    redacted JSON.
    """
    fields = F.col("_field")
    rows = with_fields(targets).withColumn("language", classify_query(fields, F.col("datasource_type")))
    trimmed = F.lit(" \t\r\n")
    plain = (
        F.when(F.col("language").isin("promql", "logql", "traceql"), fields["expr"])
        .when(F.col("language").isin("flux", "influxql"), fields["query"])
        .when(
            F.col("language") == "graphite",
            F.coalesce(F.nullif(F.btrim(fields["query"], trimmed), F.lit("")), fields["target"]),
        )
    )
    structured = F.when(F.col("language").isin("grafana-expression", "unknown"), F.col("target"))
    title = F.coalesce("panel_title", "panel_id")
    as_sql = sql_document(
        {"Dashboard": F.coalesce("dashboard_title", F.lit("")), "Panel": title, "RefId": F.col("ref_id")},
        fields["sql"],
    )
    rows = rows.withColumn("_json", redact_keys(structured, METRIC_DASHBOARD_SECRET_KEYS, indent=2))
    text = (
        F.when(F.col("language") == "sql", as_sql)
        .when(F.col("_json").isNotNull(), F.concat("_json", F.lit("\n")))
        .otherwise(F.concat(F.btrim(plain, trimmed), F.lit("\n")))
    )
    suffix = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])[F.col("language")]
    name = F.concat(
        F.concat_ws(
            "-",
            F.coalesce("panel_id", F.lit("panel")),
            slug(F.coalesce(F.nullif("panel_title", F.lit("")), F.lit("panel"))),
            slug(F.col("ref_id")),
        ),
        suffix,
    )
    return rows.withColumn("text", text).select(
        *[c for c in targets.columns if c not in ("target", "panel_datasource", "panel_hidden")],
        F.lit("panel").alias("asset_type"),
        "language",
        name.alias("file"),
        template_variables(F.col("text")).alias("variables"),
        "text",
        sha256_text(F.col("text")).alias("sha256"),
        F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )


def asset_expand(
    charts: DataFrame, details: DataFrame, include_hidden: bool = False
) -> DataFrame:
    """Dashboard charts with their compiled queries; a chart without one stays as a failed row.

    ``charts`` is (dashboard_id, dashboard_title, position, chart_id, chart_title,
    hidden), the first entry of a chart per dashboard counts; ``details`` is
    (chart_id, doc), one row per chart.  A chart used by most dashboards is spread.
    """
    unique = first_per_key(charts, ["dashboard_id", "chart_id"], ["position"])
    shown = hide_filter(unique, "hidden", include_hidden)
    parsed = details.select("chart_id", "doc", json_objects(F.col("doc"), ("datasource",)).alias("_objects"))
    root = F.get("_objects", F.lit(0))
    inner = member_object(F.col("_objects"), root, "result")
    source = F.coalesce(*[member(o, k)["text"] for o in (root, inner) for k in ("datasource", "datasource_id")])
    found = parsed.select(
        "chart_id", F.lit(True).alias("_known"), sql_texts(F.col("_objects")).alias("_sqls"),
        source.alias("datasource"), template_variables(F.col("doc")).alias("variables"),
    )
    joined = skew_join(shown, found, ["chart_id"], salt_on=["dashboard_id"], how="left")
    problem = F.when(F.col("_known").isNull(), "chart not found").when(
        F.size("_sqls") == 0, "no compiled SQL returned"
    )
    rows = joined.select(
        *charts.columns, problem.alias("error"), "datasource", "variables", F.posexplode_outer("_sqls").alias("_at", "sql")
    )
    title = F.coalesce("chart_title", F.concat(F.lit("chart-"), F.col("chart_id").cast("string")))
    ok = F.col("error").isNull()
    text = F.when(ok, sql_document({"Dashboard": F.col("dashboard_title"), "Chart": title}, F.col("sql")))
    file = F.concat(
        F.col("chart_id").cast("string"), F.lit("-"), slug(title, "dashboard"),
        F.lit("-q"), (F.col("_at") + 1).cast("string"), F.lit(".sql"),
    )
    return rows.select(
        "dashboard_id", "chart_id", title.alias("asset_title"),
        F.when(ok, F.col("_at") + 1).alias("query_index"),
        F.lit("sql").alias("language"), F.when(ok, F.col("datasource")).alias("datasource"), "hidden",
        F.when(ok, F.col("variables")).alias("variables"), F.when(ok, file).alias("file"), text.alias("text"),
        F.when(ok, sha256_text(text)).alias("sha256"),
        F.when(ok, "ok").otherwise("failed").alias("status"), "error",
    )


def manifest_summary(entries: DataFrame, by: list[str] | None = None) -> DataFrame:
    return entries.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "ok").alias("succeeded"),
        F.count_if(~F.col("status").eqNullSafe("ok")).alias("failed"),
    )


def corpus_export(entries: DataFrame, path: str, overwrite: bool = False) -> Mapping[str, int]:
    """Write the query texts and the manifest below ``path``; refuse an empty corpus.

    The entries are worked out once, into a checkpoint, and summed up first, so nothing
    is written when no query succeeded; an existing target is refused unless
    ``overwrite``.  Both parts are written next to the target and get its name by one rename, so
    a reader sees the whole old export, or the whole new one.
    """
    spark = entries.sparkSession
    if path_exists(spark, path) and not overwrite:
        raise FileExistsError(f"{path} already exists")
    entries = materialize(entries)
    summary = manifest_summary(entries).first().asDict()
    if not summary["succeeded"]:
        raise ValueError("no query could be exported")
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    entries.filter(F.col("status") == "ok").write.parquet(f"{staged}/queries")
    entries.drop("text").write.parquet(f"{staged}/manifest")
    publish_folder(spark, staged, path, overwrite)
    return summary
