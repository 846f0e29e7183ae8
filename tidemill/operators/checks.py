"""Data-quality jobs: every violation is a row, and no check hides another."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.json import json_path
from tidemill.functions.text import sha256_text
from tidemill.operators.rows import cell_text, differing_ranges, multiset_diff, multiset_diff_by_digests
from tidemill.operators.skew import skew_join
from tidemill.session import materialize

# Fixed value: words that must not survive in an exported source document.
LEAK_PATTERN = r"(?i)(password|authorization|access[_-]?token|api[_-]?key|clientsecret)"


@dataclass(frozen=True)
class CheckReport:
    """``report``: one row (check, passed, violations, error) per check; ``evidence``: every violation as (check, row)."""

    report: DataFrame
    evidence: DataFrame


def run_checks(spark: SparkSession, checks: Mapping[str, Callable[[], DataFrame]]) -> CheckReport:
    """Run every check by itself and keep all that it finds.

    A check is a function giving its violations.  Each one is planned and computed inside its own
    ``try``, so one that cannot be planned or fails while it runs becomes a failed row with
    its error, and the others are whole.  What was found lies in the checkpoint folder; counts are taken from there.
    """
    rows, errors = spark.createDataFrame([], "check string, row string"), []
    for name, check in checks.items():
        try:
            found = check().select(F.lit(name).alias("check"), F.to_json(F.struct("*")).alias("row"))
            rows = rows.unionByName(materialize(found))
            errors.append((name, None))
        except Exception as error:  # noqa: BLE001 - the failure itself is the evidence
            errors.append((name, f"{type(error).__name__}: {error}"))
    listed = spark.createDataFrame(errors, "check string, error string")
    counted = rows.groupBy("check").agg(F.count(F.lit(1)).alias("violations"))
    count = F.coalesce("violations", F.lit(0))
    report = listed.join(counted, "check", "left").select(
        "check", ((count == 0) & F.col("error").isNull()).alias("passed"), count.alias("violations"), "error"
    )
    return CheckReport(report, rows)


def text_expectations(
    texts: DataFrame, column: str, required: Sequence[str] = (), forbidden: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Per pattern: how many texts match and whether that is right.

    A required pattern needs at least one match, a forbidden one none; ``^`` and
    ``$`` match at line ends.  All patterns are tested in one pass over the texts.
    """
    patterns = [(p, "required") for p in required] + [(p, "forbidden") for p in forbidden]
    counts = [
        F.count_if(F.col(column).rlike("(?m)" + p)).alias(f"_m{i}") for i, (p, _) in enumerate(patterns)
    ]
    rows = []
    for i, (pattern, kind) in enumerate(patterns):
        matches = F.col(f"_m{i}")
        ok = matches > 0 if kind == "required" else matches == 0
        rows.append(
            F.struct(
                F.lit(pattern).alias("pattern"), F.lit(kind).alias("kind"),
                matches.alias("matches"), ok.alias("passed"),
            )
        )
    return texts.groupBy(*by).agg(*counts).select(*by, F.inline(F.array(*rows)))


def manifest_check(
    entries: DataFrame, files: DataFrame, sources: DataFrame,
    expected_count: int, language: str, required_text: Sequence[str] = (), required_any: Sequence[str] = (),
) -> DataFrame:
    """Violations of an exported corpus as (subject, violation) rows.

    ``entries`` is the manifest (file, language, status, sha256), ``files`` the texts
    (file, text), ``sources`` the kept documents (file, text), of which there must be one at least.
    """
    # texts are judged where they are read; only digests and findings are shuffled
    lacks = [F.when(~F.col("text").contains(t), F.lit(f"omitted {t!r}")) for t in required_text]
    omitted = F.array_compact(F.array(*lacks)) if lacks else F.array().cast("array<string>")
    digests = files.select("file", sha256_text(F.col("text")).alias("_digest"), omitted.alias("_omitted"))
    joined = entries.alias("e").join(digests.alias("f"), "file", "full")
    good = F.coalesce((F.col("language") == language) & (F.col("status") == "ok"), F.lit(False))
    in_manifest, on_disk = F.col("status").isNotNull(), F.col("_digest").isNotNull()
    tests = [
        (in_manifest & ~good, "invalid query entry"),
        (in_manifest & good & ~on_disk, "query file is missing"),
        (~in_manifest & on_disk, "file is not in the manifest"),
        (in_manifest & good & on_disk & ~F.col("sha256").eqNullSafe(F.col("_digest")), "checksum mismatch"),
    ]
    flags = F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in tests]))
    flags = F.when(in_manifest & good & on_disk, F.concat(flags, "_omitted")).otherwise(flags)
    per_file = joined.select(F.col("file").alias("subject"), F.explode(flags).alias("violation"))

    whole = [F.count(F.lit(1)).alias("_n"), F.count_if(F.col("status") == "ok").alias("_ok")]
    totals = entries.agg(*whole).select(
        F.lit("manifest").alias("subject"),
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("_n") != expected_count, F.concat(F.lit("total was "), F.col("_n").cast("string"))),
                    F.when(F.col("_ok") != F.col("_n"), F.concat(F.lit("succeeded was "), F.col("_ok").cast("string"))),
                )
            )
        ).alias("violation"),
    )
    leaks = sources.filter(F.col("text").rlike(LEAK_PATTERN)).select(
        F.col("file").alias("subject"), F.lit("source retained a secret word").alias("violation")
    )
    kept = sources.agg(F.count(F.lit(1)).alias("_n")).filter("_n = 0")
    none = kept.select(F.lit("sources").alias("subject"), F.lit("no source document was kept").alias("violation"))
    result = per_file.unionByName(totals).unionByName(leaks).unionByName(none)
    if required_any:
        seen = files.agg(*[F.count_if(F.col("text").contains(t)).alias(f"_t{i}") for i, t in enumerate(required_any)])
        absent = [F.when(F.col(f"_t{i}") == 0, F.lit(f"no file has {t!r}")) for i, t in enumerate(required_any)]
        result = result.unionByName(
            seen.select(F.lit("files").alias("subject"), F.explode(F.array_compact(F.array(*absent))).alias("violation"))
        )
    return result


def content_equal(left: DataFrame, right: DataFrame, key: str, content: str, by_ranges: bool = False) -> DataFrame:
    """Objects whose digests differ or that exist on one side only.  Contents are digested before they shuffle.

    ``by_ranges``: for large sides that should be equal; they are scanned first, and only objects of ranges of keys whose digests differ are compared.
    """
    if by_ranges:
        left, right = left.select(key, content), right.select(key, content)
        apart = differing_ranges(left, right, [key], [key, content])
        apart = F.lit(False) if apart is None else apart
        left, right = left.filter(apart), right.filter(apart)
    digest = F.sha2(F.col(content).cast("binary"), 256)
    a = left.select(key, digest.alias("left_sha256"))
    b = right.select(key, digest.alias("right_sha256"))
    return a.join(b, key, "full").filter(~F.col("left_sha256").eqNullSafe(F.col("right_sha256")))


def referential_check(
    children: DataFrame, child_key: str, parents: DataFrame, parent_key: str
) -> DataFrame:
    """Child keys without a parent, with the number of child rows; keys are counted before they join."""
    wanted = children.groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    known = parents.select(F.col(parent_key).alias("key")).distinct()
    return wanted.filter(F.col("key").isNotNull()).join(known, "key", "left_anti")


def exactly_one(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Groups that use none or several distinct values of a column."""
    distinct = df.groupBy(*by).agg(F.count_distinct(value).alias("distinct_values"))
    return distinct.filter(F.col("distinct_values") != 1)


def layout_missing(charts: DataFrame, layouts: DataFrame, board: str = "dashboard_id") -> DataFrame:
    """Charts whose id does not appear in their dashboard's layout text (layouts: one row per dashboard).

    A layout that is no JSON is an empty one.
    """
    readable = layouts.withColumn("layout", F.when(F.try_parse_json("layout").isNotNull(), F.col("layout")))
    joined = skew_join(charts, readable, [board], salt_on=["chart_id"], how="left")
    present = F.contains(F.coalesce("layout", F.lit("{}")), F.col("chart_id").cast("string"))
    return joined.filter(~present).drop("layout")


def series_present(queries: DataFrame, series: DataFrame, key: str) -> DataFrame:
    """Per expected query: its number of series, and whether it has any."""
    counts = series.groupBy(key).agg(F.count(F.lit(1)).alias("series"))
    return queries.join(counts, key, "left").select(
        key, F.coalesce("series", F.lit(0)).alias("series"), F.col("series").isNotNull().alias("passed")
    )


def nonempty_output(outputs: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named output; no rows is a failure."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("output"), "rows", (F.col("rows") > 0).alias("passed")
        )
        for name, df in outputs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def field_expectations(docs: DataFrame, doc: str, ids: Sequence[str], expected: Mapping[str, str]) -> DataFrame:
    """Dotted fields whose value differs from the expected text; absent fields show as empty."""
    rows = []
    for path, wanted in expected.items():
        actual = json_path(F.col(doc), "." + path.strip("."))
        rows.append(
            F.struct(F.lit(path).alias("field"), F.lit(str(wanted)).alias("expected"), actual.alias("actual"))
        )
    return docs.select(*ids, F.inline(F.array(*rows))).filter(F.col("expected") != F.col("actual"))


def same_set(left: DataFrame, right: DataFrame) -> DataFrame:
    return multiset_diff(left, right, as_sets=True)


def same_multiset(left: DataFrame, right: DataFrame) -> DataFrame:
    return multiset_diff(left, right)


def same_multiset_by_digests(left: DataFrame, right: DataFrame) -> DataFrame:
    """The same for large tables that should be equal: what they exchange are digests of ranges, and the rows of ranges that differ."""
    return multiset_diff_by_digests(left, right)


def column_statistics(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, min, max, average and longest text.

    All columns share one scan.  The exact distinct counts take another: every value becomes its column's number and 128 bits of its
    hash, which are reduced map-side to one row per value and task; ``approximate`` counts distinct values by a sketch in the first scan instead.
    """
    if not columns:
        raise ValueError("no columns to describe")
    aggregates = []
    for i, c in enumerate(columns):
        length = F.when(F.col(c).isNotNull(), F.length(cell_text(df, c)))
        aggregates += [
            F.count_if(F.col(c).isNull()).alias(f"_nulls{i}"), F.min(c).cast("string").alias(f"_min{i}"), F.max(c).cast("string").alias(f"_max{i}"),
            F.avg(length).alias(f"_avg{i}"), F.max(length).alias(f"_long{i}"),
        ]
        if approximate:
            aggregates.append(F.approx_count_distinct(F.col(c)).alias(f"_distinct{i}"))
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    rows = [
        F.struct(
            F.lit(i).alias("_column"), F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(f"_nulls{i}").alias("nulls"),
            (F.col(f"_distinct{i}") if approximate else F.lit(None).cast("long")).alias("distinct_values"), F.col(f"_min{i}").alias("min_value"),
            F.col(f"_max{i}").alias("max_value"), F.col(f"_avg{i}").alias("avg_length"),
            F.col(f"_long{i}").alias("max_length"),
        )
        for i, c in enumerate(columns)
    ]
    told = one.select(F.inline(F.array(*rows)))
    if not approximate:
        counts = _distinct_values(df, columns)
        told = told.drop("distinct_values").join(counts, "_column", "left").withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))
    return told.select("column", "rows", "nulls", "distinct_values", "min_value", "max_value", "avg_length", "max_length")


def _distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(_column, distinct_values) of the columns that have values."""

    def hashed(i: int, c: str) -> Column:
        value = F.col(c)
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0)  # the two zeros are one value
        return F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("_column"), F.xxhash64(value).alias("a"), F.xxhash64(F.lit(7), value).alias("b")))

    values = df.select(F.explode(F.array_compact(F.array(*[hashed(i, c) for i, c in enumerate(columns)]))).alias("v")).select("v.*")
    return values.distinct().groupBy("_column").agg(F.count(F.lit(1)).alias("distinct_values"))


def count_by(df: DataFrame, *by: Column | str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


def duplicates(df: DataFrame, *by: Column | str) -> DataFrame:
    """Values seen more than once, with their counts."""
    return count_by(df, *by).filter(F.col("count") > 1)


def budget_check(
    measures: DataFrame, limits: Mapping[str, int], ids: Sequence[str] = ()
) -> DataFrame:
    """Measures above their limit, one row each; a measure equal to its limit passes, an absent one counts as 0."""
    rows = [
        F.struct(
            F.lit(name).alias("measure"),
            F.coalesce(F.col(name).cast("long"), F.lit(0)).alias("value"),
            F.lit(limit).cast("long").alias("limit"),
        )
        for name, limit in limits.items()
    ]
    return measures.select(*ids, F.inline(F.array(*rows))).filter(F.col("value") > F.col("limit"))
