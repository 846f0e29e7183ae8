"""Row shaping and set comparisons."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.ordering import first_per_key, number_rows
from tidemill.operators.skew import skew_join


def curate_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns in the given order; an unknown one is NULL text, not an error."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def union_of_keys(*frames: DataFrame) -> DataFrame:
    """Rows of different shape under one another; columns in first-seen order, NULL where absent."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def property_rows(df: DataFrame, ids: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One (property, value) row per column of every row, values as cell text."""
    chosen = list(columns or [c for c in df.columns if c not in ids])
    cells = [F.struct(F.lit(c).alias("property"), cell_text(df, c).alias("value")) for c in chosen]
    return df.select(*ids, F.inline(F.array(*cells)))


def cell_text(df: DataFrame, column: str) -> Column:
    """NULL as empty text, booleans as ``True`` and ``False``, nested values as spaced JSON with their NULL members, the rest as text."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.BooleanType):
        shown = F.when(F.col(column), "True").when(~F.col(column), "False")
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        shown = F.when(F.col(column).isNotNull(), json_text(F.col(column), kind))
    else:
        shown = F.col(column).cast("string")
    return F.coalesce(shown, F.lit(""))


def json_text(value: Column, kind: T.DataType) -> Column:
    """A value of a known type as JSON text, members parted by a comma and a blank, NULL members kept."""
    if isinstance(kind, T.StructType):
        members = [F.concat(F.lit(_quoted(f.name) + ": "), json_text(value[f.name], f.dataType)) for f in kind.fields]
        shown = F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        parts = F.transform(value, lambda v: json_text(v, kind.elementType))
        shown = F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))
    elif isinstance(kind, T.MapType):
        name = lambda k: _json_string(k.cast("string"))
        parts = F.transform(F.map_entries(value), lambda e: F.concat(name(e["key"]), F.lit(": "), json_text(e["value"], kind.valueType)))
        shown = F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        shown = value.cast("string")
    else:
        shown = _json_string(value.cast("string"))
    return F.coalesce(shown, F.lit("null"))


def _json_string(text: Column) -> Column:
    """A text as a JSON string, escaped as Spark's own writer does."""
    written = F.to_json(F.struct(text.alias("v")))
    return F.when(text.isNotNull(), F.substring(written, F.lit(6), F.length(written) - 6))


def _quoted(name: str) -> str:
    return json.dumps(name, ensure_ascii=False)


def rows_to_json(df: DataFrame, name: str = "line") -> DataFrame:
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def rows_to_csv(df: DataFrame, name: str = "line") -> DataFrame:
    """One CSV line per row; cells as in ``cell_text``, quoted where they need it."""
    cells = []
    for column in df.columns:
        text = cell_text(df, column)
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        cells.append(F.when(text.rlike('[",\r\n]'), quoted).otherwise(text))
    return df.select(F.concat_ws(",", *cells).alias(name))


def select_fields(df: DataFrame, fields: str | Sequence[str]) -> DataFrame:
    """Named columns, given as a list or as comma-separated text; an unknown one is an error."""
    names = fields.split(",") if isinstance(fields, str) else list(fields)
    chosen = [n.strip() for n in names if n.strip()]
    unknown = [n for n in chosen if n not in df.columns]
    if unknown or not chosen:
        raise ValueError(f"unknown fields {unknown}" if unknown else "no fields are named")
    return df.select(*[F.col(f"`{n}`") for n in chosen])


def missing_targets(targets: DataFrame, shadows: DataFrame, name: str) -> DataFrame:
    """Names on the left that the right does not cover."""
    return targets.select(name).distinct().join(shadows.select(name).distinct(), name, "left_anti")


def multiset_diff(left: DataFrame, right: DataFrame, as_sets: bool = False) -> DataFrame:
    """Rows whose multiplicity differs, with both counts; empty means equal.

    Both sides are reduced by one map-side aggregate, so a value that repeats over
    most rows shuffles as one row per task.  NULLs compare equal.
    """
    columns = left.columns
    tagged = left.withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0)).unionByName(
        right.select(*columns).withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))
    )
    counts = tagged.groupBy(*columns).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
    if as_sets:
        counts = counts.withColumn("left_rows", F.least("left_rows", F.lit(1))).withColumn(
            "right_rows", F.least("right_rows", F.lit(1))
        )
    return counts.filter(F.col("left_rows") != F.col("right_rows"))


#: bits of a key's hash by which ranges are told apart at a level of digests, and ranges that are followed into the next level, at most
DIGEST_BITS, MOST_RANGES = 10, 4_096


def differing_ranges(left: DataFrame, right: DataFrame, by: Sequence[str], columns: Sequence[str], levels: int = 2) -> Column | None:
    """Where two tables may differ: a condition on ranges of the hash of ``by``; None if nowhere.

    A range's digest is the number of its rows and the sums of two 64-bit hashes of their ``columns``, so neither order nor layout matters and
    repeated rows count.  Each level is one scan that moves a row per range and task; the next one looks only into
    ranges that differ, as long as they are few.  Two equal tables exchange digests and nothing else.
    """
    low = F.lit((1 << 32) - 1)

    def hashes(side: DataFrame, sign: int) -> DataFrame:
        both = [F.xxhash64(F.lit(seed), *columns) for seed in (1, 2)]
        halves = [half for h in both for half in (h.bitwiseAND(low), F.shiftrightunsigned(h, 32))]
        return side.select(F.xxhash64(*by).alias("_at"), F.lit(sign).alias("_n"), *[(sign * half).alias(f"_h{i}") for i, half in enumerate(halves)])

    rows = hashes(left, 1).unionByName(hashes(right.select(*left.columns), -1))
    inside = None
    for level in range(1, levels + 1):
        place = F.shiftrightunsigned("_at", 64 - level * DIGEST_BITS)
        sums = [F.sum(c).alias(c) for c in rows.columns if c != "_at"]
        known = rows if inside is None else rows.filter(inside(F.col("_at")))
        apart = known.groupBy(place.alias("_place")).agg(*sums).filter(" OR ".join(f"{c} <> 0" for c in rows.columns if c != "_at"))
        found = [r._place for r in apart.select("_place").limit(MOST_RANGES + 1).collect()]
        if not found:
            return None
        if len(found) > MOST_RANGES:  # too many to be worth telling apart; they lie in the ranges of the level above
            break
        inside = _in_ranges(found, 64 - level * DIGEST_BITS)
    return F.lit(True) if inside is None else inside(F.xxhash64(*by))


def _in_ranges(places: Sequence[int], shift: int):
    return lambda at: F.shiftrightunsigned(at, shift).isin(list(places))


def multiset_diff_by_digests(left: DataFrame, right: DataFrame, levels: int = 2) -> DataFrame:
    """``multiset_diff`` of tables that should be equal: only rows of ranges whose digests differ are compared."""
    apart = differing_ranges(left, right, left.columns, left.columns, levels)
    if apart is None:
        return multiset_diff(left.limit(0), right.limit(0))
    return multiset_diff(left.filter(apart), right.select(*left.columns).filter(apart))


def union_levels(prefixes: DataFrame, leaves: DataFrame, key: str = "key", flag: str = "is_prefix") -> DataFrame:
    """Sub-prefixes, each once, and leaves of one level under one another, told apart by ``flag``."""
    above = prefixes.select(key).distinct().withColumn(flag, F.lit(True))
    return above.unionByName(leaves.select(key).withColumn(flag, F.lit(False)))


def ordered_dedupe(df: DataFrame, values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each value."""
    return first_per_key(df, values, order)


def contains_rows(actual: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected rows without a counterpart, comparing only ``keys`` and only as text.

    The actual side is reduced to its distinct key texts, so its hot values cost
    one row each.
    """
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("None")).alias(f"_{k}") for k in keys]
    left = expected.select("*", *texts)
    right = actual.select(*texts).distinct()
    texts_of = [f"_{k}" for k in keys]
    return skew_join(left, right, texts_of, how="left_anti").drop(*texts_of)


def rows_equal(
    left: DataFrame, right: DataFrame, left_order: Sequence[Column | str], right_order: Sequence[Column | str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Position-by-position comparison of two ordered results as text: one row per differing position.

    All columns are compared, or the named ones; the order tuples must be unique.
    """

    def numbered(df: DataFrame, order: Sequence[Column | str], side: str) -> DataFrame:
        cells = F.array(*[cell_text(df, c) for c in columns or df.columns]).alias(side)
        return number_rows(df, order).select("position", cells)

    pairs = numbered(left, left_order, "left_cells").join(
        numbered(right, right_order, "right_cells"), "position", "full"
    )
    return pairs.filter(~F.col("left_cells").eqNullSafe(F.col("right_cells")))


def resolve_unique(candidates: DataFrame, requests: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """For each request the number of exact matches, the id if there is exactly one, and a verdict.

    ``on`` maps request column to candidate column.  Candidates are counted per
    match value before the join, so a name shared by most rows is one row.
    """
    per_value = candidates.groupBy(*on.values()).agg(
        F.count(F.lit(1)).alias("_matches"), F.min("id").alias("_id")
    )
    renamed = per_value.select(*[F.col(c).alias(r) for r, c in on.items()], "_matches", "_id")
    joined = skew_join(requests, renamed, list(on), how="left")
    matches = F.coalesce("_matches", F.lit(0))
    return joined.select(
        *requests.columns,
        matches.alias("matches"),
        F.when(matches == 1, F.col("_id")).alias("resolved_id"),
        F.when(matches == 1, "ok").when(matches == 0, "no match").otherwise("several matches").alias("verdict"),
    )


def scope_prefix(df: DataFrame, column: str, prefixes: Sequence[str]) -> DataFrame:
    """Rows whose id starts with an allowed prefix; no prefixes means no restriction."""
    if not prefixes:
        return df
    return df.filter(reduce(lambda a, b: a | b, [F.col(column).startswith(p) for p in prefixes]))


def scope_report(df: DataFrame, column: str, prefixes: Sequence[str]) -> DataFrame:
    """Shown and hidden row counts of the same scope."""
    allowed = reduce(lambda a, b: a | b, [F.col(column).startswith(p) for p in prefixes], F.lit(not prefixes))
    flag = F.coalesce(allowed, F.lit(False))
    return df.agg(F.count_if(flag).alias("shown"), F.count_if(~flag).alias("hidden"))


def id_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose id contains a match.  No match at all is an error, raised when the result is read.

    The error is a row of its own behind the matches, which fails where their count, taken in the same job, is zero.
    """
    import re

    re.compile(pattern)
    kept = df.filter(F.col(column).rlike(pattern))
    problem = F.raise_error(F.lit(f"no {column} matches {pattern!r}")).cast("boolean")
    none = kept.agg(F.count(F.lit(1)).alias("_n")).filter(F.when(F.col("_n") == 0, problem).otherwise(F.lit(False)))
    return kept.unionByName(none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]))
