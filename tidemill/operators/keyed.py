"""Keyed updates: current state, change rows, table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.ordering import latest_per_key, with_previous

INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def current_state(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], is_delete: Column | None = None
) -> DataFrame:
    """The last row per key; keys whose last change is a delete are gone."""
    latest = latest_per_key(changes, keys, order)
    return latest if is_delete is None else latest.filter(~F.coalesce(is_delete, F.lit(False)))


def merge_state(state: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A stored state and a batch of changes as the next state.  The batch is reduced to one row per key first."""
    newest = latest_per_key(changes, keys, order)
    return latest_per_key(state.unionByName(newest), keys, order)


def to_changelog(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    is_delete: Column,
    slice_by: Column,
) -> DataFrame:
    """Change rows of keyed upserts and deletes.

    First sight of a key gives +I; another image gives -U (old) and +U (new); a
    delete gives -D (old image).  An unchanged image and a delete of an absent key
    give nothing.  Only the preceding change of the key is needed, fetched slice by
    slice, so a hot key stays parallel.
    """
    needed = dict.fromkeys([*keys, *order, *values])
    marked = changes.select(*needed, F.coalesce(is_delete, F.lit(False)).alias("_gone"), slice_by.alias("_cut"))
    paired = with_previous(marked, keys, order, [*values, "_gone"], F.col("_cut"))
    old = F.struct(*[F.col(f"previous.{v}").alias(v) for v in values])
    new = F.struct(*[F.col(v) for v in values])
    alive = F.col("previous").isNotNull() & ~F.col("previous._gone")

    def row(op: str, image: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), image.alias("image"))

    emitted = (
        F.when(F.col("_gone") & alive, F.array(row(DELETE, old)))
        .when(F.col("_gone"), F.array().cast(_row_type(marked, values)))
        .when(~alive, F.array(row(INSERT, new)))
        .when(~old.eqNullSafe(new), F.array(row(UPDATE_BEFORE, old), row(UPDATE_AFTER, new)))
        .otherwise(F.array().cast(_row_type(marked, values)))
    )
    return paired.select(*keys, *order, F.explode(emitted).alias("_row")).select(
        *keys, *order, "_row.op", *[F.col("_row.image")[v].alias(v) for v in values]
    )


def _row_type(df: DataFrame, values: Sequence[str]) -> T.ArrayType:
    image = T.StructType([df.schema[v] for v in values])
    return T.ArrayType(T.StructType([T.StructField("op", T.StringType()), T.StructField("image", image)]))


def append_only_check(changelog: DataFrame, op: str = "op") -> DataFrame:
    """How many rows an append-only sink could not take, by change kind; no rows means fit."""
    return changelog.filter(F.col(op) != INSERT).groupBy(op).agg(F.count(F.lit(1)).alias("rows"))


def table_profile(
    df: DataFrame, key: str, text: str, snapshots: int | Column = 1
) -> DataFrame:
    """Row count, distinct keys, key bounds and text bounds in one row.

    Rows are reduced to one per key value first (map-side partial counts), so the
    distinct count needs no second expansion of the data.
    """
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(text).alias("_lo"), F.max(text).alias("_hi")
    )
    versions = F.lit(snapshots) if isinstance(snapshots, int) else snapshots
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.count(key).alias("distinct_keys"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
        F.min("_lo").alias("min_text"),
        F.max("_hi").alias("max_text"),
    ).withColumn("snapshots", versions)


def profile_verdict(profile: DataFrame, expected: dict, schema_ok: bool = True, key_ok: bool = True) -> DataFrame:
    """One row per check of a profile, each with its verdict; ``all`` sums them up.

    ``expected`` holds count, min_key, max_key and text: rows and distinct keys must
    both equal the count, the text must be that single value, and at least one
    snapshot must exist.
    """
    checks = {
        "schema": F.lit(schema_ok),
        "primary_key": F.lit(key_ok),
        "row_count": F.col("row_count") == expected["count"],
        "distinct_keys": F.col("distinct_keys") == expected["count"],
        "min_key": F.col("min_key") == expected["min_key"],
        "max_key": F.col("max_key") == expected["max_key"],
        "single_text": (F.col("min_text") == expected["text"]) & (F.col("max_text") == expected["text"]),
        "snapshots": F.col("snapshots") >= 1,
    }
    passed = {name: F.coalesce(check, F.lit(False)) for name, check in checks.items()}
    everything = F.lit(True)
    for check in passed.values():
        everything = everything & check
    rows = [F.struct(F.lit(n).alias("check"), c.alias("passed")) for n, c in {**passed, "all": everything}.items()]
    return profile.select(F.inline(F.array(*rows)))


def schema_rows(df: DataFrame) -> DataFrame:
    """The column list of a DataFrame: ordinal, name, type, nullable."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, name string, type string, nullable boolean")


def schema_match(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Column-by-column comparison by position; types compare without regard to case."""
    a, e = schema_rows(actual).alias("a"), expected.alias("e")
    same = (
        F.col("a.name").eqNullSafe(F.col("e.name"))
        & F.lower("a.type").eqNullSafe(F.lower("e.type"))
        & F.col("a.nullable").eqNullSafe(F.col("e.nullable"))
    )
    return a.join(e, F.col("a.ordinal") == F.col("e.ordinal"), "full").select(
        F.coalesce("a.ordinal", "e.ordinal").alias("ordinal"),
        F.col("a.name").alias("actual_name"),
        F.col("e.name").alias("expected_name"),
        F.col("a.type").alias("actual_type"),
        F.col("e.type").alias("expected_type"),
        same.alias("matches"),
    )
