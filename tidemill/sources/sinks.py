"""Batch sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from urllib.parse import urlsplit

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def print_rows(df: DataFrame, identifier: str = "", op: str | None = None) -> DataFrame:
    """Rows as print lines, ``identifier> op[values]``; show or write them as needed."""
    kind = F.col(op) if op else F.lit("+I")
    values = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns if c != op]
    lead = F.lit(f"{identifier}> " if identifier else "")
    return df.select(F.concat(lead, kind, F.lit("["), F.concat_ws(", ", *values), F.lit("]")).alias("line"))


def discard(df: DataFrame) -> int:
    """Run the whole plan and keep nothing but the number of rows."""
    seen = Observation("discard")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return seen.get["rows"]


def statement_set(shared: DataFrame, sinks: Mapping[str, Callable[[DataFrame], None]]) -> list[str]:
    """Several sinks fed from one computed input, which spills to disk when it does not fit."""
    kept = shared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for write in sinks.values():
            write(kept)
    finally:
        kept.unpersist()
    return list(sinks)


class UnsafeJob(ValueError):
    """A shadow run would have written outside its sandbox."""


def shadow_run(
    outputs: Mapping[str, DataFrame], shadows: Mapping[str, str]
) -> dict[str, DataFrame | None]:
    """Run every output of a job into its shadow: ``discard``, ``print`` or a ``file://`` path.

    Refused before anything runs when an output has no shadow, a shadow belongs to
    no output, or a path is not local.  Printed and written outputs come back as
    DataFrames.
    """
    unshadowed = sorted(set(outputs) - set(shadows))
    if unshadowed:
        raise UnsafeJob(f"no shadow for {', '.join(unshadowed)}")
    unknown = sorted(set(shadows) - set(outputs))
    if unknown:
        raise UnsafeJob(f"shadow without output: {', '.join(unknown)}")
    for name, shadow in shadows.items():
        if shadow not in ("discard", "print") and urlsplit(shadow).scheme != "file":
            raise UnsafeJob(f"the shadow of {name} is not local: {shadow}")
    seen: dict[str, DataFrame | None] = {}
    for name, df in outputs.items():
        shadow = shadows[name]
        if shadow == "discard":
            discard(df)
            seen[name] = None
        elif shadow == "print":
            seen[name] = print_rows(df, name)
        else:
            df.write.mode("overwrite").parquet(shadow)
            seen[name] = df.sparkSession.read.parquet(shadow)
    return seen


def result_export(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """A whole result as CSV files with a header each, written by the tasks."""
    df.write.mode("overwrite" if overwrite else "errorifexists").csv(path, header=True, escape='"')


def full_refresh(df: DataFrame, path: str) -> dict[str, object]:
    """Rebuild a stored dataset; rows ingested and the error, if any, are reported."""
    counted = Observation("refresh")
    try:
        df.observe(counted, F.count(F.lit(1)).alias("rows_ingested")).write.mode("overwrite").parquet(path)
        return {"status": "COMPLETED", "rows_ingested": counted.get["rows_ingested"], "error": None}
    except Exception as error:  # noqa: BLE001 - reported, as the refresh history shows it
        return {"status": "FAILED", "rows_ingested": 0, "error": str(error).splitlines()[0]}


def incremental_recompute(df: DataFrame, path: str, partition: str = "ds") -> None:
    """Replace only the partitions that ``df`` holds; running it twice gives the same table."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)


def partition_maintenance(spark: SparkSession, table: str, actions: Sequence[tuple[str, Mapping[str, str], str | None]]):
    """Add or drop partitions one by one: (``add``|``drop``, values, location); a failure is a row, not the end."""
    rows = []
    for verb, values, location in actions:
        spec = ", ".join(f"{k}='{_quoted(v)}'" for k, v in values.items())
        where = f" LOCATION '{_quoted(location)}'" if location else ""
        try:
            if verb == "add":
                spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec}){where}")
            elif verb == "drop":
                spark.sql(f"ALTER TABLE {table} DROP PARTITION ({spec})")
            else:
                raise ValueError(f"unknown action {verb!r}")
            rows.append((verb, spec, None))
        except Exception as error:  # noqa: BLE001 - per-partition report
            rows.append((verb, spec, str(error).splitlines()[0]))
    return spark.createDataFrame(rows, "action string, partition string, error string")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
