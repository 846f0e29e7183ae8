"""Where query modules put their queries, and how they read tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = pin_utc(spark), folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str, event_time: str | None = None) -> DataFrame:
        """The table's files as a stream.  The path ends in a one-letter class, because
        the file stream takes a lone file only as a pattern."""
        from tidemill.streaming.runs import replay

        schema = getattr(self, name).schema
        return replay(self.spark, f"{self.folder}/{name}.parque[t]", schema, event_time=event_time)


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name."""

    def put(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return put


def money(column: str) -> Column:
    """Exact decimals, so that sums do not depend on the order of their parts."""
    return F.col(column).cast("decimal(18,2)")


def shown(moment: Column | str) -> Column:
    """A time as text with microseconds."""
    column = F.col(moment) if isinstance(moment, str) else moment
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
