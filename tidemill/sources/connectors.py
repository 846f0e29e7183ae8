"""Sources that need a package or driver on the cluster's classpath.

The functions are thin on purpose: Spark's own connectors do the reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def bounded_topic_slice(
    spark: SparkSession, servers: str, topic: str, since_ms: int, schema: str
) -> DataFrame:
    """A topic from a timestamp to its latest offset; a malformed value fails the job."""
    raw = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingTimestamp", str(since_ms))
        .option("endingOffsets", "latest")
        .load()
    )
    return decode_topic(raw, schema)


def topic_stream(
    spark: SparkSession, servers: str, topic: str, schema: str, start: str = "earliest", max_offsets: int | None = None
) -> DataFrame:
    """The same topic as a stream: ``earliest`` replays it, ``latest`` takes only what is new."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return decode_topic(reader.load(), schema)


def decode_topic(raw: DataFrame, schema: str) -> DataFrame:
    """JSON values of a topic as columns, with their time and place."""
    value = F.from_json(F.col("value").cast("string"), schema, {"mode": "FAILFAST"})
    return raw.select(value.alias("_v"), "timestamp", "partition", "offset").select(
        "_v.*", F.col("timestamp").alias("topic_ts"), "partition", "offset"
    )


def jdbc_scan(
    spark: SparkSession, url: str, table: str, driver: str,
    predicate: str | None = None, limit: int | None = None,
    partition_column: str | None = None, lower: int | None = None, upper: int | None = None, partitions: int = 16,
    **options: str,
) -> DataFrame:
    """A bounded table scan: a narrow predicate, a limit, or a partitioned read of the whole table."""
    reader = spark.read.format("jdbc").option("url", url).option("driver", driver).options(**options)
    where = f" WHERE {predicate}" if predicate else ""
    if limit is not None:
        return reader.option("query", f"SELECT * FROM {table}{where} LIMIT {limit}").load()
    reader = reader.option("dbtable", f"(SELECT * FROM {table}{where}) scan" if predicate else table)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", partitions)
        )
    return reader.load()
