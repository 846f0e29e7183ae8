"""Starting, bounding, resuming and resetting streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidemill.session import stored_bytes
from tidemill.streaming.windows import MERGE_SESSIONS

IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


@dataclass(frozen=True)
class RunReport:
    """What a bounded run did.  Counts cover the progress entries the session keeps
    (``spark.sql.streaming.numRecentProgressUpdates``)."""

    finished: bool
    batches: int
    input_rows: int
    late_rows_dropped: int


def replay(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
    max_files: int | None = None, event_time: str | None = None,
) -> DataFrame:
    """Files as a stream.  ``event_time`` is cast to a zoned timestamp, which watermarks need."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(path)
    return rows if event_time is None else rows.withColumn(event_time, F.col(event_time).cast("timestamp"))


def report(query: StreamingQuery, finished: bool = True) -> RunReport:
    progress = query.recentProgress
    late = sum(int(s["numRowsDroppedByWatermark"]) for p in progress for s in p["stateOperators"])
    return RunReport(finished, len(progress), sum(int(p["numInputRows"]) for p in progress), late)


def bounded_run(
    stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append", fmt: str = "parquet",
    idle_batches: bool = True, partitions: int | None = None, merge_sessions: bool = True,
) -> RunReport:
    """Process everything available into files and stop.

    Files show up with the commit of their batch; a rerun on the same checkpoint
    continues behind the last commit.  ``idle_batches`` lets a last batch without
    input close what the watermark has passed; state that expires by the clock asks
    for such batches for ever, so a bounded run over it must turn them off.
    ``merge_sessions`` lets session windows merge in the map tasks first; all settings are put back once the run has started.
    ``partitions`` sets the number of state partitions, which a checkpoint keeps for
    good (see ``state_partitions``).
    """
    writer = stream.writeStream.format(fmt).outputMode(output_mode).option("path", path)
    settings = {IDLE_BATCHES: str(idle_batches).lower(), MERGE_SESSIONS: str(merge_sessions).lower()}
    return _finish(stream, writer, checkpoint, settings, partitions)


def bounded_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, output_mode: str = "append",
    partitions: int | None = None,
) -> RunReport:
    """The same with a function per micro-batch, which must be idempotent by batch id."""
    writer = stream.writeStream.outputMode(output_mode).foreachBatch(write)
    return _finish(stream, writer, checkpoint, {}, partitions)


def _finish(
    stream: DataFrame, writer: DataStreamWriter, checkpoint: str, settings: dict[str, str], partitions: int | None
) -> RunReport:
    """Start with settings of its own (a query keeps those of its start), then run to the end."""
    conf = stream.sparkSession.conf
    if partitions:
        settings = {**settings, SHUFFLE_PARTITIONS: str(partitions)}
    before = {name: conf.get(name) for name in settings}
    for name, value in settings.items():
        conf.set(name, value)
    try:
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            conf.set(name, value)
    query.awaitTermination()
    return report(query)


def state_partitions(spark: SparkSession, path: str, bytes_each: int = 64 << 20) -> int:
    """State partitions for a stream over files: one per ``bytes_each`` of input, at least one per
    core, at most the session's shuffle partitions.  Every one is a store to open in every batch."""
    wanted = max(stored_bytes(spark, path) // bytes_each, spark.sparkContext.defaultParallelism)
    return int(min(wanted, int(spark.conf.get(SHUFFLE_PARTITIONS))))


def run_timeout(query: StreamingQuery, seconds: float) -> RunReport:
    """Let a query run for a while; when the time is up it is stopped and the report says so."""
    finished = query.awaitTermination(seconds)
    if not finished:
        query.stop()
    return report(query, bool(finished))


def tail_follow(stream: DataFrame, time: str, start, interval: str = "2 seconds"):
    """A writer over events from ``start`` on, polling at the given interval."""
    return stream.filter(F.col(time) >= F.lit(start)).writeStream.trigger(processingTime=interval)


def checkpoint_for(root: str, job: str, epoch: int = 0) -> str:
    """Where a job keeps its progress.  The next epoch forgets it, so the next run reads everything again."""
    return f"{root.rstrip('/')}/{job}/epoch={epoch}"


def fan_out(sinks: Mapping[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """One micro-batch into several sinks, computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for sink in sinks.values():
                sink(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def append_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A batch into its own ``batch_id=`` folder; writing it twice leaves one copy."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
