"""Keyed state fed by a stream: upsert tables and change rows.

A keyed table is a folder of ``batch_id=N`` partitions with at most one row per key
each.  A micro-batch only adds its own partition, so a batch costs its own size and
a retried batch overwrites itself.  Reading takes the last row per key; compaction
folds the partitions when there are many.  With filters (``keyfilters``) a few keys are read from the files that may hold them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemill.functions.time import time_literal
from tidemill.operators.keyed import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE, current_state, to_changelog
from tidemill.operators.ordering import latest_per_key
from tidemill.session import folder_names, make_folder, path_exists
from tidemill.streaming.keyfilters import by_buckets, files_with, read_files, write_filters


# the partition of a folded state; batches count from 0
FOLDED = -1


def keyed_table_sink(
    path: str, keys: Sequence[str], order: Sequence[str], compact_every: int | None = None, filters: bool = False
) -> Callable[[DataFrame, int], None]:
    """A per-batch function that upserts into the table at ``path``; deletes are kept as rows.

    With ``compact_every`` the table is folded after so many batches, with ``filters`` it can be read by key.  A retried batch
    writes its rows again next to a state that may hold them already, which changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = active_folder(spark, path)
        _store(latest_per_key(batch, keys, order), folder, batch_id, keys, filters)
        if compact_every and (batch_id + 1) % compact_every == 0:
            fold_keyed_table(spark, path, keys, order, batch_id, filters)

    return write


def _store(rows: DataFrame, folder: str, batch_id: int, keys: Sequence[str], filters: bool) -> None:
    """Write one partition, and its filters after it."""
    rows = by_buckets(rows, keys) if filters else rows
    rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
    if filters:
        write_filters(rows.sparkSession, folder, f"batch_id={batch_id}", keys)


def active_folder(spark: SparkSession, path: str, before_batch: int | None = None) -> str:
    """Where the table's rows are now: the folder that the newest pointer names, at first the path itself.

    A pointer's number is the last batch that its folder has folded; ``before_batch`` asks for the folder that was in use when that batch came.
    """
    names = [n for n in folder_names(spark, f"{path}.pointers") if before_batch is None or int(n) < before_batch]
    return f"{path}.folded-{max(names)}" if names else path


def fold_keyed_table(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], number: int, filters: bool = False
) -> None:
    """Write the state up to batch ``number`` as one partition of a new folder, then point to it; readers see the old folder or the new one.

    A pointer is an empty folder with a number for its name, so it appears at once.  Readers that began on
    the old folder can finish there; it is not removed.
    """
    name = f"{number:012d}"
    if name in folder_names(spark, f"{path}.pointers"):
        return
    state = latest_per_key(spark.read.parquet(active_folder(spark, path, number)).drop("batch_id"), keys, order)
    _store(state, f"{path}.folded-{name}", FOLDED, keys, filters)
    make_folder(spark, f"{path}.pointers/{name}")


def read_keyed_table(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str],
    is_delete: Column | None = None, before_batch: int | None = None, only: DataFrame | None = None,
) -> DataFrame:
    """The table's current state, or its state ahead of a batch, folds included.

    ``only``: the state of that frame's keys (NULL is one), read from the files whose filters may hold them; the keys are read twice.
    """
    folder = active_folder(spark, path, before_batch)
    stored = spark.read.parquet(folder)
    if only is not None:
        files = files_with(folder, stored.inputFiles(), only, keys)
        stored = read_files(spark, folder, files) if files else stored.limit(0)
    if before_batch is not None:
        stored = stored.filter(F.col("batch_id") < before_batch)
    stored = stored.drop("batch_id")
    if only is not None:
        # only the touched keys' rows are sorted out: the semi join comes first, the aggregate after
        asked = only.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        stored = stored.join(asked, same, "left_semi")
    return current_state(stored, keys, order, is_delete)


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored batch with its number of upserts."""
    return spark.read.parquet(active_folder(spark, path)).groupBy("batch_id").agg(F.count(F.lit(1)).alias("upserts"))


def compact_keyed_table(
    spark: SparkSession, path: str, target: str, keys: Sequence[str], order: Sequence[str]
) -> None:
    """Write the state as one partition of a new folder, under the last batch id; point readers to it after."""
    last = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    state = read_keyed_table(spark, path, keys, order)
    state.write.mode("overwrite").parquet(f"{target}/batch_id={last}")


def changelog_sink(
    table: str, changes: str, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
    is_delete: Column, slice_by: Column, compact_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A per-batch function that writes change rows to ``changes`` and the state to ``table``.

    The stored rows of the batch's keys stand in front of the batch as their past;
    the rest is the batch operator, slices included.  Only files whose filters may hold a key of the batch are opened for it, so a
    batch costs its own size however large the table is; ``compact_every`` folds it.  Batches must not be older than
    the stored state of their keys.
    """
    store = keyed_table_sink(table, keys, order, compact_every, filters=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        rows = batch.select(*batch.columns, F.lit(True).alias("_new"))
        try:
            if path_exists(spark, active_folder(spark, table, batch_id)):
                past = read_keyed_table(spark, table, keys, order, before_batch=batch_id, only=batch)
                rows = past.select(*batch.columns, F.lit(False).alias("_new")).unionByName(rows)
            log = to_changelog(rows, keys, [*order, "_new"], values, is_delete, slice_by)
            log.filter(F.col("_new")).drop("_new").write.mode("overwrite").parquet(f"{changes}/batch_id={batch_id}")
            store(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def _sorted(rows: pd.DataFrame, order: list[str]) -> pd.DataFrame:
    """Rows in order, NULL last; rows that are equal in it stay as they came."""
    columns = [rows[c].to_numpy() for c in reversed(order)]
    if any(c.dtype.kind not in "iufbM" for c in columns):
        return rows.sort_values(order, ignore_index=True, kind="stable")
    return rows.take(np.lexsort(columns))


def _tuples(rows: pd.DataFrame, mark: str, fields: list[T.StructField]) -> list[tuple]:
    """The rows of the columns with a mark (see ``_marked``), with None for what is missing."""
    columns = []
    for number, field in enumerate(fields):
        column = rows[f"{mark}{number}"]
        missing, values = column.isna().tolist(), column.tolist()
        given = int if isinstance(field.dataType, T.IntegralType) else None
        columns.append([None if gone else given(v) if given else v for v, gone in zip(values, missing)])
    return list(zip(*columns)) if columns else [()] * len(rows)


def _series(values: Sequence, field: T.StructField) -> pd.Series:
    """Values as a column; whole numbers keep all their digits beside a missing one."""
    if isinstance(field.dataType, T.IntegralType):
        return pd.Series(values, dtype="Int64")
    return pd.Series(values, dtype=object).infer_objects()


def _marked(mark: str, fields: Sequence[T.StructField]) -> list[Column]:
    """Columns under numbered names (no underscore in front, which a named tuple would drop).  Whole numbers travel as text: pandas would make them floats next to a NULL."""
    whole = lambda f: F.col(f.name).cast(f.dataType).cast("string") if isinstance(f.dataType, T.IntegralType) else F.col(f.name).cast(f.dataType)
    return [whole(f).alias(f"{mark}{n}") for n, f in enumerate(fields)]


#: groups that keys are dealt into, each with an image per key; a checkpoint keeps the number for good
KEY_BUCKETS = 4_096


def _bucket(fields: Sequence[T.StructField]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f.name).cast(f.dataType) for f in fields]), F.lit(KEY_BUCKETS)).alias("bucket")


class _ExpiringImages(StatefulProcessor):
    """Change rows against the last image of a key, which is forgotten after a while.

    A group is a bucket of keys: what Spark and pandas take for a group is far more than a key's rows cost.
    """

    def __init__(self, key: T.StructType, image: T.StructType, order: list[str], ttl_ms: int | None):
        self.key, self.image, self.order, self.ttl_ms = key, image, order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", self.key, self.image, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pending = _sorted(pd.concat(list(rows), ignore_index=True), self.order)
        known = self.last.exists()
        stored: dict[tuple, tuple | None] = {}
        held: dict[tuple, tuple | None] = {}
        shown: list[tuple] = []
        whose, images = _tuples(pending, "k", self.key.fields), _tuples(pending, "v", self.image.fields)
        for who, new, gone in zip(whose, images, pending["gone"].tolist()):
            if who not in held:
                held[who] = stored[who] = tuple(self.last.getValue(who)) if known and self.last.containsKey(who) else None
            # what a row finds: the row before it, and the stored image in front of the first
            image = held[who]
            held[who] = None if gone else new
            if gone and image is not None:
                shown.append((*who, DELETE, *image))
            elif not gone and image is None:
                shown.append((*who, INSERT, *new))
            elif not gone and new != image:
                shown += [(*who, UPDATE_BEFORE, *image), (*who, UPDATE_AFTER, *new)]
        for who, image in held.items():
            if image is not None:
                self.last.updateValue(who, image)
            elif stored[who] is not None:
                self.last.removeKey(who)
        if shown:
            kinds = [*self.key.fields, T.StructField("op", T.StringType()), *self.image.fields]
            yield pd.DataFrame({f.name: _series(values, f) for f, values in zip(kinds, zip(*shown))})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for who, image in zip(_tuples(initialState, "k", self.key.fields), _tuples(initialState, "v", self.image.fields)):
            self.last.updateValue(who, image)

    def close(self) -> None:
        pass


def expiring_changelog(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], delete: str,
    ttl_seconds: int | None = None, initial: DataFrame | None = None,
) -> DataFrame:
    """Change rows of a stream whose per-key state expires ``ttl_seconds`` after its last update.

    Needs the RocksDB state store; with a time to live, a bounded run needs
    ``idle_batches=False``.  ``initial``: images (keys and values, one row per key, see ``stored_images``) that a run with a
    fresh checkpoint starts from.  One bucket's rows of a micro-batch (``KEY_BUCKETS``) are one task's
    work, so bound the batch (files or offsets per trigger) where keys are hot, or
    use ``changelog_sink``, which splits them.
    """
    key, image = T.StructType([stream.schema[k] for k in keys]), T.StructType([stream.schema[v] for v in values])
    sorted_by = [f"o{n}" for n in range(len(order))]
    read = stream.select(
        _bucket(key.fields), *_marked("k", key.fields), *_marked("v", image.fields),
        *[F.col(c).alias(name) for c, name in zip(order, sorted_by)], F.coalesce(F.col(delete).cast("boolean"), F.lit(False)).alias("gone"),
    )
    first = None if initial is None else initial.select(_bucket(key.fields), *_marked("k", key.fields), *_marked("v", image.fields))
    return read.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_ExpiringImages(key, image, sorted_by, ttl_seconds and ttl_seconds * 1000),
        outputStructType=T.StructType([*key.fields, T.StructField("op", T.StringType()), *image.fields]), outputMode="Append",
        timeMode="ProcessingTime" if ttl_seconds else "None",
        initialState=None if first is None else first.groupBy("bucket"),
    )


def stored_images(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The state of a stopped ``expiring_changelog`` as a table, keys and values: as of its last batch, or of an earlier one."""
    reader = spark.read.format("statestore").option("stateVarName", "last")
    stored = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    return stored.select("user_map_key.*", "user_map_value.*")


def state_stores(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator, name, partitions, first_batch, last_batch) of the states that a checkpoint holds."""
    held = spark.read.format("state-metadata").load(checkpoint)
    return held.select(
        F.col("operatorId").alias("operator"), F.col("operatorName").alias("name"), F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"), F.col("maxBatchId").alias("last_batch"),
    ).distinct()


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def change_feed(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], time: str, start: datetime, snapshot: bool = True,
    is_delete: Column | None = None,
) -> DataFrame:
    """A change table from ``start`` on, with a ``phase``.

    The first rows are the ``snapshot`` of what the earlier changes left (one row per
    key, none where the last earlier change was a delete), the rest every later ``change`` in full, deletes included; without a
    snapshot, only the latter.
    """
    mark = time_literal(start, changes.schema[time].dataType.simpleString())
    later = changes.filter(F.col(time) >= mark).withColumn("phase", F.lit("change"))
    if not snapshot:
        return later
    held = current_state(changes.filter(F.col(time) < mark), keys, order, is_delete)
    return held.withColumn("phase", F.lit("snapshot")).unionByName(later)
