"""Inventories of large prefixes, listed by the tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from fnmatch import fnmatchcase
from functools import reduce

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import materialize_counted, path_exists, qualified

#: entries of a folder that make up one batch
BATCH = 10_000
#: folders that a task lists in a round, before there are more tasks than ``most_tasks``
FOLDERS_PER_TASK = 8
_SCHEMA = "key string, size bigint, updated timestamp, is_directory boolean"
_ARROW = pa.schema([("key", pa.string()), ("size", pa.int64()), ("updated", pa.timestamp("us", "UTC")), ("is_directory", pa.bool_())])


def folder_inventory(spark: SparkSession, path: str, glob: str | None = None, most_tasks: int = 10_000) -> DataFrame:
    """Files below a folder, (bucket, key, uri, size, updated, is_directory), as ``file_inventory`` has them, and empty ones, too; no file status reaches the driver.

    One round per level of folders: the folders found in a round are dealt over the tasks of the next, so a prefix of any number of files
    is listed by many tasks; one folder's own entries are listed by one.  Rounds are checkpointed, every entry once.  Names that begin with a dot, or with an
    underscore and have no ``=``, are hidden.  ``glob`` is held against file names and knows ``*``, ``?`` and ``[...]``.  A folder that goes
    away meanwhile is empty; an absent root is an error.  Works on the file systems that Arrow knows.
    """
    if glob and re.search(r"[{}\\]|\[\^", glob):
        raise ValueError(f"a pattern of *, ? and [...] is needed, not {glob!r}")
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    bucket = qualified(spark, path).rstrip("/") + "/"
    root = re.sub("^file:/+", "file:///", bucket)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                yield from _entries(system, base, folder, glob)

    folders, n, rounds = spark.createDataFrame([("",)], "folder string"), 1, []
    while n:
        tasks = max(1, min(most_tasks, n, max(spark.sparkContext.defaultParallelism, n // FOLDERS_PER_TASK)))
        dealt = folders.repartition(tasks, "folder")
        found, n = materialize_counted(dealt.mapInArrow(listed, _SCHEMA), F.col("is_directory"))
        rounds.append(found.filter(~F.col("is_directory")))
        folders = found.filter("is_directory").select(F.concat("key", F.lit("/")).alias("folder"))
    files = reduce(DataFrame.unionByName, rounds)
    return files.select(F.lit(bucket).alias("bucket"), "key", F.concat(F.lit(root), "key").alias("uri"), "size", "updated", "is_directory")


def _system(root: str) -> tuple[arrow_fs.FileSystem, str]:
    """The root's file system and the root's place in it; a local path is taken as it is spelled, percent signs included."""
    if root.startswith("file:///"):
        return arrow_fs.LocalFileSystem(), root.removeprefix("file://")
    system, base = arrow_fs.FileSystem.from_uri(root)
    return system, base.rstrip("/") + "/"


def _entries(system: arrow_fs.FileSystem, base: str, folder: str, glob: str | None) -> Iterator[pa.RecordBatch]:
    """What lies directly in a folder, in batches."""
    rows: list[tuple] = []
    for info in system.get_file_info(arrow_fs.FileSelector(base + folder, allow_not_found=True)):
        name, nested = info.base_name, info.type == arrow_fs.FileType.Directory
        hidden = name.startswith(".") or (name.startswith("_") and "=" not in name)
        if hidden or (glob and not nested and not fnmatchcase(name, glob)):
            continue
        updated = None if nested or info.mtime_ns is None else info.mtime_ns // 1_000_000 * 1_000
        rows.append((folder + name, None if nested else info.size, updated, nested))
        if len(rows) == BATCH:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind.type) for values, kind in zip(zip(*rows), _ARROW)], schema=_ARROW)
