"""Token-id files in directly addressable codes.

An id is cut into chunks of eight bits, lowest first.  Level k of a file holds the k-th chunk
of every id that has one, and a bitmap with a one where a further chunk follows; a directory
holds the number of ones before every block of 512 bits.  The place of an id's next chunk is
the rank of its bit, so any id or run of ids is read from its own bytes alone, whatever
stands before it.

    file   := magic, levels, index, footer
    level  := chunks (1 byte each), bitmap (bits from the lowest), directory (uint32 each)
    index  := Arrow stream of (doc_id, first, n_tokens), first counted in the file
    footer := JSON of the places, its length (uint32), magic
"""

from __future__ import annotations

import io
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm.rows import SLICE_ROWS, texts
from tidemill.llm.tokens import encoder
from tidemill.session import materialize

MAGIC = b"DACIDS01"
BLOCK = 512
#: ids after which a task begins its next file
FILE_TOKENS = 1 << 23


def open_path(path: str):
    """The file system of a path or URI, and the path on it."""
    return arrow_fs.FileSystem.from_uri(path)


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, directory) of each level."""
    levels, rest = [], ids.astype(np.uint32, copy=False)
    while len(rest) or not levels:
        more = rest >> 8
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-len(bits) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
        padded[: len(bits)] = bits
        ones = np.bitwise_count(padded.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.int64)
        directory = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)
        levels.append(((rest & 255).astype(np.uint8), bits, directory))
        rest = more[goes_on]
    return levels


def write_file(path: str, ids: np.ndarray, index: pa.Table) -> None:
    """The whole file under a name of its own first, so that a lost task leaves no half file."""
    places, at, out = [], len(MAGIC), [MAGIC]
    for level in levels_of(ids):
        place = {"n": len(level[0])}
        for name, part in zip(("chunks", "bitmap", "directory"), level, strict=True):
            place[name] = at
            out.append(part.tobytes())
            at += part.nbytes
        places.append(place)
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, index.schema) as stream:
        stream.write_table(index)
    out.append(sink.getvalue())
    footer = json.dumps({"n_tokens": len(ids), "levels": places, "index": [at, len(sink.getvalue())]}).encode()
    out += [footer, struct.pack("<I", len(footer)), MAGIC]
    files, target = open_path(path)
    draft = f"{target}.{np.random.default_rng().integers(1 << 62):x}"
    with files.open_output_stream(draft) as stream:
        for part in out:
            stream.write(part)
    files.move(draft, target)


class TokenFile:
    """Random access to the ids of one file."""

    def __init__(self, path: str):
        files, target = open_path(path)
        self._file = files.open_input_file(target)
        size = self._file.size()
        length, magic = struct.unpack("<I8s", self._read(size - 12, 12))
        if magic != MAGIC or self._read(0, 8) != MAGIC:
            raise ValueError(f"{path} is not a token file")
        footer = json.loads(self._read(size - 12 - length, length))
        self.n_tokens, self._levels, self._index = footer["n_tokens"], footer["levels"], footer["index"]

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *_) -> None:
        self._file.close()

    def _read(self, at: int, length: int) -> bytes:
        self._file.seek(at)
        return self._file.read(length)

    def index(self) -> pa.Table:
        return pa.ipc.open_stream(self._read(*self._index)).read_all()

    def _rank(self, level: dict, at: int) -> int:
        """The ones of a level's bitmap before position ``at``."""
        block = at // BLOCK
        before = struct.unpack("<I", self._read(level["directory"] + 4 * block, 4))[0]
        rest = at - block * BLOCK
        if not rest:
            return before
        bits = np.frombuffer(self._read(level["bitmap"] + block * (BLOCK // 8), -(-rest // 8)), np.uint8)
        return before + int(np.unpackbits(bits, bitorder="little")[:rest].sum())

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (exclusive); only their own chunks and bits are read."""
        if not 0 <= start <= stop <= self.n_tokens:
            raise IndexError(f"{start}:{stop} of {self.n_tokens}")
        parts = []
        for level in self._levels:
            chunks = np.frombuffer(self._read(level["chunks"] + start, stop - start), np.uint8)
            first = start // 8
            bits = np.frombuffer(self._read(level["bitmap"] + first, -(-stop // 8) - first), np.uint8)
            goes_on = np.unpackbits(bits, bitorder="little")[start - 8 * first : stop - 8 * first].astype(bool)
            parts.append((chunks, goes_on))
            if not goes_on.any():
                break
            start = self._rank(level, start)
            stop = start + int(goes_on.sum())
        value = np.zeros(0, np.uint32)
        for chunks, goes_on in reversed(parts):
            own = chunks.astype(np.uint32)
            if len(value):
                own[goes_on] |= value << 8
            value = own
        return value


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write the ids of all texts, each with ``end_id`` behind it, in ascending order of the document id.

    Gives the manifest (part, file, path, n_docs, n_tokens, start); ``start`` counts the ids of all files before.  Documents are dealt
    out by ranges of (id, digest), so rows that repeat an id may be many and their order is defined:
    NULL ids first, ties by the text's digest.  A NULL text is empty and has the end id alone; an empty table writes
    no file.  A task holds one file's ids; a file's content follows from its rows, so a retried task writes the same.
    """
    kind = docs.schema[id_col].dataType
    rows = texts(docs, id_col, text_col).withColumn("digest", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest").select("doc_id", "text")
    index_schema = to_arrow_schema(T.StructType([T.StructField("doc_id", kind)])).append(pa.field("first", pa.int64()))
    index_schema = index_schema.append(pa.field("n_tokens", pa.int64()))
    out = T.StructType.fromDDL("part int, file int, path string, n_docs bigint, n_tokens bigint")
    out_arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, file = TaskContext.get().partitionId(), 0
        encode, end = encoder(tokenizer_path), np.uint32(end_id).tobytes()
        held, keys, firsts, lengths, total = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/ids-{part:06d}-{file:06d}.dac"
            index = pa.table([pa.array(keys, type=index_schema[0].type), firsts, lengths], schema=index_schema)
            write_file(path, np.frombuffer(b"".join(held), np.uint32), index)
            row = [[part], [file], [path], [len(keys)], [total]]
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(row, out_arrow, strict=True)], schema=out_arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    ids = encode.ids(text) + end
                    held.append(ids)
                    keys.append(key)
                    firsts.append(total)
                    lengths.append(len(ids) // 4)
                    total += len(ids) // 4
                    if total >= file_tokens:
                        yield flush()
                        held, keys, firsts, lengths, total = [], [], [], [], 0
                        file += 1
        if keys:
            yield flush()

    files, target = open_path(folder)
    files.create_dir(target, recursive=True)
    written = materialize(rows.mapInArrow(run, out))
    # one number per task reaches the driver
    totals = sorted((r.part, r.n) for r in written.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    starts, before = [], 0
    for part, n in totals:
        starts.append((part, before))
        before += n
    offsets = docs.sparkSession.createDataFrame(starts, "part int, before bigint")
    inside = F.sum("n_tokens").over(_files_of_a_part()) - F.col("n_tokens")
    return written.withColumn("inside", inside).join(offsets, "part").withColumn("start", F.col("before") + F.col("inside")).drop("before", "inside")


def _files_of_a_part():
    from pyspark.sql import Window

    return Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, 0)


def read_documents(manifest: DataFrame, id_kind: str = "bigint") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    out = T.StructType.fromDDL(f"doc_id {id_kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with TokenFile(row["path"]) as file:
                    index = file.index()
                    first, length = (index.column(c).to_numpy() for c in ("first", "n_tokens"))
                    crc = [zlib.crc32(file.ids(int(a), int(a + n)).tobytes()) for a, n in zip(first, length, strict=True)]
                columns = [index.column("doc_id").combine_chunks(), pa.array(first + row["start"]), pa.array(length), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    # by number, so that as many tasks read as have written, however short the manifest
    parts = max(1, manifest.agg(F.count_distinct("part")).first()[0])
    spread = manifest.select("path", "start").repartition(parts, "path")
    return spread.mapInArrow(run, out)
