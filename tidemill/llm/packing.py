"""Best-fit packing of tokenised documents, improved by swap-based local search."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.rows import map_rows, texts
from tidemill.llm.tokens import encoder
from tidemill.session import materialize

#: pieces that one task packs together
GROUP_PIECES = 16_384
#: bins filled below this share are taken apart and packed anew across groups
GOOD_FILL = 0.99


def cut_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and its end id, in pieces of at most ``capacity``."""

    def start():
        encode, end = encoder(tokenizer_path), np.uint32(end_id).tobytes()
        step = 4 * capacity

        def cut(rows: list) -> list[tuple]:
            made = []
            for key, text in rows:
                ids = encode.ids(text) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    made.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            return made

        return cut

    kind = docs.schema[id_col].dataType.simpleString()
    fields = [("doc_id", kind), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint")]
    return map_rows(texts(docs, id_col, text_col), fields, start)


class Bins:
    """Bins of one group while they are searched; items are positions in ``lengths``."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.free: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that still takes it."""
        open_bins: list[tuple[int, int]] = []
        for item in sorted(range(len(self.lengths)), key=lambda i: (-self.lengths[i], i)):
            need = self.lengths[item]
            at = bisect_left(open_bins, (need, -1))
            if at < len(open_bins):
                room, number = open_bins.pop(at)
                self.items[number].append(item)
            else:
                room, number = self.capacity, len(self.items)
                self.items.append([item])
                self.free.append(0)
            self.free[number] = room - need
            if room > need:
                insort(open_bins, (room - need, number))

    def search(self, steps: int | None = None) -> None:
        """Shift tokens out of the emptier of two bins, the emptiest first, until bins are empty.

        A step moves an item, swaps one for one or two for one between any two underfull bins; each is
        taken only if the sum of squared fills grows, so the search ends by itself.
        It stops at the volume bound, at ``steps`` steps if that is a number, or when no bin can improve any other.
        """
        need = -(-sum(self.lengths) // self.capacity)
        used = sum(1 for b in self.items if b)
        self._sizes, self._free = np.array(self.lengths, dtype=np.int64), np.array(self.free, dtype=np.int64)
        self._bin = np.empty(len(self.lengths), dtype=np.int64)
        for number, members in enumerate(self.items):
            self._bin[members] = number
        left, improved = float("inf") if steps is None else steps, True
        while improved and left > 0 and used > need:
            improved = False
            underfull = np.array([b for b, members in enumerate(self.items) if members and self._free[b]], dtype=np.int64)
            pool = np.flatnonzero(self._free[self._bin] > 0)  # a full bin stays full
            for source in underfull[np.argsort(-self._free[underfull], kind="stable")].tolist():
                while left > 0 and used > need and self.items[source] and self._improve(source, underfull, pool):
                    left, improved = left - 1, True
                    used -= not self.items[source]
        self.free = self._free.tolist()

    def _improve(self, source: int, underfull: np.ndarray, pool: np.ndarray) -> bool:
        """The step out of ``source`` that fills another bin best; False where there is none."""
        fill = self.capacity - int(self._free[source])
        if not self._free[source]:
            return False
        own: dict[int, list[int]] = {}
        for i in self.items[source]:
            own.setdefault(self.lengths[i], []).append(i)
        # a bin has few distinct lengths, since their sum is within the capacity: all pairs are tried
        singles, outs = np.zeros(self.capacity + 1, dtype=np.int64), np.zeros(self.capacity + 1, dtype=np.int64)
        sizes = np.fromiter(own, dtype=np.int64, count=len(own))
        singles[sizes] = sizes
        sums = (sizes[:, None] + sizes)[np.triu_indices(len(sizes), 1)]
        twice = [2 * n for n, members in own.items() if len(members) > 1]
        outs[sizes], outs[sums], outs[twice] = sizes, sums, twice
        singles, outs = np.maximum.accumulate(singles), np.maximum.accumulate(outs)  # the largest within each size

        targets = np.concatenate([underfull, self._bin[pool]])
        back = np.concatenate([np.zeros(len(underfull), dtype=np.int64), self._sizes[pool]])
        room = self._free[targets]
        most = np.minimum(room + back, self.capacity)
        shift = np.concatenate([singles[most[: len(underfull)]], outs[most[len(underfull) :]]]) - back
        grows = shift - room + self._free[source]  # half of what squared fill gains by each token
        good = np.flatnonzero((shift > 0) & (grows > 0) & (room > 0) & (room < self.capacity) & (targets != source))
        if not len(good):
            return False
        at = good[np.argmin((room[good] - shift[good]) * (1 << 40) - shift[good] * grows[good])]
        target, size = int(targets[at]), int(shift[at] + back[at])
        returned = int(pool[at - len(underfull)]) if at >= len(underfull) else None
        moved = own[size][:1] if size in own else next(
            [own[n][0], own[size - n][-1]] for n in own if size - n in own and (2 * n != size or len(own[n]) > 1)
        )
        for item in moved:
            self.items[source].remove(item)
            self.items[target].append(item)
            self._bin[item] = target
        if returned is not None:
            self.items[target].remove(returned)
            self.items[source].append(returned)
            self._bin[returned] = source
        self._free[target] -= shift[at]
        self._free[source] += shift[at]
        return True


def pack_lengths(lengths: list[int], capacity: int, steps: int | None = None) -> list[list[int]]:
    """Positions of ``lengths``, bin by bin."""
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.search(steps)
    return [b for b in bins.items if b]


def _pack_groups(pieces: DataFrame, n_groups: int, capacity: int, steps: int | None) -> DataFrame:
    """(key, length, sequence_id, offset, fill), every group packed by itself."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", kind="stable")
        keys, lengths = group["key"].tolist(), group["length"].tolist()
        rows = []
        for members in pack_lengths(lengths, capacity, steps):
            name, fill, at = min(keys[m] for m in members), sum(lengths[m] for m in members), 0
            for m in members:
                rows.append((keys[m], lengths[m], name, at, fill))
                at += lengths[m]
        return pd.DataFrame(rows, columns=["key", "length", "sequence_id", "offset", "fill"])

    numbered = pieces.select("key", "length", F.pmod(F.xxhash64("key"), F.lit(n_groups)).alias("group"))
    return numbered.groupBy("group").applyInPandas(pack, "key long, length long, sequence_id long, offset long, fill long")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
    group_pieces: int = GROUP_PIECES, steps: int | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece.

    Only documents longer than ``capacity`` are cut.  Full pieces are sequences of their own; the others are dealt
    out evenly to groups of bounded size by a number of their row, so neither a frequent length nor a repeated document makes a
    group large.  What is left in underfull bins is dealt out again and packed across the groups.
    A NULL or empty text is the end id alone; repeated rows and NULL ids are packed like any other; an empty table gives no rows.
    """
    pieces = materialize(cut_documents(docs, tokenizer_path, capacity, id_col, text_col, end_id))
    pieces = pieces.withColumn("key", F.monotonically_increasing_id())  # fixed, since it numbers stored rows
    part = pieces.filter(F.col("length") < capacity).select("key", "length")
    counted = part.count()
    first = materialize(_pack_groups(part, max(1, -(-counted // group_pieces)), capacity, steps))
    good = F.col("fill") >= int(GOOD_FILL * capacity)
    loose = first.filter(~good)
    again = _pack_groups(loose, max(1, -(-loose.count() // group_pieces)), capacity, steps)
    placed = first.filter(good).unionByName(again).select("key", "sequence_id", "offset")
    full = pieces.filter(F.col("length") == capacity).withColumn("sequence_id", F.col("key")).withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.filter(F.col("length") < capacity).join(materialize(placed), "key")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return full.select(*columns).unionByName(rest.select(*columns))
