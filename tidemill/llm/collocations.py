"""Phrase collocations from depth-truncated suffix trees, built group by group.

Every word begins a suffix of its piece, cut off after ``longest`` words.  Vertical partitioning counts words as prefixes first and
lengthens those that begin more suffixes than the memory budget allows, word by word; the prefixes are then grouped
so that a group's suffixes stay within the budget.  Each group's subtree is built by itself in one task, from leaves that
the map tasks have summed before the shuffle, and a phrase's count is the total of the leaves below its node.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.rows import SLICE_ROWS
from tidemill.operators.ordering import top_n_per_group
from tidemill.operators.skew import skew_join
from tidemill.session import materialize

#: suffixes of a group, at most, while there are fewer than BUCKETS groups; a longer prefix is lengthened
BUDGET = 1 << 20
#: prefixes are grouped by ranges of a 32-bit key, of which these are the finest
BUCKETS = 1 << 20
#: prefixes that are lengthened, at most: the budget grows where there would be more
MOST_HEAVY = 100_000
#: words that a map task sums up before it hands them over, and distinct ones among them
CHUNK_WORDS, CHUNK_VOCABULARY = 1 << 21, 1 << 20
#: bits of the filter of words that may be frequent
FILTER_BITS = 1 << 24
#: bytes of a text that are split at a time
STRETCH = 1 << 20

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
MARKS = re.compile(rb"[.,;:!?\n-\r]")
GAP = re.compile(rb"[ \t\n-\r.,;:!?]")
#: stands for a piece's end; a mark is never part of a word
END = b"."
MIX, TURN = 0x5BD1E995, 0x1B873593


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """A text's words, some at a time, with ``END`` between pieces."""
    at = 0
    while at < len(text):
        stop = at + STRETCH
        if stop < len(text):
            gap = GAP.search(text, stop)
            stop = gap.end() if gap else len(text)
        yield MARKS.sub(b" . ", text[at:stop].translate(LOWER)).split()
        at = stop


class Chunks:
    """Gathers texts and hands over word numbers language by language whenever enough have come."""

    def __init__(self, hand_over: Callable, depth: int):
        self.hand_over, self.depth = hand_over, depth
        self._fresh()

    def _fresh(self) -> None:
        numbers = count()
        self.numbers = defaultdict(numbers.__next__)
        self.streams: dict[str, list[np.ndarray]] = defaultdict(list)
        self.size = 0

    def add(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        for words in words_of(text):
            found = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
            end = self.numbers.get(END)
            self.streams[lang].append(found if end is None else np.where(found == end, np.int32(-1), found))
            self.size += len(found)
            if self.size >= CHUNK_WORDS or len(self.numbers) >= CHUNK_VOCABULARY:
                yield from self.flush(open_in=lang)
        self.streams[lang].append(np.full(1, -1, np.int32))

    def flush(self, open_in: str | None = None) -> Iterator[pa.RecordBatch]:
        """Hands all over; in the language whose text goes on, its last words are kept for the suffixes to come."""
        words = np.array([*self.numbers, None], object)[:-1]
        carried: list[bytes] = []
        for lang, parts in self.streams.items():
            stream = np.concatenate(parts)
            if not len(stream):
                continue
            begun = len(stream)
            if lang == open_in:
                begun = max(0, begun - self.depth + 1)
                carried = [END if i < 0 else words[i] for i in stream[begun:].tolist()]
            yield from self.hand_over(lang, words, np.concatenate([stream, np.full(self.depth, -1, np.int32)]), begun)
        self._fresh()
        if carried:
            again = [-1 if w == END else self.numbers[w] for w in carried]
            self.streams[open_in].append(np.array(again, np.int32))


def _over_texts(docs: DataFrame, schema: str, hand_over: Callable, depth: int) -> DataFrame:
    """``hand_over(lang, words, numbers, begun)`` on chunks of (lang, text); suffixes begin before ``begun``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(hand_over, depth)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    yield from chunks.add(lang, text)
        yield from chunks.flush()

    return docs.mapInArrow(run, schema)


def _key(lang: str, word: bytes) -> int:
    return zlib.crc32(lang.encode() + b"\0" + word)


def _key_column(word: str) -> Column:
    return F.crc32(F.concat(F.col("lang").cast("binary"), F.lit(b"\0"), F.col(word).cast("binary")))


def _longer(key, next_key):
    """The key of a prefix with one more word: the same in numpy and in Spark."""
    return (key * MIX + next_key * TURN) % (1 << 32)


@dataclass
class Partition:
    """How suffixes are dealt out: the words that may be frequent, the prefixes to lengthen, the group of every bucket."""

    frequent: np.ndarray
    heavy_words: frozenset = frozenset()
    heavy_pairs: frozenset = frozenset()
    group_of: np.ndarray | None = None

    def may_be_frequent(self, keys: np.ndarray) -> np.ndarray:
        slots = keys % FILTER_BITS
        return (self.frequent[slots >> 3] >> (slots & 7)) & 1 > 0


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) over all of (lang, text)."""

    def hand_over(lang: str, words: np.ndarray, numbers: np.ndarray, begun: int) -> Iterator[pa.RecordBatch]:
        found = numbers[:begun]
        n = np.bincount(found[found >= 0], minlength=len(words))
        told = np.flatnonzero(n)
        if len(told):
            column = pa.array(words[told].tolist(), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(told)), column, pa.array(n[told])], names=["lang", "word", "n"])

    counted = _over_texts(docs, "lang string, word string, n bigint", hand_over, 1)
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("f"))


def _frequent_filter(words: DataFrame) -> np.ndarray:
    """A bit for every slot that a frequent word's key falls in: ``FILTER_BITS`` bits, whatever the vocabulary."""
    slot = F.col("key") % FILTER_BITS
    parts = words.select((slot / 32_768).cast("int").alias("part"), (slot % 32_768).alias("bit"))
    rows = parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # at most FILTER_BITS / 32,768 rows of 4 KB
    bits = np.zeros(FILTER_BITS >> 3, np.uint8)
    for r in rows:
        bits[r.part * 4096 : (r.part + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return bits


def _pair_counts(docs: DataFrame, partition: Partition) -> DataFrame:
    """(lang, first, second, n): partial counts of the pairs that begin with a heavy word."""
    heavy = partition.heavy_words

    def hand_over(lang: str, words: np.ndarray, numbers: np.ndarray, begun: int) -> Iterator[pa.RecordBatch]:
        here = np.array([(lang, w) in heavy for w in words], bool)
        if not here.any():
            return
        a, b = numbers[:begun], numbers[1 : begun + 1]
        told = (a >= 0) & (b >= 0) & here[a]
        codes, n = np.unique(a[told].astype(np.int64) << 32 | b[told], return_counts=True)
        if len(codes):
            first, second = (pa.array(words[x].tolist(), pa.binary()).cast(pa.string()) for x in (codes >> 32, codes & 0xFFFFFFFF))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), first, second, pa.array(n)], names=["lang", "first", "second", "n"])

    return _over_texts(docs, "lang string, first string, second string, n bigint", hand_over, 2)


def partition_prefixes(docs: DataFrame, words: DataFrame, least: int, budget: int) -> tuple[Partition, DataFrame | None]:
    """Vertical partitioning: the prefixes' groups, and the counts of the pairs that had to be counted for it.

    Words are the first prefixes.  One with more than ``budget`` suffixes is lengthened by its next word, and a pair that still
    has too many by the third, where a suffix is a leaf.  Words below ``least`` begin or continue no phrase that counts.  Neighbouring key ranges are
    joined into groups of at most ``budget`` suffixes.  At most ``MOST_HEAVY`` words and pairs and ``BUCKETS`` sums reach the driver.
    """
    frequent = words.filter(F.col("f") >= least).withColumn("key", _key_column("word"))
    partition = Partition(_frequent_filter(frequent))
    total = frequent.agg(F.sum("f")).first()[0] or 0
    budget = max(budget, -(-total // MOST_HEAVY))
    long = F.col("f") > budget
    partition.heavy_words = frozenset((r.lang, r.word.encode()) for r in frequent.filter(long).select("lang", "word").collect())
    weights, pairs, spread = frequent.filter(~long).select("key", "f"), None, 0
    if partition.heavy_words:
        counted = _pair_counts(docs, partition).groupBy("lang", "first", "second").agg(F.sum("n").alias("f"))
        pairs = materialize(counted.filter(F.col("f") >= least))
        rows = pairs.filter(long).collect()
        partition.heavy_pairs = frozenset((r.lang, r["first"].encode(), r.second.encode()) for r in rows)
        spread = sum(r.f for r in rows)
        longer = pairs.filter(~long).select(_longer(_key_column("first"), _key_column("second")).alias("key"), "f")
        weights = weights.unionByName(longer)
    bucket = F.shiftright("key", 12).cast("int").alias("bucket")
    sums = weights.groupBy(bucket).agg(F.sum("f").alias("f")).toArrow()
    load = np.full(BUCKETS, spread / BUCKETS)
    load[sums["bucket"].to_numpy()] += sums["f"].to_numpy()
    partition.group_of = _groups(load, budget)
    return partition, pairs


def _groups(load: np.ndarray, budget: int) -> np.ndarray:
    """Group numbers of consecutive buckets, each group's load within the budget unless a single bucket's is not."""
    until = np.cumsum(load)
    groups, at, g = np.zeros(len(load), np.int32), 0, 0
    while at < len(load):
        before = until[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(until, before + budget, side="right")))
        groups[at:stop] = g
        at, g = stop, g + 1
    return groups


def _suffixes(docs: DataFrame, partition: Partition) -> DataFrame:
    """(group, lang, deep, words, size, leaves): a chunk's suffixes of one group, summed and packed; ``deep`` if their pairs are heavy."""
    schema = "group int, lang string, deep boolean, words binary, size int, leaves binary"

    def hand_over(lang: str, words: np.ndarray, numbers: np.ndarray, begun: int) -> Iterator[pa.RecordBatch]:
        keys = np.fromiter((_key(lang, w) for w in words), np.int64, len(words))
        numbers = np.where((numbers >= 0) & np.append(partition.may_be_frequent(keys), False)[numbers], numbers, -1).astype(np.int64)
        a, b, c = numbers[:begun], numbers[1 : begun + 1], numbers[2 : begun + 2]
        told = (a >= 0) & (b >= 0)
        leaves, n = np.unique(a[told] << 42 | b[told] << 21 | c[told] + 1, return_counts=True)
        a, b, c = leaves >> 42, leaves >> 21 & 0x1FFFFF, (leaves & 0x1FFFFF) - 1
        at, deep = keys[a], np.zeros(len(leaves), bool)
        long = np.array([(lang, w) in partition.heavy_words for w in words], bool)[a] if len(words) else deep
        at = np.where(long, _longer(at, keys[b]), at)
        place = {w: i for i, w in enumerate(words)} if partition.heavy_pairs else {}
        for own, first, second in partition.heavy_pairs:
            if own == lang and first in place and second in place:
                pair = place[first] << 21 | place[second]
                deep[np.searchsorted(leaves, pair << 21) : np.searchsorted(leaves, pair + 1 << 21)] = True
        kept = ~deep | (c >= 0)  # a heavy pair's own count is known
        at = np.where(deep, _longer(at, keys[c]), at)
        group = partition.group_of[at >> 12]
        order = np.lexsort((np.arange(len(group)), deep, group))
        order = order[kept[order]]
        if not len(order):
            return
        a, b, c, n, group, deep = (x[order] for x in (a, b, c, n, group, deep))
        cuts = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (deep[1:] != deep[:-1])))
        for start, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), len(group)], strict=True):
            used, own = np.unique(np.concatenate([a[start:stop], b[start:stop], c[start:stop]]), return_inverse=True)
            own = own.astype(np.int32) - (used[0] < 0)
            packed = np.concatenate([own, n[start:stop].astype(np.int32)])
            told = pa.compress(packed.tobytes(), "zstd", asbytes=True)
            row = (int(group[start]), lang, bool(deep[start]), b"\n".join(words[used[used >= 0]]), packed.nbytes, told)
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

    names = ["group", "lang", "deep", "words", "size", "leaves"]
    kinds = [pa.int32(), pa.string(), pa.bool_(), pa.binary(), pa.int32(), pa.binary()]
    return _over_texts(docs, schema, hand_over, 3)


def _subtree(rows: pa.Table, least: int) -> pa.Table:
    """(lang, first, second, third, f) of a group's nodes that are frequent; ``third`` is NULL for pairs."""
    made = {name: [] for name in ("lang", "first", "second", "third", "f")}
    trees = defaultdict(list)
    for lang, deep, *packed in zip(*(rows[c].to_pylist() for c in ("lang", "deep", "words", "size", "leaves")), strict=True):
        trees[lang, deep].append(packed)
    for (lang, deep), parts in trees.items():
        number = defaultdict(count().__next__)
        columns = []
        for words, size, leaves in parts:
            known = np.array([number[w] for w in words.split(b"\n")] + [-1], np.int64)
            a, b, c, n = np.frombuffer(pa.decompress(leaves, size, "zstd"), np.int32).reshape(4, -1)
            columns.append(np.stack([known[a], known[b], known[c], n]))
        a, b, c, n = np.concatenate(columns, axis=1)
        pairs, above = np.unique(a << 32 | b, return_inverse=True)
        leaves, which = np.unique(above.astype(np.int64) << 32 | c + 1, return_inverse=True)
        totals = np.zeros(len(leaves), np.int64)
        np.add.at(totals, which, n)
        words = np.array([*number], object)
        over = np.zeros(len(pairs), np.int64)
        np.add.at(over, leaves >> 32, totals)
        if not deep:
            told = np.flatnonzero(over >= least)
            _tell(made, lang, words, pairs[told], None, over[told])
        told = np.flatnonzero((totals >= least) & (leaves & 0xFFFFFFFF > 0))
        _tell(made, lang, words, pairs[leaves[told] >> 32], (leaves[told] & 0xFFFFFFFF) - 1, totals[told])
    return pa.table({k: pa.array(v, pa.int64() if k == "f" else pa.string()) for k, v in made.items()})


def _tell(made: dict, lang: str, words: np.ndarray, pairs: np.ndarray, third: np.ndarray | None, f: np.ndarray) -> None:
    said = lambda at: [w.decode() for w in words[at]]
    made["lang"] += [lang] * len(pairs)
    made["first"] += said(pairs >> 32)
    made["second"] += said(pairs & 0xFFFFFFFF)
    made["third"] += [None] * len(pairs) if third is None else said(third)
    made["f"] += f.tolist()


def count_phrases(docs: DataFrame, least: int, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(lang, word, f) of all words and (lang, first, second, third, f) of all frequent phrases of (lang, text)."""
    words = materialize(word_counts(docs))
    partition, pairs = partition_prefixes(docs, words, least, budget)
    trees = _suffixes(docs, partition).groupBy("group")
    nodes = trees.applyInArrow(lambda rows: _subtree(rows, least), "lang string, first string, second string, third string, f bigint")
    if partition.heavy_pairs:
        keys = [(lang, a.decode(), b.decode()) for lang, a, b in partition.heavy_pairs]
        known = docs.sparkSession.createDataFrame(keys, "lang string, first string, second string")  # at most MOST_HEAVY rows
        whole = pairs.join(known, ["lang", "first", "second"]).withColumn("third", F.lit(None).cast("string"))
        nodes = nodes.unionByName(whole)
    return words, materialize(nodes)


def mine_collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, covered: int = 50, first: int = 2_000, budget: int = BUDGET
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases of two or three words.

    ``a`` counts all occurrences of a phrase within pieces, overlaps included; ``l`` and ``r`` those of its parts at the
    cut with the lowest score floor(1,000,000 * a * a / (l * r)), ``n`` all words of the language.  Phrases below ``least`` are left out, and so
    is a pair that a frequent triple holds with at least ``covered`` percent of its occurrences.  Order: score and ``a`` descending, then phrase.
    A NULL language is ``und``, a NULL or empty text has no words, repeated rows count each time; an empty table gives no rows. Other
    columns, whatever their names, are not read.  Products are exact decimals of 38 digits, enough for 9 * 10^15 occurrences.
    """
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang")
    rows = docs.select(lang, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"))
    words, nodes = count_phrases(rows, least, budget)
    phrase = F.concat_ws(" ", "first", "second", "third")
    known = words.filter(F.col("f") >= least).select("lang", F.col("word").alias("part"), "f")
    known = known.unionByName(nodes.select("lang", phrase.alias("part"), "f"))
    cut = lambda k, head, rest: F.struct(F.lit(k).alias("k"), head.alias("head"), rest.alias("rest"))
    one = cut(1, F.col("first"), F.concat_ws(" ", "second", "third"))
    two = cut(2, F.concat_ws(" ", "first", "second"), F.col("third"))
    cuts = F.when(F.col("third").isNull(), F.array(one)).otherwise(F.array(one, two))
    sides = nodes.select("lang", phrase.alias("phrase"), F.col("f").alias("a"), F.explode(cuts).alias("at")).select("lang", "phrase", "a", "at.*")
    sides = skew_join(sides, known.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    sides = skew_join(sides, known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    score = F.expr("CAST(1000000 AS DECIMAL(7,0)) * (x * x) div (l * r)")
    scored = sides.withColumns({"x": exact("a", 16), "l": exact("l", 16), "r": exact("r", 16)}).withColumn("score", score.cast("long"))
    lowest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    found = scored.groupBy("lang", "phrase", "a").agg(lowest)
    inside = F.explode(F.array(F.concat_ws(" ", "first", "second"), F.concat_ws(" ", "second", "third"))).alias("phrase")
    around = nodes.filter("third IS NOT NULL").select("lang", inside, "f").groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    kept = found.join(around, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("around") < covered * F.col("a"), F.lit(True)))
    told = kept.select("lang", "phrase", "a", F.col("cut.l").cast("long").alias("l"), F.col("cut.r").cast("long").alias("r"), "cut.score")
    best = top_n_per_group(told, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], first, ["phrase"])
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
