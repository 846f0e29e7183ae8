"""Hard negatives by threshold joins in the manner of L2AP.

Anchors meet all rows in blocks.  A block's rows are indexed dimension by dimension, those with the most energy first; the
dimensions behind which no anchor can gain its threshold any more, by the product of the suffix norms, are left
out of a row's postings.  Partial scores are accumulated over the postings, a pair is dropped as soon as its score and the product of the
remaining norms stay below the threshold, and what is left is completed exactly.  Thresholds come from a bounded sample of rows and are
lowered for those anchors whose windows have not filled.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.rows import map_rows
from tidemill.operators.ordering import top_n_per_group
from tidemill.session import materialize, materialize_counted

#: rows and anchors that meet in a task at a time
ROW_BLOCK, ANCHOR_BLOCK = 4_096, 1_024
#: rows that set the first thresholds, at most; they decide how much is looked at, never what is found
SAMPLE_ROWS = 2_048
#: dimensions that are accumulated between two looks at the bounds
STRIDE = 8
#: share of living pairs below which they are followed one by one
SPARSE = 0.1
#: rows that a first threshold should let through, in multiples of those asked for; a later one lets through so many times more
LET_THROUGH, LOWER_BY = 4, 8
SLACK = 1 + 1e-9
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def integer_rows(table: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(row, id, label, d, v): rows that take part, with floor(scale * x) of every component as bytes of the narrowest kind."""

    def components(vector) -> bytes | None:
        if any(x is None for x in vector):
            return None
        with np.errstate(all="ignore"):
            v = np.floor(np.asarray(vector, np.float64) * scale)
        if not np.isfinite(v).all():
            return None
        most = np.abs(v).max(initial=0)
        return v.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8").tobytes()

    ids, labels = (table.schema[c].dataType.simpleString() for c in (id_col, label_col))
    rows = table.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    ).filter("label IS NOT NULL AND v IS NOT NULL")
    fields = [("id", ids), ("label", labels), ("d", "int"), ("v", "binary")]
    made = map_rows(rows, fields, lambda: lambda part: [(i, k, len(v), components(v)) for i, k, v in part])
    return made.filter("v IS NOT NULL").select(F.monotonically_increasing_id().alias("row"), "id", "label", "d", "v")


def _matrices(d: pa.ChunkedArray, v: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: places and vectors."""
    placed = defaultdict(list)
    for at, (size, raw) in enumerate(zip(d.to_pylist(), v.to_pylist(), strict=True)):
        placed[size, len(raw) // size if size else 8].append((at, raw))
    parts = defaultdict(list)
    for (size, width), found in placed.items():
        kind = {2: "<i2", 4: "<i4", 8: "<f8"}[width]
        parts[size].append((np.array([at for at, _ in found]), np.frombuffer(b"".join(r for _, r in found), kind).reshape(len(found), size).astype(np.float64)))
    return {size: tuple(map(np.concatenate, zip(*found, strict=True))) for size, found in parts.items()}


def _suffix_norms(m: np.ndarray) -> np.ndarray:
    """Norms of what lies from each dimension on; the last column is zero."""
    squares = np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.append(squares, np.zeros((len(m), 1)), axis=1))


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All scores, in whole numbers of any size where doubles would round."""
    if x.shape[1] * np.abs(x).max(initial=0) * np.abs(y).max(initial=0) < EXACT:
        return x @ y.T
    whole = lambda m: np.array([[int(c) for c in r] for r in m], object).reshape(m.shape)
    return whole(x).dot(whole(y).T)


def threshold_join(x: np.ndarray, y: np.ndarray, least: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of all pairs allowed by ``may`` with x[i] . y[j] >= least[i], for whole-numbered vectors."""
    safe = x.shape[1] * np.abs(x).max(initial=0) * np.abs(y).max(initial=0) < EXACT
    bounded = (least > 0) if safe else np.zeros(len(x), bool)
    found = []
    if not bounded.all():  # no norm bounds a threshold that is not positive
        own = np.flatnonzero(~bounded)
        scores = _exact(x[own], y)
        i, j = np.nonzero(may[own] & (scores >= least[own][:, None]))
        found.append((own[i], j, scores[i, j]))
    if bounded.any():
        own = np.flatnonzero(bounded)
        i, j, scores = _indexed_join(x[own], y, least[own].astype(np.float64), may[own])
        found.append((own[i], j, scores))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _indexed_join(x: np.ndarray, y: np.ndarray, least: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = x.shape[1]
    energy = np.argsort(-(y * y).sum(0), kind="stable")
    x, y = x[:, energy], y[:, energy]
    x_norms, y_norms = _suffix_norms(x), _suffix_norms(y)
    # a row's postings end where no anchor reaches its threshold from there on
    reach = (x_norms / least[:, None]).max(0) * SLACK
    until = (y_norms * reach >= 1).sum(1)
    order = np.argsort(-until, kind="stable")
    order = order[: int((until > 0).sum())]
    y, y_norms, until, may = y[order], y_norms[order], until[order], may[:, order]
    postings = np.where(np.arange(size) < until[:, None], y, 0)
    partial = np.zeros((len(x), len(y)))
    # what the omitted dimensions can add, once a row's postings are through
    omitted = x_norms[:, until] * y_norms[np.arange(len(y)), until] * SLACK
    alive = may.copy()
    at = 0
    while at < size and alive.mean() > SPARSE if alive.size else False:
        stop = min(at + STRIDE, size)
        n = int((until > at).sum())
        if not n:
            break
        partial[:, :n] += x[:, at:stop] @ postings[:n, at:stop].T
        open_rows = int((until > stop).sum())
        rest = omitted.copy()
        rest[:, :open_rows] = np.outer(x_norms[:, stop], y_norms[:open_rows, stop]) * SLACK
        alive &= partial + rest >= least[:, None]
        at = stop
    i, j = np.nonzero(alive)
    score = partial[i, j]
    while at < size and len(i):
        stop = min(at + STRIDE, size)
        score = score + (x[i, at:stop] * postings[j, at:stop]).sum(1)
        rest = np.where(until[j] > stop, x_norms[i, stop] * y_norms[j, stop] * SLACK, omitted[i, j])
        kept = score + rest >= least[i]
        i, j, score, at = i[kept], j[kept], score[kept], stop
    # verification: the omitted dimensions of what is left
    score = score + np.concatenate([((x[a] * (y[b] - postings[b])).sum(1)) for a, b in _slices(i, j)] or [np.zeros(0)])
    kept = score >= least[i]
    return i[kept], order[j[kept]], score[kept]


def _slices(i: np.ndarray, j: np.ndarray, step: int = 1 << 16):
    return [(i[at : at + step], j[at : at + step]) for at in range(0, len(i), step)]


def _first(window: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of each window's first ``n``: higher scores, then lower ids."""
    order = np.lexsort((ids, -score, window))
    own = window[order]
    starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))[: len(own)]
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own))))
    return order[rank < n]


def _block(rows: pa.Table, anchors: pa.Table, same: bool, n: int) -> dict[str, list]:
    """A block's first ``n`` rows of each anchor's windows."""
    made = {c: [] for c in ("q", "slot", "row", "score")}
    if not rows.num_rows or not anchors.num_rows:
        return made
    their, ours = _matrices(rows["d"], rows["v"]), _matrices(anchors["d"], anchors["v"])
    labels = pa.concat_arrays([*rows["label"].chunks, *anchors["label"].chunks]).dictionary_encode().indices.to_numpy()
    row, q = rows["row"].to_numpy(), anchors["q"].to_numpy()
    ids = rows["id"].combine_chunks()
    # places in the order of ids; NULL comes last
    place = pa.compute.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
    windows = {c: anchors[c].to_pylist() for c in ("slots", "least", "most")}
    for d, (at_q, x) in ours.items():
        if d not in their:
            continue
        at_r, y = their[d]
        may = (labels[len(row) + at_q][:, None] == labels[at_r][None, :]) == same
        if same:
            may &= q[at_q][:, None] != row[at_r][None, :]
        lowest = np.array([min(windows["least"][a]) for a in at_q.tolist()], object)
        i, j, score = threshold_join(x, y, np.nextafter(lowest.astype(np.float64), -np.inf), may)
        for w in range(max(len(windows["slots"][a]) for a in at_q.tolist())):
            bound = lambda name, w=w: np.array([x[w] if w < len(x) else None for x in (windows[name][a] for a in at_q.tolist())], object)
            slot, least, most = bound("slots"), bound("least"), bound("most")
            there = np.array([s is not None for s in slot], bool)
            least, most = (np.where(there, b, 0).astype(object if score.dtype == object else np.float64) for b in (least, most))
            inside = there[i] & (score >= least[i]) & (score <= most[i])
            a, b, s = i[inside], j[inside], score[inside]
            best = _first(a, s, place[at_r[b]], n)
            made["q"] += q[at_q[a[best]]].tolist()
            made["slot"] += slot[a[best]].tolist()
            made["row"] += at_r[b[best]].tolist()
            made["score"] += [min(max(int(x), LEAST), MOST) for x in s[best].tolist()]
    return made


def _meet(rows: DataFrame, n_rows: int, anchors: DataFrame, n_anchors: int, same: bool, n: int) -> DataFrame:
    """(q, slot, row, id, score): the first ``n`` of every block for every window."""
    row_blocks, anchor_blocks = -(-n_rows // ROW_BLOCK), -(-n_anchors // ANCHOR_BLOCK)
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    own = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    left = rows.select("*", own("row", row_blocks).alias("r"), every(anchor_blocks).alias("a"))
    right = anchors.select("*", own("q", anchor_blocks).alias("a"), every(row_blocks).alias("r"))
    ids = rows.schema["id"].dataType
    schema = T.StructType.fromDDL(f"q bigint, slot int, row bigint, id {ids.simpleString()}, score bigint")

    def compare(them: pa.Table, us: pa.Table) -> pa.Table:
        made = _block(them, us, same, n)
        at = pa.array(made["row"], pa.int64())
        return pa.table({
            "q": pa.array(made["q"], pa.int64()), "slot": pa.array(made["slot"], pa.int32()),
            "row": them["row"].take(at) if them.num_rows else pa.array([], pa.int64()), "id": them["id"].take(at), "score": pa.array(made["score"], pa.int64()),
        })

    return left.groupBy("a", "r").cogroup(right.groupBy("a", "r")).applyInArrow(compare, schema)


def _armed(anchors: DataFrame, sample: pa.Table, n_rows: int, through: int, same: bool) -> DataFrame:
    """Anchors with a threshold for every window: at least the lowest score asked for, and so high that about ``through`` rows pass."""
    kept = [(c, t) for c, t in anchors.dtypes]
    fields = [*kept, ("least", "array<bigint>")]
    spot = {c: at for at, (c, _) in enumerate(kept)}
    rank = max(1, -(-through * sample.num_rows // max(1, n_rows)))

    def start():
        theirs = _matrices(sample["d"], sample["v"])
        labels = np.array(sample["label"].to_pylist(), object)

        def arm(part: list) -> list[tuple]:
            made = []
            for own in part:
                d, raw, label, lows, highs = (own[spot[c]] for c in ("d", "v", "label", "low", "most"))
                at, y = theirs.get(d, (np.zeros(0, int), np.zeros((0, d))))
                x = _matrices(pa.chunked_array([[d]]), pa.chunked_array([[raw]]))[d][1]
                scores = _exact(x, y)[0][(labels[at] == label) == same] if len(at) else np.zeros(0)
                least = []
                for low, high in zip(lows, highs, strict=True):
                    inside = sorted((int(s) for s in scores.tolist() if low <= s <= high), reverse=True)
                    least.append(inside[rank - 1] if len(inside) >= rank else low)
                made.append((*own, least))
            return made

        return arm

    return map_rows(anchors, fields, start)


def first_in_windows(rows: DataFrame, n_rows: int, anchors: DataFrame, same: bool, n: int, sample: pa.Table) -> DataFrame:
    """(q, slot, row, id, score, rank): the first ``n`` rows of every window of (q, label, d, v, slots, low, most).

    A window's rows have a score from ``low`` to ``most`` and the anchor's label (``same``; the anchor itself left out) or another one.
    Windows that have not filled above their threshold are looked for again, below a lower one.
    """
    left, n_left = materialize_counted(anchors)
    through, found = LET_THROUGH * n, None
    while n_left:
        armed = materialize(_armed(left, sample, n_rows, through, same))
        seen = _meet(rows, n_rows, armed, n_left, same, n)
        best = materialize(top_n_per_group(seen, ["q", "slot"], [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")], n, ["row"]))
        filled = best.groupBy("q", "slot").agg(F.count(F.lit(1)).alias("filled"))
        windows = armed.select("q", F.explode(F.arrays_zip("slots", "low", "most", "least")).alias("w")).select("q", F.col("w.slots").alias("slot"), "w")
        short = windows.join(filled, ["q", "slot"], "left").filter((F.coalesce("filled", F.lit(0)) < n) & (F.col("w.least") > F.col("w.low")))
        short = materialize(short.select("q", "slot", "w"))
        done = best.join(short.select("q", "slot"), ["q", "slot"], "left_anti")
        found = done if found is None else found.unionByName(done)
        again = short.groupBy("q").agg(F.collect_list("w").alias("w"))  # at most as many as the anchor has windows
        left, n_left = materialize_counted(
            left.drop("slots", "low", "most").join(again, "q").select("q", "label", "d", "v", *[F.col(f"w.{c}").alias(c) for c in ("slots", "low", "most")])
        )
        through *= LOWER_BY
    if found is None:
        ids = rows.schema["id"].dataType.simpleString()
        found = rows.sparkSession.createDataFrame([], f"q bigint, slot int, row bigint, id {ids}, score bigint, rank int")
    return found


def mine_hard_negatives(
    table: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of floor(scale * x); higher ones come first, ties by the smaller id (NULL last).  ``anchor`` is a condition on a column
    ``id``.  An anchor's positives are its first other rows of the same label; for each of them the first rows of other labels follow
    whose score lies between ``low`` and ``high`` percent of the positive's, so a negative positive score has none.  Rows with a NULL label or
    vector, or a NULL or non-finite component (also after scaling), take no part; vectors of different lengths do not meet.  Repeated rows
    are rows, and anchors, of their own.  Scores are exact; one beyond 64 bits is held at the greatest or least of them.  An empty table, or one without anchors,
    gives no rows.  Other columns, whatever their names, are not read.
    """
    rows, n_rows = materialize_counted(integer_rows(table, id_col, vector_col, label_col, scale))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).select("label", "d", "v").toArrow()
    anchors = rows.filter(anchor).withColumnRenamed("row", "q")
    whole = lambda name, value, kind: F.array(F.lit(value).cast(kind)).alias(name)
    asked = anchors.select("q", "label", "d", "v", whole("slots", 0, "int"), whole("low", LEAST, "bigint"), whole("most", MOST, "bigint"))
    friends = first_in_windows(rows, n_rows, asked, True, positives, sample)
    friends = materialize(friends.select("q", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    wide = F.col("positive_score").cast("decimal(19,0)")
    ranges = friends.select("q", "slot", F.ceil(wide * low / 100).cast("bigint").alias("low"), F.floor(wide * high / 100).cast("bigint").alias("most"))
    ranges = ranges.filter("low <= most").groupBy("q").agg(F.collect_list(F.struct("slot", "low", "most")).alias("w"))
    asked = anchors.join(ranges, "q").select("q", "label", "d", "v", F.col("w.slot").alias("slots"), F.col("w.low").alias("low"), F.col("w.most").alias("most"))
    foes = first_in_windows(rows, n_rows, asked, False, negatives, sample)
    named = anchors.select("q", F.col("id").alias("anchor_id")).join(friends, "q")
    return foes.join(named, ["q", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
