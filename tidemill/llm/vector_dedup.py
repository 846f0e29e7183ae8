"""Near-duplicate vectors through an inverted multi-index.

Each half of a unit vector has a codebook of its own; the two nearest codewords name a cell of
the product grid.  A vector visits cells in the order of the sum of its two squared distances, until the excess
over its own cell passes a cutoff.  The cutoff is the smallest one that reaches the target recall on a sample of vectors, whose true
neighbours are found by brute force against all vectors.  What shares a visited cell is verified by cosine in double precision.

A cell that holds many vectors has a core: those so near its centre that any two of them are linked.  Their links with each other
are counted, not compared, so a large group of near copies costs what its members cost.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.components import connected_components
from tidemill.llm.rows import map_rows
from tidemill.operators.skew import dimension_join
from tidemill.session import materialize

#: vectors that the codebooks are fitted on, at most
FIT_ROWS = 16_384
#: vectors whose true neighbours set and measure the cutoff, at most
PROBE_ROWS = 4_096
#: share of the links that a cutoff has to reach, over all links and over the mean of the probes
TARGET_RECALL = 0.999
#: vectors of a cell that one task compares with as many visitors
BLOCK_ROWS = 1_024
#: codewords of a half, at most: the codebooks are sent to every task
MOST_WORDS = 2_048
#: vectors that a cell should hold, and with how many it gets a core
CELL_ROWS, CORE_ROWS = 64, 256
BINS = 4_000


@dataclass(frozen=True)
class Grid:
    """Two codebooks, and how far beyond its own cell a vector looks."""

    halves: tuple[np.ndarray, np.ndarray]
    cutoff: float
    #: share of links within the cutoff, of probes that did not set it (over all links, over the mean of the probes)
    recall: tuple[float, float] | None = None

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to the codewords of either half, one row per vector."""
        cut = self.halves[0].shape[1]
        return tuple(
            np.maximum((part**2).sum(1)[:, None] + (book**2).sum(1) - 2 * part @ book.T, 0)
            for part, book in zip((units[:, :cut], units[:, cut:]), self.halves, strict=True)
        )

    def cells(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first.argmin(1) * len(self.halves[1]) + second.argmin(1)

    def visits(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Cells of one vector in the order of their distance, up to the cutoff; its own comes first.

        The multi-sequence order: both lists of distances are sorted, and only pairs on the
        staircase below the cutoff are ever formed.
        """
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        near, far = first[a], second[b]
        bound = near[0] + far[0] + self.cutoff
        found = []
        for i, d in enumerate(near):
            if d + far[0] > bound:
                break
            for j in range(np.searchsorted(far, bound - d, side="right") or 1):
                found.append((d + far[j], int(a[i]) * len(far) + int(b[j])))
        return [c for _, c in sorted(found, key=lambda x: x[0])]


def fit_books(units: np.ndarray, n_words: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """A codebook per half by k-means, started from the first distinct rows."""
    books, cut = [], units.shape[1] // 2
    for half in (units[:, :cut], units[:, cut:]):
        book = half[: max(1, min(n_words, len(half)))].copy()
        for _ in range(rounds):
            near = np.concatenate([((book**2).sum(1) - 2 * half[i : i + 4096] @ book.T).argmin(1) for i in range(0, len(half), 4096)])
            size = np.bincount(near, minlength=len(book))
            total = np.zeros_like(book)
            np.add.at(total, near, half)
            book = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], book)
        books.append(book)
    return tuple(books)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum())


def _units(raws: list[bytes], size: int) -> np.ndarray:
    """Unit vectors of ``size`` doubles from bytes of floats or doubles."""
    made = np.empty((len(raws), size))
    for i, raw in enumerate(raws):
        made[i] = _unit(np.frombuffer(raw, np.float32 if len(raw) == 4 * size else np.float64).astype(np.float64))
    return made


def unit_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, d, raw, key): a vector as bytes of floats, or of doubles where floats would not do, and a digest of its unit vector; NULL where there is none."""

    def told(vector) -> tuple:
        if not vector or any(x is None for x in vector):
            return None, None, None
        v = np.asarray(vector, np.float64)
        if not np.isfinite(v).all() or not v.any():
            return None, None, None
        with np.errstate(over="ignore"):
            short = v.astype(np.float32)
        raw = short if (short == v).all() else v
        return len(v), raw.tobytes(), hashlib.sha256(_unit(v).tobytes()).digest()

    kind = table.schema[id_col].dataType.simpleString()
    rows = table.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fields = [("vec_id", kind), ("d", "int"), ("raw", "binary"), ("key", "binary")]
    return map_rows(rows, fields, lambda: lambda rows: [(i, *told(v)) for i, v in rows])


def fit_grid(classes: DataFrame, size: int, threshold: float) -> Grid | None:
    """Codebooks and cutoff for (node, raw, copies) of ``size`` dimensions; None without classes.

    One half of the probes sets the cutoff, the other measures it; if it falls short of the target there, all probes set it.
    """
    count = classes.count()
    sample = classes.select("raw").orderBy(F.xxhash64("raw"), "raw").limit(FIT_ROWS).toPandas()["raw"].tolist()
    if not sample:
        return None
    units = _units(sample, size)
    words = int(np.clip(np.sqrt(count / CELL_ROWS), 1, min(MOST_WORDS, max(1, len(units) // 4))))
    grid = Grid(fit_books(units, words), 0.0)
    probes = units[:PROBE_ROWS]
    first, second = grid.distances(probes)
    own = first.min(1) + second.min(1)

    def start():
        def excess(rows: list) -> list[tuple]:
            them = _units([u for (u,) in rows], size)
            d = grid.distances(them)
            who, whom = np.nonzero(probes @ them.T >= threshold)
            far = first[who, d[0].argmin(1)[whom]] + second[who, d[1].argmin(1)[whom]] - own[who]
            bins = np.minimum(np.ceil(np.maximum(far, 0) * BINS / 4), BINS).astype(int)
            told, n = np.unique(who * (BINS + 1) + bins, return_counts=True)
            return [(k // (BINS + 1), k % (BINS + 1), c) for k, c in zip(told.tolist(), n.tolist(), strict=True)]

        return excess

    seen = map_rows(classes.select("raw"), [("probe", "int"), ("bin", "int"), ("n", "bigint")], start)
    seen = materialize(seen.groupBy("probe", "bin").agg(F.sum("n").alias("n")))
    totals = seen.groupBy("probe").agg((F.sum("n") - 1).alias("total")).filter("total > 0")  # without the probe itself
    other = F.col("n") - F.when(F.col("bin") == 0, 1).otherwise(0)
    shares = seen.join(totals, "probe").select((F.col("probe") % 2).alias("half"), "bin", other.alias("n"), (other / F.col("total")).alias("share"))
    reached = np.zeros((2, 2, BINS + 1))
    for r in shares.groupBy("half", "bin").agg(F.sum("n").alias("n"), F.sum("share").alias("share")).collect():  # at most 2 * (BINS + 1) rows
        reached[r.half, :, r.bin] = r.n, r.share

    def until(found: np.ndarray) -> int:
        """The first bin up to which both shares reach the target."""
        return max(int(np.searchsorted(np.cumsum(x), TARGET_RECALL * x.sum() - 1e-9)) for x in found) if found.any() else 0

    edge, recall = until(reached[0]), None
    if reached[1].any():
        recall = tuple(float(x[: edge + 1].sum() / x.sum()) for x in reached[1])
        if min(recall) < TARGET_RECALL:
            edge = max(edge, until(reached[1]), until(reached.sum(0)))
    return Grid(grid.halves, (edge + 1) * 4 / BINS, recall)


def _compare(group: pd.DataFrame, size: int, threshold: float) -> pd.DataFrame:
    """Links of one block of a cell with one block of its visitors: partial counts and a spanning forest."""
    home, guest = group[group["home"]], group[~group["home"]]
    columns = ["node", "links", "into"]
    if not len(home) or not len(guest):
        return pd.DataFrame([], columns=columns)
    h_node, g_node = home["node"].to_numpy(np.int64), guest["node"].to_numpy(np.int64)
    linked = _units(guest["raw"].tolist(), size) @ _units(home["raw"].tolist(), size).T >= threshold
    linked &= g_node[:, None] != h_node[None, :]
    if not linked.any():
        return pd.DataFrame([], columns=columns)
    # a pair that both sides find is counted where the smaller node is the guest
    cells, which = np.unique(guest["cell_of"].to_numpy(np.int64), return_inverse=True)
    seen = np.array([np.isin(cells, v) for v in home["visits"]]).T
    counted = linked & (~seen[which] | (g_node[:, None] < h_node[None, :]))
    g_links, h_links = counted @ home["copies"].to_numpy(np.int64), guest["copies"].to_numpy(np.int64) @ counted
    nodes, place = np.unique(np.concatenate([g_node, h_node]), return_inverse=True)
    g_at, h_at = place[: len(g_node)], place[len(g_node) :]
    label = np.arange(len(nodes))
    far = len(nodes)
    while True:
        before = label.copy()
        np.minimum.at(label, g_at, np.where(linked, label[h_at][None, :], far).min(1))
        np.minimum.at(label, h_at, np.where(linked, label[g_at][:, None], far).min(0))
        label = label[label]
        if (label == before).all():
            break
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, g_at, g_links)
    np.add.at(links, h_at, h_links)
    told = (links > 0) | (label != np.arange(len(nodes)))
    return pd.DataFrame({"node": nodes[told], "links": links[told], "into": nodes[label][told]})


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per input row.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing, nor do vectors of
    different lengths.  Equal vectors collapse to a class before anything is compared and count as links of
    each other.  ``component_id`` is the smallest id reachable, ``kept`` whether it is the row's own; rows
    that repeat an id are rows of their own; a NULL id is never a component's id unless no other is there.
    An empty table gives no rows.  A cell is compared block by block; only counts and a spanning forest leave a task.
    """
    rows = materialize(unit_vectors(table, id_col, vector_col))
    made = rows.filter("raw IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("d").alias("d"), F.first("raw").alias("raw")
    )
    classes = materialize(materialize(made).withColumn("node", F.monotonically_increasing_id()))
    parts = [
        _links(classes.filter(F.col("d") == r.d).select("node", "raw", "copies"), r.d, threshold)
        for r in classes.groupBy("d").count().collect()  # one row per vector length
    ]
    found = None
    for part in parts:
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = table.sparkSession.createDataFrame([], "node bigint, links bigint, into bigint")
    found = materialize(found)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("into").alias("b")))
    named = classes.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("component", "node"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "root").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = rows.join(materialize(named), "key", "left")
    component = F.when(F.col("raw").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _links(classes: DataFrame, size: int, threshold: float) -> DataFrame:
    """(node, links, into) of classes of one length: partial counts, and links of a spanning forest."""
    grid = fit_grid(classes, size, threshold)
    n_cells = len(grid.halves[0]) * len(grid.halves[1])

    def cell_of():
        return lambda rows: [(c,) for c in grid.cells(*grid.distances(_units([u for (u,) in rows], size))).tolist()]

    counts = map_rows(classes.select("raw"), [("cell", "int")], cell_of).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toArrow()
    homes = np.zeros(n_cells, np.int64)  # at most MOST_WORDS * MOST_WORDS numbers
    homes[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    # two vectors within half the angle of a centre are within the angle of each other
    half = np.cos(np.arccos(threshold) / 2 - 1e-6)

    def start():
        def place(rows: list) -> list[tuple]:
            units = _units([raw for _, raw, _ in rows], size)
            d = grid.distances(units)
            cells = grid.cells(*d)
            middle = np.concatenate([grid.halves[0][cells // len(grid.halves[1])], grid.halves[1][cells % len(grid.halves[1])]], axis=1)
            near = (units * middle).sum(1) >= half * np.sqrt((middle * middle).sum(1))
            core = near & (homes[cells] > CORE_ROWS) & (middle.any(1))
            made = []
            for (node, raw, copies), cell, own, a, b in zip(rows, cells.tolist(), core.tolist(), *d, strict=True):
                visits = [c for c in grid.visits(a, b) if homes[c] and not (own and c == cell)]
                made.append((node, raw, copies, cell, own, visits))
            return made

        return place

    fields = [("node", "bigint"), ("raw", "binary"), ("copies", "bigint"), ("cell_of", "int"), ("core", "boolean"), ("visits", "array<int>")]
    placed = materialize(map_rows(classes, fields, start))
    cores = placed.filter("core").select("node", "copies", F.col("cell_of").alias("cell"))
    heart = cores.groupBy("cell").agg(F.sum("copies").alias("all"), F.min("node").alias("into"))
    settled = dimension_join(cores, heart, ["cell"], "inner").select("node", (F.col("all") - F.col("copies")).alias("links"), "into")

    blocks = lambda n: F.greatest(F.ceil(F.col(n) / BLOCK_ROWS).cast("int"), F.lit(1))
    at_home = placed.groupBy(F.col("cell_of").alias("cell")).agg(F.count(F.lit(1)).alias("at_home"))
    calling = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("calling"))
    crowded = at_home.join(calling, "cell").filter((F.col("at_home") > BLOCK_ROWS) | (F.col("calling") > BLOCK_ROWS))
    crowded = materialize(crowded.select("cell", blocks("at_home").alias("hs"), blocks("calling").alias("gs")))
    spread = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["cell", "h", "g", "home", "node", "raw", "copies", "cell_of", "visits"]

    def dealt(rows: DataFrame) -> DataFrame:
        found = dimension_join(rows, crowded, ["cell"])
        return found.withColumns({n: F.coalesce(n, F.lit(1)) for n in ("hs", "gs")})

    home = dealt(placed.withColumn("cell", F.col("cell_of"))).withColumn("h", spread("hs")).withColumn("g", every("gs"))
    guest = placed.withColumn("cell", F.explode("visits")).withColumn("visits", F.lit(None).cast("array<int>"))
    guest = dealt(guest).withColumn("g", spread("gs")).withColumn("h", every("hs"))
    both = home.withColumn("home", F.lit(True)).select(*columns).unionByName(guest.withColumn("home", F.lit(False)).select(*columns))

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return _compare(group, size, threshold)

    # dealt out by block: by cell alone all blocks of a hot cell would meet in one task
    found = both.repartition("cell", "h", "g").groupBy("cell", "h", "g").applyInPandas(compare, "node long, links long, into long")
    return found.unionByName(settled)
