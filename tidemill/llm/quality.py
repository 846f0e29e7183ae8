"""Ordinal regression on graded ratings: cumulative links over hashed words.

One weight vector scores a text; ordered thresholds cut the score into grades:
P(grade > k) = sigmoid(score - threshold_k).  The weights are fitted on a bounded sample of rated documents,
the scores are computed for all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.rows import SLICE_ROWS, map_rows, texts

BITS = 18
#: rated documents that are fitted on, at most; the bound on what reaches the driver
SAMPLE_ROWS = 12_000
WORDS = re.compile(r"[^\W\d_]+|\d|[^\w\s]+")


class _Slots(dict):
    """Word to its hash slot; starts afresh when it grows large."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, word: str) -> int:
        from xxhash import xxh32_intdigest

        if len(self) > 500_000:
            self.clear()
        slot = xxh32_intdigest(word.encode("utf-8", "replace")) & self.mask
        if len(word) <= 64:
            self[word] = slot
        return slot


def slots_of(text: str, slots: _Slots) -> list[int]:
    """The distinct hash slots of a text's words and marks, and of how often it says a word twice in a row."""
    words = WORDS.findall(text.lower())
    found = set(map(slots.__getitem__, set(words)))
    again = sum(map(eq, words, islice(words, 1, None)))
    found.add(slots[f" again {min(10, 20 * again // max(1, len(words)))}"])
    return list(found)


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by hash slot, and the thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray
    bits: int = BITS

    def score(self, slots: list[int]) -> float:
        return float(self.weights[slots].sum()) if slots else 0.0

    def tails(self, score: float) -> list[float]:
        """P(grade > k) for every threshold k."""
        return (1 / (1 + np.exp(np.clip(self.thresholds - score, -500, 500)))).tolist()


def _gradient(score: np.ndarray, grade: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of the mean negative log likelihood: by score, by threshold; and its value."""
    edges = np.concatenate([[-np.inf], cuts, [np.inf]])
    with np.errstate(over="ignore"):
        above = 1 / (1 + np.exp(-(edges[grade + 1] - score)))
        below = 1 / (1 + np.exp(-(edges[grade] - score)))
    chance = np.maximum(above - below, 1e-12)
    up, down = above * (1 - above), below * (1 - below)
    by_score = (up - down) / chance
    by_cut = np.zeros(len(cuts))
    np.add.at(by_cut, np.minimum(grade, len(cuts) - 1), np.where(grade < len(cuts), -up / chance, 0))
    np.add.at(by_cut, np.maximum(grade - 1, 0), np.where(grade > 0, down / chance, 0))
    return by_score, by_cut / len(score), float(-np.log(chance).mean())


def fit_ordinal(
    rows: list[tuple[list[int], int]], n_grades: int, bits: int = BITS, least_docs: int = 3, shrink: float = 1e-4, rounds: int = 400
) -> OrdinalModel:
    """Weights and thresholds by full-batch Adam; the same rows in any order give the same model up to rounding.

    A slot gets a weight if at least ``least_docs`` documents have it and its score statistic in the model without
    weights passes the bound that pure noise in as many slots would hardly pass; so rare words of single documents are not
    learnt by heart.  Grades that no row has are allowed; without rows the weights are zero and all thresholds lie in the middle.
    """
    if n_grades < 2:
        raise ValueError("two grades at least")
    grade = np.array([g for _, g in rows], np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(s) for s, _ in rows])
    slot = np.concatenate([np.asarray(s, np.int64) for s, _ in rows]) if rows else np.zeros(0, np.int64)
    return _fit(doc, slot, grade, n_grades, bits, least_docs, shrink, rounds)


def _fit(
    doc: np.ndarray, slot: np.ndarray, grade: np.ndarray, n_grades: int, bits: int = BITS, least_docs: int = 3, shrink: float = 1e-4, rounds: int = 400
) -> OrdinalModel:
    """The same from flat arrays: the document number and hash slot of every feature, the grade of every document."""
    weights, cuts = np.zeros(1 << bits), np.linspace(-0.5, 0.5, n_grades - 1) if n_grades > 2 else np.zeros(1)
    if not len(grade):
        return OrdinalModel(weights, cuts, bits)
    share = np.clip(np.cumsum(np.bincount(grade, minlength=n_grades))[:-1] / len(grade), 1e-6, 1 - 1e-6)
    cuts = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(n_grades - 1))
    pull = _gradient(np.zeros(len(grade)), grade, cuts)[0]
    count = np.bincount(slot, minlength=1 << bits)
    z = np.bincount(slot, weights=(pull - pull.mean())[doc], minlength=1 << bits) / np.sqrt(np.maximum(count, 1) * max(pull.var(), 1e-12))
    telling = (count >= least_docs) & (np.abs(z) > np.sqrt(2 * np.log(max(2, (count >= least_docs).sum()))))
    doc, slot = doc[telling[slot]], slot[telling[slot]]
    used, slot = np.unique(slot, return_inverse=True)
    w, steps = np.zeros(len(used)), cuts.copy()
    gap = np.log(np.maximum(np.diff(steps), 1e-3))  # thresholds stay ordered: first, then positive gaps
    state = np.concatenate([w, steps[:1], gap])
    m, v = np.zeros_like(state), np.zeros_like(state)
    size = len(used)
    for t in range(1, rounds + 1):
        w, first, gap = state[:size], state[size], state[size + 1 :]
        cuts = first + np.concatenate([[0], np.cumsum(np.exp(gap))])
        score = np.bincount(doc, weights=w[slot], minlength=len(grade))
        by_score, by_cut, _ = _gradient(score, grade, cuts)
        by_w = np.bincount(slot, weights=by_score[doc], minlength=size) / len(grade) + shrink * w
        tail = np.cumsum(by_cut[::-1])[::-1]
        step = np.concatenate([by_w, tail[:1], tail[1:] * np.exp(gap)])
        m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step * step
        state = state - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights[used] = state[:size]
    cuts = state[size] + np.concatenate([[0], np.cumsum(np.exp(state[size + 1 :]))])
    return OrdinalModel(weights, cuts, bits)


def fit_on_ratings(
    docs: DataFrame, ratings: DataFrame, n_grades: int, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
    sample_rows: int = SAMPLE_ROWS, bits: int = BITS,
) -> OrdinalModel:
    """A model fitted on at most ``sample_rows`` rated documents, those with the smallest hashed ids.

    An id that is rated more than once counts once, with its lowest grade; ratings outside 0..n_grades-1, NULL
    ratings and ratings without a document are ignored.  Of documents that share an id one is taken.
    Hash slots reach the driver, no text does.
    """
    grade = F.col(f"`{grade_col}`").cast("int")
    rated = ratings.select(F.col(f"`{id_col}`").alias("doc_id"), grade.alias("grade")).filter(grade.between(0, n_grades - 1))
    rated = rated.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    rated = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # so bounded, it may be broadcast
    chosen = texts(docs, id_col, text_col).join(F.broadcast(rated), "doc_id").select("doc_id", "grade", "text")

    def start():
        slots = _Slots(bits)
        return lambda rows: [(i, g, slots_of(t, slots)) for i, g, t in rows]

    kind = docs.schema[id_col].dataType.simpleString()
    hashed = map_rows(chosen, [("doc_id", kind), ("grade", "int"), ("slots", "array<int>")], start)
    one = hashed.groupBy("doc_id").agg(F.min(F.struct("slots", "grade")).alias("row"))
    found = one.select("doc_id", "row.slots", "row.grade").toArrow().sort_by("doc_id")
    slots = found["slots"].combine_chunks()
    doc = np.repeat(np.arange(len(found)), slots.value_lengths().to_numpy(zero_copy_only=False))
    return _fit(doc, slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64), found["grade"].to_numpy().astype(np.int64), n_grades, bits)


def grade_documents(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", least_tail: float = 0.7) -> DataFrame:
    """(doc_id, score, expected_grade, tail_1 .. tail_n, accepted): one row per input row.

    ``tail_k`` is P(grade >= k), the expected grade is their sum, and a document is accepted if its last tail
    is at least ``least_tail``.  A NULL text is graded as the empty one; repeated rows and NULL ids are
    graded like any other; an empty table gives no rows.
    """
    used = np.flatnonzero(model.weights)
    weight_of = dict(zip(used.tolist(), model.weights[used].tolist(), strict=True))
    cuts, bits = model.thresholds.tolist(), model.bits

    def start():
        slots = _Slots(bits)
        small = OrdinalModel(np.zeros(0), np.array(cuts), bits)

        def grade(rows: list) -> list[tuple]:
            made = []
            for key, text in rows:
                score = sum(sorted(filter(None, map(weight_of.get, slots_of(text, slots)))))
                tails = small.tails(score)
                made.append((key, score, sum(tails), *tails, tails[-1] >= least_tail))
            return made

        return grade

    kind = docs.schema[id_col].dataType.simpleString()
    tails = [(f"tail_{k + 1}", "double") for k in range(len(cuts))]
    fields = [("doc_id", kind), ("score", "double"), ("expected_grade", "double"), *tails, ("accepted", "boolean")]
    return map_rows(texts(docs, id_col, text_col), fields, start)


def graded_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the label table: 0 junk, 1 toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def accepted_documents(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", least_tail: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns, whatever those are called.

    Each row is judged by its own text where it is read, so nothing is shuffled and repeated ids do no harm.
    """
    used = np.flatnonzero(model.weights)
    weight_of = dict(zip(used.tolist(), model.weights[used].tolist(), strict=True))
    # tails fall with the threshold, so the last tail's bound is a bound on the score
    least = float(model.thresholds[-1] + np.log(least_tail / (1 - least_tail)))
    bits, place = model.bits, docs.columns.index(text_col)

    def run(batches):
        slots = _Slots(bits)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                found = [slots_of(t or "", slots) for t in part.column(place).to_pylist()]
                yield part.filter(pa.array([sum(sorted(filter(None, map(weight_of.get, s)))) >= least for s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
