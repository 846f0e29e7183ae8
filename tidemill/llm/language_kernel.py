"""Languages by string kernels.

A text is the set of its n-grams of one to three letters within words, word ends included.  The kernel of two texts is the number of
n-grams they share, over the geometric mean of their own numbers.  Some rated texts are landmarks: a text's kernels
with them, whitened by the landmarks' own kernel matrix, are its Nystroem features, on which one ridge regression per language
is fitted against all others.  Whitening and weights are one matrix on the landmarks' n-grams, so that a batch of texts is scored by one
product of its presence matrix with it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.rows import map_rows
from tidemill.operators.ordering import top_n_per_group
from tidemill.session import materialize

#: texts that the regressions are fitted on, at most, as many of each language as there are; and of one language, at most
FIT_ROWS, ROWS_PER_LANGUAGE = 8_192, 2_048
#: landmarks among them, and n-grams of a landmark, at most: a bound on what reaches the driver
LANDMARKS, LANDMARK_GRAMS = 256, 16_384
RIDGE = 1e-4
UNKNOWN = "und"
#: texts and characters taken at a time
BATCH_ROWS, BATCH_CHARS = 256, 1 << 20
#: cells of a presence table; a batch with more is sorted instead
TABLE_CELLS = 1 << 26
NO_LETTER = re.compile(r"[\W\d_]")
WIDTH = 21  # bits of a letter: code point + 2, or 1 for a word's end


class Letters:
    """What every code point is: 0 neither, 1 a mark that belongs to a letter, 2 a letter; looked up when first met."""

    def __init__(self):
        self.kinds = np.full(0x110000, 255, np.uint8)

    def of(self, points: np.ndarray) -> np.ndarray:
        found = self.kinds[points]
        if (found == 255).any():
            for p in np.unique(points[found == 255]).tolist():
                self.kinds[p] = {"L": 2, "M": 1}.get(unicodedata.category(chr(p))[0], 0)
            found = self.kinds[points]
        return found


def _points(text: str) -> np.ndarray:
    return np.frombuffer(("\n" + text.lower()).encode("utf-32-le", "replace"), np.uint32)


def batch_grams(texts: list[str], letters: Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which text, which n-gram, without repeats and in that order; and whether each text has a letter."""
    parts = [_points(t) for t in texts]
    points = np.concatenate([*parts, np.full(1, 10, np.uint32)])
    doc = np.repeat(np.arange(len(texts) + 1), [*map(len, parts), 1])
    kinds = letters.of(points)
    has = np.zeros(len(texts) + 1, bool)
    has[doc[kinds == 2]] = True
    inside = kinds > 0
    kept = inside | np.append(inside[1:], False)  # of what parts two words, only the last character
    kept[-1] = True
    values, doc = np.where(inside, points + 2, 1)[kept], doc[kept]
    mark = np.zeros(0x110002, np.int32)
    mark[values] = 1
    alphabet = np.flatnonzero(mark)
    mark[alphabet] = np.arange(1, len(alphabet) + 1)
    dense, base = mark[values].astype(np.int64), len(alphabet) + 1
    pairs = dense[:-1] * base + dense[1:]
    word = values > 1
    keys = np.concatenate([
        (doc * base**3 + dense)[word],
        (doc[:-1] * base**3 + pairs)[word[:-1] | word[1:]],
        (doc[:-2] * base**3 + pairs[:-1] * base + dense[2:])[word[1:-1]],
    ])
    if len(texts) * base**3 <= TABLE_CELLS:
        there = np.zeros(len(texts) * base**3, bool)
        there[keys] = True
        keys = np.flatnonzero(there)
    else:
        keys = np.unique(keys)
    doc, rest = np.divmod(keys, base**3)
    spelt = np.append(0, alphabet)
    grams = spelt[rest // base**2] << 2 * WIDTH | spelt[rest // base % base] << WIDTH | spelt[rest % base]
    return doc, grams, has[:-1]


def text_grams(text: str, letters: Letters) -> tuple[np.ndarray, bool]:
    """A long text's n-grams, taken from stretches of whole words."""
    grams, has, at = np.zeros(0, np.int64), False, 0
    while at < len(text):
        gap = NO_LETTER.search(text, at + BATCH_CHARS)
        stop = gap.end() if gap else len(text)
        _, found, letter = batch_grams([text[at:stop]], letters)
        grams, has, at = np.union1d(grams, found), has or bool(letter[0]), stop
    return grams, has


def grams_of(texts: list[str | None], letters: Letters) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(places, which of them, n-grams, has a letter) batch by batch; NULL is taken as the empty text."""
    batch, size = [], 0

    def of(places: list[int]):
        doc, grams, has = batch_grams([texts[i] or "" for i in places], letters)
        return np.array(places), doc, grams, has

    for i, text in enumerate(texts):
        n = len(text or "")
        if n > BATCH_CHARS:
            grams, has = text_grams(text, letters)
            yield np.array([i]), np.zeros(len(grams), np.int64), grams, np.array([has])
            continue
        if batch and (size + n > BATCH_CHARS or len(batch) == BATCH_ROWS):
            yield of(batch)
            batch, size = [], 0
        batch.append(i)
        size += n
    if batch:
        yield of(batch)


@dataclass(frozen=True)
class KernelModel:
    """The landmarks' n-grams, their weight for every language, and the languages in order."""

    grams: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    languages: list[str]

    def scores(self, n: int, doc: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """One row per text, one column per language."""
        return _kernels(n, doc, grams, self.grams, self.weights) + self.bias


def _kernels(n: int, doc: np.ndarray, grams: np.ndarray, known: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The presence matrix of ``n`` texts times ``columns``, over the roots of the texts' numbers of n-grams."""
    size = np.maximum(np.bincount(doc, minlength=n), 1)
    at = np.searchsorted(known, grams)
    at[at == len(known)] = 0
    there = known[at] == grams if len(known) else np.zeros(len(grams), bool)
    presence = np.zeros((n, len(known)), np.float32)
    presence[doc[there], at[there]] = 1
    return (presence @ columns).astype(np.float64) / np.sqrt(size)[:, None]


def landmark_matrix(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the landmarks, and one column per landmark: its presence over the root of its number of n-grams."""
    known = np.unique(np.concatenate(sets))
    columns = np.zeros((len(known), len(sets)), np.float32)
    for i, own in enumerate(sets):
        columns[np.searchsorted(known, own), i] = 1 / np.sqrt(len(own))
    return known, columns


def whitening(columns: np.ndarray) -> np.ndarray:
    """The inverse square root of the landmarks' kernel matrix, without its null space (landmarks that repeat one another)."""
    values, vectors = np.linalg.eigh(columns.T.astype(np.float64) @ columns)
    kept = values > 1e-6 * max(values.max(initial=0), 1e-12)
    return vectors[:, kept] / np.sqrt(values[kept])


def fit_ridge(features: np.ndarray, own: np.ndarray, n: int, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of ``n`` regressions on +1 and -1; every language weighs the same in all of them."""
    weight = 1 / np.bincount(own, minlength=n)[own]
    weight = weight / weight.sum()
    target = np.where(own[:, None] == np.arange(n), 1.0, -1.0)
    middle, level = weight @ features, weight @ target
    x, y = features - middle, target - level
    solved = np.linalg.solve((x * weight[:, None]).T @ x + ridge * np.eye(x.shape[1]), (x * weight[:, None]).T @ y)
    return solved, level - middle @ solved


def fit_languages(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS,
) -> KernelModel | None:
    """A model learnt from rows with a language for which ``learn`` (a condition on the columns of ``docs``) holds; None without any.

    Of each language the rows with the smallest hashed ids are taken, in turn, ``fit_rows`` in all; an id counts once.  What reaches the driver is bounded by the parameters above:
    n-grams of the landmarks and one row of kernels per text.
    """
    rows = docs.filter(learn).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.filter("doc_id IS NOT NULL AND lang IS NOT NULL")
    ids = rows.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ranked = top_n_per_group(ids, ["lang"], order, ROWS_PER_LANGUAGE, ["doc_id"]).orderBy("rank", *order).limit(fit_rows)
    chosen = rows.join(F.broadcast(ranked), ["doc_id", "lang"])  # at most fit_rows rows

    def start():
        letters = Letters()

        def spell(part: list) -> list[tuple]:
            made = [None] * len(part)
            for places, doc, grams, has in grams_of([r[3] for r in part], letters):
                cuts = np.searchsorted(doc, np.arange(len(places) + 1))
                for k, i in enumerate(places.tolist()):
                    own = grams[cuts[k] : cuts[k + 1]]
                    made[i] = (*part[i][:3], len(own) if has[k] else 0, own.astype("<i8").tobytes())
            return made

        return spell

    kind = docs.schema[id_col].dataType.simpleString()
    fields = [("doc_id", kind), ("lang", "string"), ("rank", "int"), ("n", "int"), ("grams", "binary")]
    spelt = map_rows(chosen.select("doc_id", "lang", "rank", "text"), fields, start).filter("n > 0")
    one = F.min(F.struct("n", "grams", "rank")).alias("row")
    spelt = materialize(spelt.groupBy("doc_id", "lang").agg(one).select("doc_id", "lang", "row.*"))
    marks = spelt.filter(F.col("n") <= LANDMARK_GRAMS).orderBy("rank", *order).limit(landmarks).select("grams").toArrow()
    if not marks.num_rows:
        return None
    known, columns = landmark_matrix([np.frombuffer(g, "<i8") for g in marks["grams"].to_pylist()])

    def kernels():
        def of(part: list) -> list[tuple]:
            sets = [np.frombuffer(g, "<i8") for _, _, g in part]
            doc = np.repeat(np.arange(len(sets)), [*map(len, sets)])
            rows = _kernels(len(sets), doc, np.concatenate(sets), known, columns)
            return [(key, lang, row.astype("<f4").tobytes()) for (key, lang, _), row in zip(part, rows, strict=True)]

        return of

    fields = [("doc_id", kind), ("lang", "string"), ("kernels", "binary")]
    met = map_rows(spelt.select("doc_id", "lang", "grams"), fields, kernels).toArrow().sort_by("doc_id")
    languages = sorted(set(met["lang"].to_pylist()))
    own = np.searchsorted(languages, met["lang"].to_pylist())
    white = whitening(columns)
    features = np.frombuffer(b"".join(met["kernels"].to_pylist()), "<f4").reshape(len(own), -1) @ white
    solved, bias = fit_ridge(features, own, len(languages))
    return KernelModel(known, (columns @ (white @ solved)).astype(np.float32), bias, languages)


def identify_languages(docs: DataFrame, model: KernelModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): one row per input row.

    The language with the highest regression value, the first in order among equal ones; ``score`` is that value moved from -1..1 to 0..1 and held there.
    A NULL text, one without a letter, and every text without a model is ``und`` with score 0.  Repeated rows and NULL ids are judged like any
    other; an empty table gives no rows.  No column but these two is read.
    """

    def start():
        letters = Letters()

        def judge(part: list) -> list[tuple]:
            made = [(key, UNKNOWN, 0.0) for key, _ in part]
            if model is None:
                return made
            for places, doc, grams, has in grams_of([t for _, t in part], letters):
                scores = model.scores(len(places), doc, grams)
                best = scores.argmax(1)
                top = np.clip((scores.max(1) + 1) / 2, 0, 1)
                for k in np.flatnonzero(has).tolist():
                    i = int(places[k])
                    made[i] = (part[i][0], model.languages[best[k]], float(top[k]))
            return made

        return judge

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_rows(rows, [("doc_id", kind), ("lang_pred", "string"), ("score", "double")], start)
