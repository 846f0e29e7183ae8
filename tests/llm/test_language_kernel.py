"""String kernels against plain sets, accuracy on held-out rows, odd rows."""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import language_kernel, queries
from tidemill.llm.language_kernel import Letters, batch_grams, fit_languages, fit_ridge, grams_of, identify_languages, landmark_matrix, whitening

TEXTS = ["Der Hund läuft.", "the  dog-runs 2day", "", "123 !?", "Ça va\tbien, É", "naïve ŒUVRE 中文 😀 हिन्दी", "a", "A\nb", "x" * 50, "İstanbul ǅ \x00 ß"]


def plain(text):
    """The set of n-grams as strings; a blank is a word's end."""
    kind = lambda c: unicodedata.category(c)[0] in "LM"
    words = "".join(c if kind(c) else "\n" for c in text.lower()).split("\n")
    padded = [f" {w} " for w in words if w]
    return {p[i : i + n] for p in padded for n in (1, 2, 3) for i in range(len(p) - n + 1)} - {" "}


def spelt(gram):
    letters = [gram >> shift & 0x1FFFFF for shift in (42, 21, 0)]
    return "".join(" " if v == 1 else chr(v - 2) for v in letters if v)


@pytest.mark.parametrize("cells", [1 << 26, 0])
def test_grams_are_those_of_plain_sets(monkeypatch, cells):
    monkeypatch.setattr(language_kernel, "TABLE_CELLS", cells)
    doc, grams, has = batch_grams(TEXTS, Letters())
    for i, text in enumerate(TEXTS):
        own = [spelt(g) for g in grams[doc == i].tolist()]
        assert len(own) == len(set(own)) and set(own) == plain(text)
        assert has[i] == any(c.isalpha() for c in text.lower())


def test_long_texts_are_whole(monkeypatch):
    monkeypatch.setattr(language_kernel, "BATCH_CHARS", 40)
    texts = [*TEXTS, "the quick brown fox jumps over 13 lazy dogs, and on; " * 9 + "end", None, "z" * 200 + " y"]
    seen = {}
    for places, doc, grams, has in grams_of(texts, Letters()):
        for k, i in enumerate(places.tolist()):
            seen[i] = ({spelt(g) for g in grams[doc == k].tolist()}, bool(has[k]))
    assert seen == {i: (plain(t or ""), any(c.isalpha() for c in (t or "").lower())) for i, t in enumerate(texts)}


def test_features_are_whitened_kernels_and_the_regression_solves_its_equations():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 60, 25)) for _ in range(12)]
    sets[5] = sets[4]  # a landmark that repeats another
    known, columns = landmark_matrix(sets)
    kernel = np.array([[len({*a} & {*b}) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    assert np.allclose(columns.T @ columns, kernel, atol=1e-6)
    features = kernel @ whitening(columns)
    assert np.allclose(features @ features.T, kernel, atol=1e-4)  # landmarks' features give their own kernel back
    own = np.arange(12) % 3
    solved, bias = fit_ridge(features, own, 3, ridge=0.1)
    loss = lambda w, b: (((features @ w + b - np.where(own[:, None] == np.arange(3), 1, -1)) ** 2).mean(0) + 0.1 * (w**2).sum(0)).sum()
    best = loss(solved, bias)
    for _ in range(50):
        assert loss(solved + 1e-3 * draw.normal(size=solved.shape), bias + 1e-3 * draw.normal(size=3)) > best


def test_scores_equal_explicit_kernels(spark):
    texts = ["the dog runs over the hill", "a cat and the dog", "der hund und die katze", "die katze läuft über den berg", "le chien et le chat", "la maison du chien"]
    rows = [(i, t, ["en", "en", "de", "de", "fr", "fr"][i]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = fit_languages(docs, learn=F.lit(True), landmarks=4)
    assert model.languages == ["de", "en", "fr"] and len(model.grams) <= sum(len(plain(t)) for t in texts)
    found = {r.doc_id: r for r in identify_languages(docs, model).collect()}
    weight = {spelt(g): w for g, w in zip(model.grams.tolist(), model.weights, strict=True)}
    for i, t in enumerate(texts):
        own = plain(t)
        scores = sum(weight[g] for g in own if g in weight) / np.sqrt(len(own)) + model.bias
        assert found[i].lang_pred == rows[i][2] == model.languages[int(np.argmax(scores))]
        assert abs(found[i].score - min(1, max(0, (scores.max() + 1) / 2))) < 1e-5


def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    rows = queries.op11_language_kernel(spark, folder).join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.text is None or not re.search(r"[^\W\d_]", r.text))
    judged = [r for r in rows if r.held_out and r.lang is not None and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in judged) >= 0.98 * len(judged) > 100


def test_odd_rows(spark):
    words = {"en": "the dog and the hill", "de": "der hund und der berg"}
    rows = [(i, f"{words[k]} {i}", k, "x") for i in range(40) for k in [["en", "de"][i % 2]]]
    odd = [(1, "the the and", "en", "x"), (None, "der und", None, "x"), (None, "the dog", "en", "x"), (50, None, "en", "x"), (51, "", None, "x"), (52, "12 !!", "de", "x"), (53, "der hund", None, "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string, score string").repartition(3)
    model = fit_languages(docs, learn=F.lit(True))
    found = identify_languages(docs, model).collect()
    assert len(found) == len(rows) + len(odd)
    got = sorted(((r.doc_id, r.lang_pred) for r in found if r.doc_id is None or r.doc_id >= 50), key=str)
    assert got == sorted([(50, "und"), (51, "und"), (52, "und"), (53, "de"), (None, "de"), (None, "en")], key=str)
    again = fit_languages(docs.repartition(5), learn=F.lit(True))
    assert np.allclose(again.weights, model.weights, atol=1e-4) and (again.grams == model.grams).all()
    assert fit_languages(docs.limit(0), learn=F.lit(True)) is None
    assert {r.lang_pred for r in identify_languages(docs, None).collect()} == {"und"}
    assert identify_languages(docs.limit(0), model).collect() == []
