"""Hard negatives against brute force, and the threshold join by itself."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import hard_negatives
from tidemill.llm.hard_negatives import mine_hard_negatives, threshold_join


def plain(rows, every=100, positives=5, negatives=10, low=30, high=90):
    used = []
    for key, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            used.append((key, [math.floor(256 * x) for x in vector], label))
    first = lambda found: sorted(found, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    made = []
    for at, (key, v, label) in enumerate(used):
        if key is None or key % every:
            continue
        met = [(sum(a * b for a, b in zip(v, w, strict=True)), k, m) for i, (k, w, m) in enumerate(used) if i != at and len(w) == len(v)]
        for score, friend, _ in first(r for r in met if r[2] == label)[:positives]:
            foes = [r for r in met if r[2] != label and low * score <= 100 * r[0] <= high * score]
            made += [(key, friend, rank, k, score, s) for rank, (s, k, _) in enumerate(first(foes)[:negatives], 1)]
    return sorted(made, key=str)


def mined(spark, rows, kind="float", every=100, **settings):
    table = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], f"vec_id bigint, embedding array<{kind}>, label int, row int, q string, score double")
    found = mine_hard_negatives(table, anchor=F.col("id") % every == 0, **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()), key=str)


def vectors(seed, n, d=16, groups=12):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(groups, d))
    made = middle[draw.integers(0, groups, n)] + 0.6 * draw.normal(size=(n, d))
    made = (made / np.linalg.norm(made, axis=1)[:, None]).astype(np.float32)
    return [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(made, draw.integers(0, 4, n), strict=True))]


@pytest.mark.parametrize("blocks", [(4096, 1024), (64, 8)])
@pytest.mark.parametrize("sample", [2048, 30])
def test_equals_brute_force(spark, monkeypatch, blocks, sample):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", blocks[1])
    monkeypatch.setattr(hard_negatives, "SAMPLE_ROWS", sample)
    rows = vectors(1, 400)
    assert mined(spark, rows, every=20) == plain(rows, every=20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    some = [[1.0, 0.5], [0.9, 0.5], [0.5, 0.5], [-1.0, 0.2], [0.0, 0.0]]
    rows = [(100 * i, some[i % 5], i % 3) for i in range(12)] + [(i, some[i % 5], i % 4) for i in range(1, 40)]
    rows += [(200, some[1], 1), (200, some[1], 1), (None, some[1], 2), (None, some[0], 0), (7, None, 1), (300, [nan, 1.0], 1), (300, [inf, 1.0], 1)]
    rows += [(400, [None, 1.0], 1), (500, some[0], None), (600, [1.0, 2.0, 3.0], 1), (601, [1.0, 2.0, 2.5], 1), (602, [1.0, 1.0, 1.0], 2), (700, [], 1), (701, [], 1), (702, [], 2)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == []


def test_many_equal_scores(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 50)
    same = [(i, [0.5, 0.5], i % 2) for i in range(300)]
    rows = [*same, (1000, [0.8, 0.8], 0), (1001, [0.9, 0.8], 0)]
    assert mined(spark, rows) == plain(rows)


def test_whole_numbers_of_any_size(spark):
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.normal(size=6) * 10.0 ** draw.integers(0, 7)], int(draw.integers(0, 3))) for i in range(120)]
    assert mined(spark, rows, kind="double", every=10) == plain(rows, every=10)


def test_threshold_join_loses_no_pair():
    draw = np.random.default_rng(9)
    for size in (1, 7, 24):
        x, y = (np.floor(256 * draw.normal(size=(n, size)) * np.linspace(1, 0.1, size)) for n in (30, 200))
        may = draw.random((30, 200)) < 0.7
        scores = x @ y.T
        for share in (0.05, 0.5, 0.99):
            least = np.floor(np.quantile(scores, 1 - share, axis=1))
            i, j, s = threshold_join(x, y, least, may)
            wanted = {(a, b) for a, b in zip(*np.nonzero(may & (scores >= least[:, None])), strict=True)}
            assert {*zip(i.tolist(), j.tolist(), strict=True)} == wanted and (s == scores[i, j]).all()
