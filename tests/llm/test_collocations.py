"""Phrase mining against brute force, with prefixes that have to be lengthened."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from tidemill.llm import collocations
from tidemill.llm.collocations import mine_collocations, words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, first=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    made = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        told = []
        for p, a in candidates.items():
            around = [n for q, n in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * n >= 50 * a for n in around):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            told.append((-score, -a, " ".join(p).encode(), a, left, right))
        made += [(lang, i, p.decode(), a, left, right, sizes[lang], -s) for i, (s, _, p, a, left, right) in enumerate(sorted(told)[:first], 1)]
    return sorted(made)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, f int, phrase string").repartition(parts)


def mined(docs, **settings):
    found = mine_collocations(docs, **settings)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, found.collect()))


def many(seed, n=120):
    draw = random.Random(seed)
    words = ["the", "The", "of", "naïve", "ÉTÉ", "été", "x y", "new", "york", "city", "中文", "-", "'s"] + [f"w{i}" for i in range(30)]
    weights = [40, 10, 30] + [6] * 10 + [1] * 30
    gaps = [" ", "  ", "\t", " ", ". ", ", ", "\n", "!?", "\r\n", "\x0b"]
    texts = ["".join(w + draw.choice(gaps) for w in draw.choices(words, weights, k=draw.randrange(60))) for _ in range(n)]
    return [(t, draw.choice(["en", "fr", None, "und"])) for t in texts] + [(None, "en"), ("", "de"), (" . ,", "de"), ("the of the of " * 200, "en")]


@pytest.mark.parametrize("budget", [1 << 20, 400, 60])
def test_equals_brute_force(spark, budget):
    rows = many(1)
    assert mined(frame(spark, rows), budget=budget, least=5) == plain(rows, least=5)


def test_long_prefixes_are_grouped_within_the_budget(spark):
    rows = [(t, lang or "und") for t, lang in many(2)]
    docs = spark.createDataFrame([(lang, bytearray((t or "").encode())) for t, lang in rows], "lang string, text binary")
    words = collocations.word_counts(docs)
    partition, pairs = collocations.partition_prefixes(docs, words, 5, 150)
    assert partition.heavy_words and partition.heavy_pairs and pairs is not None
    heavy = {(r.lang, r.word.encode()) for r in words.filter("f > 150").collect()}
    assert partition.heavy_words == heavy
    assert partition.group_of.max() > 3 and (partition.group_of[1:] >= partition.group_of[:-1]).all()


def test_chunks_end_anywhere(spark, monkeypatch):
    rows = many(3, 40)
    numbers = []
    for size in (1, 7, 1 << 21):
        made = []

        def hand_over(lang, words, found, begun, made=made):
            for i in range(begun):
                made.append((lang, *[None if n < 0 else words[n] for n in found[i : i + 3].tolist()]))
            return iter(())

        chunks = collocations.Chunks(hand_over, 3)
        with monkeypatch.context() as patch:
            patch.setattr(collocations, "CHUNK_WORDS", size)
            patch.setattr(collocations, "STRETCH", 11)
            for text, lang in rows:
                list(chunks.add(lang or "und", (text or "").encode()))
            list(chunks.flush())
        numbers.append(sorted((s for s in made if s[1] is not None), key=str))
    cleaned = [[(lang, a, b, c if b is not None else None) for lang, a, b, c in n] for n in numbers]
    assert cleaned[0] == cleaned[1] == cleaned[2]


def test_long_texts_are_split_between_words():
    text = ("ab, c" * 500_000 + "z" * 3_000_000 + " end").encode()
    whole = [w for part in words_of(text) for w in part]
    assert whole == re.sub(rb"[.,;:!?\n-\r]", b" . ", text).split()


def test_no_rows(spark):
    docs = frame(spark, [("a b", "en")])
    assert mined(docs.limit(0)) == [] and mined(docs) == []


def test_exact_beyond_64_bits(spark, monkeypatch):
    phrases = spark.createDataFrame([("en", "a", "b", None, 3_000_000_019)], "lang string, first string, second string, third string, f bigint")
    words = spark.createDataFrame([("en", "a", 5_000_000_029), ("en", "b", 7_000_000_033)], "lang string, word string, f bigint")
    monkeypatch.setattr(collocations, "count_phrases", lambda *_: (words, phrases))
    a, left, right = 3_000_000_019, 5_000_000_029, 7_000_000_033
    assert mined(frame(spark, [("", "en")])) == [("en", 1, "a b", a, left, right, left + right, 1_000_000 * a * a // (left * right))]
