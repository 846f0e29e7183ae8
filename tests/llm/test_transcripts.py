"""Transcripts against plain Viterbi over whole conversations, lists, markers and long turns."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm.transcripts import BEGIN, EMIT, MOVE, SHOWS, STATES, block_matrix, chained, parse_transcripts, raw_lines, read_line, walk_back, walk_block


def plain_path(shows):
    """The best path and its score, kept whole for every state."""
    best = {s: (BEGIN[s] + EMIT[s][shows[0]], [s]) for s in range(len(STATES))}
    for show in shows[1:]:
        best = {t: max(((score + MOVE[s][t] + EMIT[t][show], [*path, t]) for s, (score, path) in best.items()), key=lambda x: x[0]) for t in range(len(STATES))}
    return max(best.values(), key=lambda x: x[0])


def score_of(path, shows):
    return BEGIN[path[0]] + sum(EMIT[s][x] for s, x in zip(path, shows, strict=True)) + sum(MOVE[a][b] for a, b in itertools.pairwise(path))


def n_best(shows):
    """How many paths share the best score."""
    best = {s: (BEGIN[s] + EMIT[s][shows[0]], 1) for s in range(len(STATES))}
    near = lambda ways: [(v, n) for v, n in ways if v > max(x for x, _ in ways) - 1e-9]
    for show in shows[1:]:
        step = {t: near([(v + MOVE[s][t] + EMIT[t][show], n) for s, (v, n) in best.items()]) for t in range(len(STATES))}
        best = {t: (ways[0][0], sum(n for _, n in ways)) for t, ways in step.items()}
    return sum(n for _, n in near(list(best.values())))


def plain_turns(lines):
    seen = [read_line(line) for line in lines]
    _, path = plain_path([SHOWS.index(show) for show, _ in seen])
    turns = []
    for n, (line, (_, body), state) in enumerate(zip(lines, seen, path, strict=True)):
        role, place, _ = STATES[state]
        if place == "first" or n == 0:
            turns.append((role, [body]))
        else:
            turns[-1][1].append(line)
    return [(i, role, "\n".join(body).strip()) for i, (role, body) in enumerate(turns)]


def parsed(spark, lines, **settings):
    rows = [(1, i, line) for i, line in enumerate(lines)]
    found = parse_transcripts(spark.createDataFrame(rows, "conv_id int, line_no long, line string"), **settings)
    return sorted((r.turn, r.role, r.text) for r in found.collect())


def spoken(draw, n):
    make = ["User: hello there", "Assistant: of course", "- a point", "- another", "why is that?", "it goes on", "", "  ", "System: be kind", "> quoted", "note: this"]
    return [draw.choice(make) for _ in range(n)]


@pytest.mark.parametrize(("block", "fan"), [(512, 256), (3, 2), (1, 3)])
def test_equals_plain_viterbi(spark, block, fan):
    draw = random.Random(block)
    conversations = {i: spoken(draw, draw.randrange(1, 40)) for i in range(40)}
    rows = [(k, i, line) for k, lines in conversations.items() for i, line in enumerate(lines)]
    found = parse_transcripts(spark.createDataFrame(rows, "conv_id int, line_no long, line string").repartition(5), block_lines=block, fan=fan).collect()
    compared = 0
    for k, lines in conversations.items():
        got = sorted((r.turn, r.role, r.text) for r in found if r.conv_id == k)
        wanted = plain_turns(lines)
        if n_best([SHOWS.index(read_line(line)[0]) for line in lines]) == 1:
            assert got == wanted
            compared += 1
    assert compared >= 15


def test_blocks_and_levels_give_a_best_path():
    draw = random.Random(6)
    for _ in range(60):
        shows = [draw.randrange(len(SHOWS)) for _ in range(draw.randrange(2, 60))]
        cuts = sorted({0, *draw.sample(range(1, len(shows)), draw.randrange(min(9, len(shows))))})
        blocks = [shows[a:b] for a, b in zip(cuts, [*cuts[1:], len(shows)], strict=True)]
        matrices = [block_matrix(b, n == 0) for n, b in enumerate(blocks)]
        for size in (1, 2, 3, 100):
            runs = [matrices[i : i + size] for i in range(0, len(matrices), size)]
            zero = np.zeros(len(STATES))
            before, last = walk_back([chained(r) for r in runs], zero, None)
            path, n = [], 0
            for run, b, end in zip(runs, before, last, strict=True):
                for inner, stop in zip(*walk_back(run, b, end), strict=True):
                    path += walk_block(blocks[n], None if n == 0 else inner, stop)
                    n += 1
            assert math.isclose(score_of(path, shows), plain_path(shows)[0], abs_tol=1e-6)


def test_lists_stay_in_their_turn_with_their_bullets(spark):
    lines = ["Human: what is there?", "AI: here", "- one", "- two", "- three", "- four", "Human: thanks"]
    assert parsed(spark, lines) == [(0, "user", "what is there?"), (1, "assistant", "here\n- one\n- two\n- three\n- four"), (2, "user", "thanks")]


def test_dashes_speak_where_nobody_is_named(spark):
    lines = ["- hello", "- hi, how are you?", "- fine", "and you?", "- fine too", "- good"]
    assert parsed(spark, lines) == [(0, "user", "hello"), (1, "assistant", "hi, how are you?"), (2, "user", "fine\nand you?"), (3, "assistant", "fine too"), (4, "user", "good")]


def test_a_lone_dash_is_a_turn(spark):
    lines = ["User: one question", "- an answer", "User: another", "AI: yes"]
    assert [r for _, r, _ in parsed(spark, lines)] == ["user", "assistant", "user", "assistant"]


def test_no_text_is_lost(spark):
    draw = random.Random(8)
    lines = spoken(draw, 300)
    told = "\n".join(t for _, _, t in parsed(spark, lines, block_lines=16, fan=4))
    for word in ("hello there", "a point", "another", "it goes on", "quoted", "note: this"):
        assert told.count(word) == sum(word in line for line in lines)


def test_turns_of_any_length_and_foreign_roles(spark):
    text = "\n".join(f"line {i}" for i in range(1 << 12))
    rows = [(1, 0, "user", text), (1, 1, "assistant", "short"), (1, 2, "tool", "called"), (1, 3, None, "and so on")]
    lines = raw_lines(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert lines.filter("turn_no = 0").count() == 1 << 12 and lines.select(F.max("line_no")).first()[0] == (1 << 12) - 1
    found = sorted(map(tuple, parse_transcripts(lines, line_col=("turn_no", "line_no")).select("turn", "role", "text").collect()))
    assert found[0][2].endswith(f"line {(1 << 12) - 1}") and sum("called" in t for _, _, t in found) == 1 and sum("and so on" in t for _, _, t in found) == 1
