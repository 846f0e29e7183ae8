"""Roles of transcript lines by a hidden Markov model, and their canonical rendering.

A line is seen as its speaker marker (if any), its shape and its place; the hidden states are
the roles, each as the first line of a turn or a later one, or as an item of a list within it.  A dash may open a turn or an item: which
of the two it does belongs to the whole conversation and is hidden, too, so named speakers, runs of dashes and alternation all
weigh in.  Viterbi finds the most likely path.  Scores of runs of lines combine associatively, so a conversation of any length is
decoded block by block: each block is summed up in a small matrix, the matrices are chained in levels, and every block is then walked by itself.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.operators.ordering import number_rows
from tidemill.session import materialize, materialize_counted

ROLES = ["system", "user", "assistant"]
#: states: (role, place, style).  Where dashes speak, a turn has a first line and later ones; where they list, it has items, too
STATES = [(r, place, style) for style, places in (("speaks", "first later"), ("lists", "first later item")) for r in ROLES for place in places.split()]
#: blocks of a conversation that are chained at a time
FAN = 256
#: lines that are decoded together
BLOCK_LINES = 512

#: speaker markers, by the role that they speak for; chosen for this library, matched at a line's start
MARKERS = {
    "system": "system context instructions sys".split(),
    "user": "user human question customer q me u".split(),
    "assistant": "assistant bot ai answer agent model a".split(),
}
_ROLE_OF = {word: role for role, words in MARKERS.items() for word in words}
_MARKER = re.compile(r"^\s*(?:#{1,4}\s*|\*\*|\[|<\|?|>\s*)?([A-Za-z]{1,12})\s*(?:\*\*\s*:|:\s*\*\*|\]\s*:?|\|?>\s*:?|:)\s*")
_DASH = re.compile(r"^\s*(?:[-–—]|>{1,2})\s+")


def read_line(line: str) -> tuple[str, str]:
    """What a line shows (a role, "turn", "blank" or "text") and what is left without its marker."""
    if not line.strip():
        return "blank", ""
    m = _MARKER.match(line)
    if m and m.group(1).lower() in _ROLE_OF:
        return _ROLE_OF[m.group(1).lower()], line[m.end() :]
    m = _DASH.match(line)
    if m:
        return "turn", line[m.end() :]
    return ("asks" if line.rstrip().endswith("?") else "text"), line


SHOWS = [*ROLES, "turn", "blank", "asks", "text"]
_LOG = lambda p: np.log(np.asarray(p, float))


def _emissions() -> np.ndarray:
    """log P(what a line shows | state)."""
    table = np.full((len(STATES), len(SHOWS)), 1e-4)
    for s, (role, place, style) in enumerate(STATES):
        if place == "first":
            table[s, SHOWS.index(role)] = 0.001 if style == "speaks" else 0.8
            table[s, SHOWS.index("turn")] = 0.85 if style == "speaks" else 0.08
            table[s, SHOWS.index("text")] = 0.05
            table[s, SHOWS.index("asks")] = 0.05 if role == "user" else 0.01
        elif place == "later":
            table[s, SHOWS.index("text")] = 0.85
            table[s, SHOWS.index("asks")] = 0.08
            table[s, SHOWS.index("blank")] = 0.06
        else:
            table[s, SHOWS.index("turn")] = 0.9
            table[s, SHOWS.index("text")] = 0.06
            table[s, SHOWS.index("blank")] = 0.03
    return _LOG(table / table.sum(1, keepdims=True))


def _transitions() -> np.ndarray:
    """log P(next state | state): a turn goes on, or another role takes over; the style stays."""
    after = {"system": {"user": 0.9, "assistant": 0.09, "system": 0.01}, "user": {"assistant": 0.96, "user": 0.03, "system": 0.01}, "assistant": {"user": 0.96, "assistant": 0.03, "system": 0.01}}
    over = {"speaks": 0.6, "lists": 0.4}
    stay = {"first": {"later": 0.996, "item": 0.004}, "later": {"later": 0.996, "item": 0.004}, "item": {"later": 0.2, "item": 0.8}}
    table = np.zeros((len(STATES), len(STATES)))
    for s, (role, place, style) in enumerate(STATES):
        for t, (other, to, same) in enumerate(STATES):
            if same == style:
                share = 1.0 if style == "speaks" else stay[place].get(to, 0)
                table[s, t] = over[style] * after[role][other] if to == "first" else (1 - over[style]) * share * (other == role)
    return _LOG(np.maximum(table, 1e-12))


EMIT, MOVE = _emissions(), _transitions()
_BEGIN = {"system": 0.3, "user": 0.6, "assistant": 0.1}
BEGIN = _LOG([_BEGIN[r] * {"speaks": 0.3, "lists": 0.7}[style] if place == "first" else 1e-9 for r, place, style in STATES])


def block_matrix(shows: list[int], first: bool) -> np.ndarray:
    """Best log score of being in state i before a block and in state j at its last line.

    A conversation's first block has nothing before it: all its rows are alike.
    """
    best = np.tile(BEGIN + EMIT[:, shows[0]], (len(STATES), 1)) if first else MOVE + EMIT[:, shows[0]]
    for show in shows[1:]:
        best = (best[:, :, None] + MOVE[None]).max(1) + EMIT[:, show]
    return best


def walk_block(shows: list[int], before: np.ndarray | None, last: int | None = None) -> list[int]:
    """States of a block's lines, given the scores before it (None at the beginning) and the state of its last line."""
    score, back = None, []
    for show in shows:
        if score is None and before is None:
            score = BEGIN + EMIT[:, show]
            continue
        options = (before if score is None else score)[:, None] + MOVE
        if score is not None:
            back.append(options.argmax(0))
        score = options.max(0) + EMIT[:, show]
    path = [int(score.argmax()) if last is None else last]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def chained(matrices: list[np.ndarray]) -> np.ndarray:
    """The matrix of consecutive runs of lines as one."""
    best = matrices[0]
    for m in matrices[1:]:
        best = (best[:, :, None] + m[None]).max(1)
    return best


def walk_back(matrices: list[np.ndarray], before: np.ndarray, last: int | None) -> tuple[list[np.ndarray], list[int]]:
    """Scores before every one of consecutive runs and the state of its last line on the best path, given those of all together."""
    scores = [before]
    for m in matrices:
        scores.append((scores[-1][:, None] + m).max(0))
    ends = [int(scores[-1].argmax()) if last is None else last]
    for score, m in zip(scores[-2:0:-1], matrices[:0:-1], strict=True):
        ends.append(int((score + m[:, ends[-1]]).argmax()))
    return scores[:-1], ends[::-1]


def parse_transcripts(
    lines: DataFrame, conv_col: str = "conv_id", line_col: str | Sequence[str] = "line_no", text_col: str = "line", block_lines: int = BLOCK_LINES, fan: int = FAN
) -> DataFrame:
    """(conv_id, turn, role, text, rendered): one row per recovered turn of the transcripts' lines.

    Lines are ordered by their number, or several such columns in turn, ties by their text; repeated rows are lines of their own; a NULL text is a
    blank line; a NULL conversation is a conversation; a NULL number comes first.  An empty table gives no rows.
    A turn's first line loses its marker, no other line loses anything.  A marker that names none of the three roles is text.
    ``rendered`` is the role in ``<|role|>``, the text and ``<|end|>`` on lines of their own.  All lines are numbered
    by ranges and cut every ``block_lines`` lines, however many conversations that is, so a task holds one block; of a conversation that
    reaches beyond its block only a small matrix per block meets the others, ``fan`` of them at a time, and a turn is joined from its lines at the end.
    """
    kind = lines.schema[conv_col].dataType.simpleString()
    order = [line_col] if isinstance(line_col, str) else list(line_col)
    numbers = {f"line_no_{i}": F.col(f"`{c}`").cast("long") for i, c in enumerate(order)}
    rows = lines.select(
        F.col(f"`{conv_col}`").alias("conv_id"), *[c.alias(n) for n, c in numbers.items()],
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("line"),
    )
    placed = number_rows(rows, ["conv_id", *numbers, "line"], "at").drop(*numbers)
    placed = placed.withColumn("block", F.floor(F.col("at") / block_lines))
    size = len(STATES)
    conv = to_arrow_schema(placed.select("conv_id").schema)[0]

    def sum_up(table: pa.Table) -> pa.Table:
        # only a block's first and last conversation can reach beyond it
        runs = _runs(table.sort_by("at"))
        edges = [runs[i] for i in sorted({0, len(runs) - 1})]
        shows = [[SHOWS.index(read_line(t)[0]) for t in lines] for _, lines, _ in edges]
        ways = [[block_matrix(s, first).ravel().tolist() for s in shows] for first in (True, False)]
        columns = [[e[0].conv_id for e in edges], [e[0].block for e in edges], *ways]
        return _table(columns, [conv, ("block", pa.int64()), ("begun", _DOUBLES), ("carried", _DOUBLES)])

    sums = placed.groupBy("block").applyInArrow(sum_up, f"conv_id {kind}, block long, begun array<double>, carried array<double>")

    ways = _chain(materialize(sums), kind, fan)
    both = _beside(placed, ways, ["conv_id", "block"])

    def decode(table: pa.Table) -> pa.Table:
        made = []
        for first, lines, places in _runs(table.sort_by("at")):
            seen = [read_line(t) for t in lines]
            head = first.before is None or not any(first.before)  # nothing comes before: the scores there are zero
            path = walk_block([SHOWS.index(show) for show, _ in seen], None if head else np.asarray(first.before, float), first.last)
            for n, (at, line, (_, body), state) in enumerate(zip(places, lines, seen, path, strict=True)):
                role, place, _ = STATES[state]
                opens = place == "first" or (head and n == 0)
                made.append((first.conv_id, first.block, at, role, opens, body if opens else line))
        fields = [conv, ("block", pa.int64()), ("at", pa.int64()), ("role", pa.string()), ("opens", pa.bool_()), ("body", pa.string())]
        return _table([list(c) for c in zip(*made, strict=True)], fields)

    told = both.groupBy("block").applyInArrow(decode, f"conv_id {kind}, block long, at long, role string, opens boolean, body string")
    return _turns(materialize(told))


_DOUBLES = pa.list_(pa.float64())


def _chain(sums: DataFrame, kind: str, fan: int) -> DataFrame:
    """(conv_id, block, before, last) of every row of (conv_id, block, begun, carried).

    ``fan`` consecutive blocks of a conversation become one row, these again, until a conversation is one row; then every level is
    walked back down.  So no task meets more than ``fan`` matrices of a conversation, however long it is.
    """
    size = len(STATES)
    conv = to_arrow_schema(sums.select("conv_id").schema)[0]
    matrix = lambda values: np.asarray(values, float).reshape(size, size)
    first = sums.groupBy("conv_id").agg(F.min("block").alias("first"))
    level, n = materialize_counted(_beside(sums, first, ["conv_id"]).select("conv_id", (F.col("block") - F.col("first")).alias("at"), "block", "begun", "carried"))
    n_convs = first.count()
    levels = [level]

    def up(table: pa.Table) -> pa.Table:
        rows = table.sort_by("at").to_pylist()
        carried = [matrix(r["carried"]) for r in rows]
        whole = [chained(carried), chained([matrix(rows[0]["begun"]), *carried[1:]])]
        columns = [[rows[0]["conv_id"]], [rows[0]["at"] // fan], [rows[0]["block"]], *[[m.ravel().tolist()] for m in reversed(whole)]]
        return _table(columns, [conv, ("at", pa.int64()), ("block", pa.int64()), ("begun", _DOUBLES), ("carried", _DOUBLES)])

    while n > n_convs:
        grouped = levels[-1].groupBy("conv_id", F.floor(F.col("at") / fan))
        level, n = materialize_counted(grouped.applyInArrow(up, f"conv_id {kind}, at long, block long, begun array<double>, carried array<double>"))
        levels.append(level)

    known = levels[-1].select("conv_id", "at", F.array_repeat(F.lit(0.0), size).alias("before"), F.lit(None).cast("int").alias("last"))

    def down(table: pa.Table) -> pa.Table:
        rows = table.sort_by("at").to_pylist()
        told = [matrix(r["carried"]) for r in rows]
        if rows[0]["at"] == 0:
            told[0] = matrix(rows[0]["begun"])
        before, last = walk_back(told, np.asarray(rows[0]["before"], float), rows[0]["last"])
        columns = [[r[c] for r in rows] for c in ("conv_id", "at", "block")]
        return _table([*columns, [b.tolist() for b in before], last], [conv, ("at", pa.int64()), ("block", pa.int64()), ("before", _DOUBLES), ("last", pa.int32())])

    schema = f"conv_id {kind}, at long, block long, before array<double>, last int"
    ends = known.withColumnRenamed("at", "group")
    for depth, level in enumerate(reversed(levels)):
        # the topmost level knows its own ends; below, a row's group is the row of the level above
        group = F.col("at") if depth == 0 else F.floor(F.col("at") / fan)
        known = _beside(level.withColumn("group", group), ends, ["conv_id", "group"])
        known = materialize(known.groupBy("conv_id", "group").applyInArrow(down, schema))
        ends = known.select("conv_id", F.col("at").alias("group"), "before", "last")
    return known.drop("at")


class _First(NamedTuple):
    """What holds for all lines of a conversation within a block."""

    conv_id: object
    block: int
    before: list | None
    last: int | None


def _runs(table: pa.Table) -> list[tuple[_First, list[str], list[int]]]:
    """The conversations of a block in order: (what holds for them, lines, places)."""
    names = [n for n in ("conv_id", "block", "before", "last") if n in table.column_names]
    firsts = [_First(*(list(r) + [None] * (4 - len(r)))) for r in zip(*(table[n].to_pylist() for n in names), strict=True)]
    found: list[tuple[_First, list[str], list[int]]] = []
    for first, line, at in zip(firsts, table["line"].to_pylist(), table["at"].to_pylist(), strict=True):
        if not found or found[-1][0].conv_id != first.conv_id:
            found.append((first, [], []))
        found[-1][1].append(line)
        found[-1][2].append(at)
    return found


def _table(columns: list[list], fields: list) -> pa.Table:
    schema = pa.schema(fields)
    return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _beside(rows: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of their block, NULL where it has none; NULL keys meet each other."""
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    return rows.alias("l").join(blocks.alias("r"), on, "left").select("l.*", *[f"r.{c}" for c in blocks.columns if c not in keys])


def _turns(told: DataFrame) -> DataFrame:
    """Lines joined into turns; how many turns stand before a block comes from one row per block."""
    sizes = told.groupBy("conv_id", "block").agg(F.sum(F.col("opens").cast("long")).alias("n"))
    order = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("past"))
    running = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    numbered = told.withColumn("inside", F.sum(F.col("opens").cast("long")).over(running))
    numbered = _beside(numbered, materialize(before), ["conv_id", "block"])
    numbered = numbered.select("conv_id", "at", "role", "body", (F.col("inside") + F.col("past") - 1).alias("turn"))
    turns = numbered.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("at", "role", "body"))).alias("lines"))
    joined = F.array_join(F.transform("lines", lambda x: x["body"]), "\n")
    text = F.regexp_replace(joined, r"^\s+|\s+$", "")
    turns = turns.select("conv_id", "turn", F.col("lines")[0]["role"].alias("role"), text.alias("text"))
    return turns.withColumn("rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>")))


def raw_lines(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn_no, line_no, line): transcripts as people paste them, from a table (conv_id, turn, role, text).

    The style of the markers follows from the conversation's id; some turns go without one, as transcripts do.  A NULL role speaks as the
    user; a role other than the three is named in the markers that name roles, which no parser then takes for one of them.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(6))
    role = F.lower(F.coalesce("role", F.lit("user")))
    short = F.when(role == "user", "Q").when(role == "assistant", "A").otherwise("System")
    human = F.when(role == "user", "Human").when(role == "assistant", "AI").otherwise("Context")
    marker = (
        F.when(style == 0, F.concat(F.initcap(role), F.lit(": ")))
        .when(style == 1, F.concat(F.lit("### "), human, F.lit(": ")))
        .when(style == 2, F.concat(F.lit("["), role, F.lit("] ")))
        .when(style == 3, F.concat(short, F.lit(": ")))
        .when(style == 4, F.concat(F.lit("<|"), role, F.lit("|> ")))
        .otherwise(F.concat(F.lit("**"), human, F.lit(":** ")))
    )
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10)) == 0) & (F.col("turn") > 0)
    marker = F.when(bare, F.lit("- ")).otherwise(marker)
    text = F.coalesce("text", F.lit(""))
    parts = conversations.select("conv_id", "turn", F.posexplode(F.split(F.concat(marker, text), "\n")).alias("n", "line"))
    return parts.select("conv_id", F.col("turn").cast("long").alias("turn_no"), F.col("n").cast("long").alias("line_no"), "line")
