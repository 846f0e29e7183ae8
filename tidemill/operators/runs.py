"""Run histories and task graphs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.time import time_literal
from tidemill.operators.skew import dimension_join, hot_keys, skew_join
from tidemill.session import materialize, materialize_counted

# What a backfill re-runs besides missing dates.
REPROCESS = {"none": (), "failed": ("failed",), "completed": ("failed", "success")}


def backfill_plan(
    runs: DataFrame, start: date, end: date, reprocess: str = "none",
    max_active: int = 10, backwards: bool = False,
    dag: str = "dag_id", day: str = "logical_date", state: str = "state", order: Sequence[str] = ("run_id",),
) -> DataFrame:
    """Dates of every job to run in [start, end], in waves of ``max_active``.

    A date counts by its last run.  Dates never run are always included; ``reprocess``
    adds the failed, or the failed and successful ones.  The numbering spans a
    job's dates, bounded by the range.
    """
    if reprocess not in REPROCESS:
        raise ValueError(f"reprocess is one of {', '.join(REPROCESS)}")
    scoped = runs.filter(F.col(day).between(F.lit(start), F.lit(end)))
    last = scoped.groupBy(dag, day).agg(F.max_by(state, F.struct(*order)).alias("last_state"))
    spine = runs.select(dag).distinct().withColumn(day, F.explode(F.sequence(F.lit(start), F.lit(end))))
    due = spine.join(last, [dag, day], "left").filter(
        F.col("last_state").isNull() | F.col("last_state").isin(*REPROCESS[reprocess])
    )
    place = Window.partitionBy(dag).orderBy(F.col(day).desc() if backwards else F.col(day).asc())
    return due.withColumn("_n", F.row_number().over(place)).select(
        dag, day, "last_state", F.floor((F.col("_n") - 1) / F.lit(max_active)).cast("long").alias("wave")
    )


def signed_order(keys: Sequence[str]) -> list[Column]:
    """``-run_after`` sorts descending, ``run_after`` ascending."""
    return [F.col(k[1:]).desc() if k.startswith("-") else F.col(k).asc() for k in keys]


def run_order(runs: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    return runs.orderBy(*signed_order(keys)).limit(limit)


def edges_of(tasks: DataFrame, graph: Sequence[str] = (), task: str = "task_id", downstream: str = "downstream_task_ids"):
    """(parent, child, place) rows of tasks that list their downstream tasks."""
    return tasks.select(
        *graph, F.col(task).alias("parent"), F.posexplode(downstream).alias("place", "child")
    )


def roots(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """Nodes that are nobody's child.  Children are reduced to distinct ones before the join."""
    children = edges.select(F.col("child").alias(node)).distinct()
    return nodes.join(children, node, "left_anti")


#: levels of a graph that are walked one by one before long ways are contracted
PLAIN_ROUNDS = 6


def closure(edges: DataFrame, seeds: DataFrame, direction: str = "downstream", plain_rounds: int = PLAIN_ROUNDS) -> DataFrame:
    """Every node reachable from the seeds, with its least distance (0 for a seed).

    Breadth first for the first levels: each round joins only the newest nodes, and the least distance of a node is the one
    it was first reached at, so shared descendants are visited once and cycles end.  What lies deeper is reached through
    ``_contracted``, in rounds that grow with the logarithm of a way's length.  A round is
    one shuffle and one write to the checkpoint folder, which keeps the plan short and counts the newest nodes on the way; a
    hub's edges are spread by its children.
    """
    source, target = ("parent", "child") if direction == "downstream" else ("child", "parent")
    steps = materialize(edges.select(F.col(source).alias("node"), F.col(target).alias("_next")).distinct())
    hot = cache(lambda: hot_keys(steps, ["node"]))
    known = materialize(seeds.select("node").distinct().withColumn("distance", F.lit(0)))
    size, distance = None, 0
    while size != 0 and distance < plain_rounds:
        newest = known.filter(F.col("distance") == distance).select("node")
        distance += 1
        taken = dimension_join(steps, newest, ["node"], "left_semi", hot=hot, rows=size)
        found = taken.select(F.col("_next").alias("node"), F.lit(distance).alias("distance"))
        reached = known.unionByName(found).groupBy("node").agg(F.min("distance").alias("distance"))
        known, size = materialize_counted(reached, F.col("distance") == distance)
    return known if size == 0 else _contracted(steps, known)


def _contracted(steps: DataFrame, known: DataFrame) -> DataFrame:
    """The closure of ``known`` (node, distance) where all nodes up to some distance are known.

    A node that is entered by one step alone is as far as the node before it, plus one.  Its pointer to that node doubles its reach in
    every round until it ends at an anchor: a known node, or one entered by several steps.  Only anchors are then
    walked, by weighted steps whose targets are offered ever shorter distances, and all others take theirs from their anchor.  So rounds are the logarithm of
    the longest way without a meeting, and the number of meetings on a way.  Pointers that circle are those of no reachable node.
    """
    open_steps = skew_join(steps.withColumnRenamed("node", "_from").withColumnRenamed("_next", "node"), known.select("node"), ["node"], how="left_anti")
    entered = open_steps.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("_from").alias("to"))
    entered = materialize(entered)
    single = entered.filter("n = 1").select("node", "to", F.lit(1).alias("far"))

    pointing = single.select(F.col("node").alias("to"), F.lit(False).alias("_ends"))
    begun = skew_join(single, pointing, ["to"], how="left").select("node", "to", "far", F.coalesce("_ends", F.lit(True)).alias("done"))
    pointers, size = materialize_counted(begun, ~F.col("done"))
    before = None
    while size and size != before:
        before = size
        ends = pointers.select(F.col("node").alias("to"), F.col("to").alias("_then"), F.col("far").alias("_more"), F.col("done").alias("_done"))
        moved = skew_join(pointers.filter("NOT done"), ends, ["to"], how="left")
        moved = moved.select("node", F.coalesce("_then", "to").alias("to"), (F.col("far") + F.coalesce("_more", F.lit(0))).alias("far"), F.coalesce("_done", F.lit(True)).alias("done"))
        pointers, size = materialize_counted(pointers.filter("done").unionByName(moved), ~F.col("done"))
    pointers = pointers.select("node", "to", F.when(F.col("done"), F.col("far")).alias("far"))  # a circle reaches no anchor

    meetings = entered.filter("n > 1").select("node")
    into = skew_join(open_steps, meetings, ["node"], how="left_semi").select(F.col("node").alias("target"), F.col("_from").alias("node"))
    anchored = skew_join(into, pointers, ["node"], how="left").filter(F.col("to").isNull() | F.col("far").isNotNull())
    anchored = anchored.select(F.coalesce("to", "node").alias("node"), "target", (F.coalesce("far", F.lit(0)) + 1).alias("weight"))
    ways = materialize(anchored.groupBy("node", "target").agg(F.min("weight").alias("weight")))
    best = materialize(known.select("node", "distance", F.lit(True).alias("new")))
    size = None
    while size != 0:
        newest = best.filter("new").select("node", "distance")
        offered = skew_join(ways, newest, ["node"]).select(F.col("target").alias("node"), (F.col("distance") + F.col("weight")).alias("distance"), F.lit(None).cast("int").alias("had"))
        both = best.select("node", "distance", F.col("distance").alias("had")).unionByName(offered)
        least = both.groupBy("node").agg(F.min("distance").alias("distance"), F.min("had").alias("had"))
        best, size = materialize_counted(least.select("node", "distance", (F.col("had").isNull() | (F.col("distance") < F.col("had"))).alias("new")), F.col("new"))
    best = best.select("node", "distance")
    behind = skew_join(pointers.filter("far IS NOT NULL"), best.withColumnRenamed("node", "to"), ["to"])
    return best.unionByName(behind.select("node", (F.col("distance") + F.col("far")).alias("distance")))


def clear_selection(
    instances: DataFrame, edges: DataFrame, seeds: DataFrame,
    upstream: bool = False, downstream: bool = False,
    states: Sequence[str] = (), start: datetime | None = None, end: datetime | None = None,
    task: str = "task_id", state: str = "state", time: str = "logical_date",
) -> DataFrame:
    """Task instances that clearing the seeds would touch.

    Seeds, optionally all tasks above and below them, in the given states and
    dates.  Date and state tests reach the scan.
    """
    chosen = seeds.select("node").distinct()
    if downstream:
        chosen = chosen.unionByName(closure(edges, seeds, "downstream").select("node"))
    if upstream:
        chosen = chosen.unionByName(closure(edges, seeds, "upstream").select("node"))
    rows = instances
    like = rows.schema[time].dataType.simpleString()
    if states:
        rows = rows.filter(F.col(state).isin(*states))
    if start is not None:
        rows = rows.filter(F.col(time) >= time_literal(start, like))
    if end is not None:
        rows = rows.filter(F.col(time) <= time_literal(end, like))
    return skew_join(rows, chosen.distinct().withColumnRenamed("node", task), [task], how="left_semi")


def tree_expand(edges: DataFrame, start: DataFrame, place: str = "place") -> DataFrame:
    """The depth-first outline of a graph, each node expanded once.

    ``start`` is (node, place): the roots in order.  Result rows: path (the places
    from the root down; sorting by it gives the outline), node, depth, and
    ``expanded``: false where the node was already unfolded earlier and its
    children are not repeated.

    A node is unfolded at the least of its paths, so the least path of every node
    is found first, by rounds of edge relaxation that touch changed nodes only (a
    path around a cycle is longer than the one it starts with, so cycles end);
    then each edge below a reached node is one line.  The result has one row per
    reached edge and root, however many paths lead to a node.
    """
    links = materialize(edges.select("parent", F.col("child").alias("node"), F.col(place).cast("long").alias("_place")))
    hot = cache(lambda: hot_keys(links, ["parent"]))
    firsts = start.select("node", F.array(F.col(place).cast("long")).alias("path"))
    best = materialize(firsts.groupBy("node").agg(F.min("path").alias("path")))
    size = None
    while size != 0:
        changed = best.select("node", "path") if size is None else best.filter("_new").select("node", "path")
        offered = dimension_join(links, changed.withColumnRenamed("node", "parent"), ["parent"], "inner", hot=hot, rows=size)
        offered = offered.select("node", F.concat("path", F.array("_place")).alias("path"), F.lit(None).cast("array<bigint>").alias("_known"))
        both = best.select("node", "path", F.col("path").alias("_known")).unionByName(offered)
        least = both.groupBy("node").agg(F.min("path").alias("path"), F.min("_known").alias("_known"))
        least = least.select("node", "path", (F.col("_known").isNull() | (F.col("path") < F.col("_known"))).alias("_new"))
        best, size = materialize_counted(least, F.col("_new"))
    at = best.select("node", F.col("path").alias("_home"))
    parents = best.select(F.col("node").alias("parent"), "path")
    below = dimension_join(links, parents, ["parent"], "inner", hot=hot).select(
        "node", F.concat("path", F.array("_place")).alias("path")
    )
    lines = dimension_join(firsts.unionByName(below), at, ["node"], "inner")
    return lines.select(
        "path", "node", (F.size("path") - 1).alias("depth"), (F.col("path") == F.col("_home")).alias("expanded")
    )


def tree_line(path_depth: Column, label: Column, expanded: Column, has_children: Column) -> Column:
    """An outline line: two blanks per level, and ``…`` where the children are not repeated."""
    mark = F.when(~expanded & has_children, F.lit(" …")).otherwise(F.lit(""))
    return F.concat(F.repeat(F.lit("  "), path_depth), label, mark)
