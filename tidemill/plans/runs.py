"""Run-history and graph queries.

An order is a run of the job named by its priority, dated by its order date; status
F is failed, O success, P running.  The graph goes from regions over nations and
suppliers to the parts they shipped.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import runs
from tidemill.plans.registry import Tables, query

_STATES = {"F": "failed", "O": "success", "P": "running"}


def _history(t: Tables) -> DataFrame:
    state = F.create_map(*[F.lit(x) for pair in _STATES.items() for x in pair])[F.col("o_orderstatus")]
    return t.orders.select(
        F.col("o_orderpriority").alias("dag_id"), F.col("o_orderkey").alias("run_id"),
        F.to_date("o_orderdate").alias("logical_date"), state.alias("state"),
    )


def _plan_sql(states: str, direction: str) -> str:
    return f"""
    WITH spine AS (SELECT dag_id, CAST(d AS DATE) AS day FROM (SELECT DISTINCT o_orderpriority AS dag_id FROM orders),
                   unnest(generate_series(DATE '1996-01-01', DATE '1996-06-30', INTERVAL 1 DAY)) AS s(d)),
    last AS (SELECT o_orderpriority AS dag_id, CAST(o_orderdate AS DATE) AS day, arg_max(o_orderstatus, o_orderkey) AS st
             FROM orders GROUP BY 1, 2),
    due AS (SELECT dag_id, day, st FROM spine LEFT JOIN last USING (dag_id, day) WHERE st IS NULL OR st IN ({states}))
    SELECT dag_id, strftime(day, '%Y-%m-%d') AS logical_date,
           CASE st WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success' WHEN 'P' THEN 'running' END AS last_state,
           (row_number() OVER (PARTITION BY dag_id ORDER BY day {direction}) - 1) // 4 AS wave FROM due
    """


def _plan(t: Tables, reprocess: str, backwards: bool) -> DataFrame:
    rows = runs.backfill_plan(
        _history(t), date(1996, 1, 1), date(1996, 6, 30), reprocess, max_active=4, backwards=backwards
    )
    return rows.withColumn("logical_date", F.col("logical_date").cast("string"))


@query("backfill_plan", _plan_sql("'none'", "ASC"))
def plan(t: Tables) -> DataFrame:
    return _plan(t, "none", False)


@query("backfill_failed", _plan_sql("'F'", "DESC"))
def plan_failed(t: Tables) -> DataFrame:
    return _plan(t, "failed", True)


@query("backfill_completed", _plan_sql("'F', 'O'", "ASC"))
def plan_completed(t: Tables) -> DataFrame:
    return _plan(t, "completed", False)


@query(
    "run_order",
    """
    SELECT o_orderkey AS run_id, o_orderpriority AS dag_id FROM orders
    ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderpriority, o_orderkey DESC LIMIT 40
    """,
)
def ordered(t: Tables) -> DataFrame:
    return runs.run_order(_history(t), ["-logical_date", "dag_id", "-run_id"], 40).select("run_id", "dag_id")


def _edges(t: Tables) -> DataFrame:
    """(parent, child, place): places are the children's own numbers."""

    def name(kind: str, column: str):
        return F.concat(F.lit(kind), F.col(column).cast("string"))

    nations = t.nation.select(name("r", "n_regionkey").alias("parent"), name("n", "n_nationkey").alias("child"), F.col("n_nationkey").cast("long").alias("place"))
    firms = t.supplier.select(name("n", "s_nationkey").alias("parent"), name("s", "s_suppkey").alias("child"), F.col("s_suppkey").alias("place"))
    parts = t.lineitem.select("l_suppkey", "l_partkey").distinct().select(
        name("s", "l_suppkey").alias("parent"), name("p", "l_partkey").alias("child"), F.col("l_partkey").alias("place")
    )
    return nations.unionByName(firms).unionByName(parts)


_EDGES = """
    edges AS (SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child, CAST(n_nationkey AS BIGINT) AS place FROM nation
      UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, s_suppkey FROM supplier
      UNION ALL SELECT DISTINCT 's' || l_suppkey, 'p' || l_partkey, l_partkey FROM lineitem)
"""


@query(
    "roots",
    "WITH " + _EDGES + """
    SELECT DISTINCT parent AS node FROM edges WHERE parent NOT IN (SELECT child FROM edges)
    UNION SELECT 'p' || p_partkey FROM part WHERE 'p' || p_partkey NOT IN (SELECT child FROM edges)
    """,
)
def roots(t: Tables) -> DataFrame:
    edges = _edges(t)
    parts = t.part.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"))
    nodes = edges.select(F.col("parent").alias("node")).distinct().unionByName(parts)
    return runs.roots(nodes, edges)


@query(
    "closure",
    "WITH RECURSIVE " + _EDGES + """
    , down AS (SELECT 'r' || r_regionkey AS node, 0 AS distance FROM region
               UNION SELECT child, distance + 1 FROM down JOIN edges ON parent = node)
    SELECT node, min(distance) AS distance FROM down GROUP BY 1
    """,
)
def downstream(t: Tables) -> DataFrame:
    return runs.closure(_edges(t), t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node")))


@query(
    "closure_upstream",
    "WITH RECURSIVE " + _EDGES + """
    , up AS (SELECT 'p' || p_partkey AS node, 0 AS distance FROM part
             UNION SELECT parent, distance + 1 FROM up JOIN edges ON child = node)
    SELECT node, min(distance) AS distance FROM up GROUP BY 1
    """,
)
def upstream(t: Tables) -> DataFrame:
    seeds = t.part.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"))
    return runs.closure(_edges(t), seeds, "upstream")


@query(
    "closure_clear",
    "WITH RECURSIVE " + _EDGES + """
    , seeds AS (SELECT 's' || s_suppkey AS node FROM supplier WHERE s_acctbal < 0),
    down AS (SELECT node FROM seeds UNION SELECT child FROM down JOIN edges ON parent = node),
    up AS (SELECT node FROM seeds UNION SELECT parent FROM up JOIN edges ON child = node),
    i AS (SELECT l_orderkey, l_linenumber, 'p' || l_partkey AS task_id, l_returnflag, l_shipdate FROM lineitem)
    SELECT DISTINCT l_orderkey, l_linenumber, task_id FROM i
    WHERE l_returnflag IN ('R', 'A') AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate <= TIMESTAMP '1996-12-31'
      AND task_id IN (SELECT node FROM down UNION SELECT node FROM up)
    """,
)
def cleared(t: Tables) -> DataFrame:
    """Shipments as task instances; the tasks around suppliers in debt are cleared."""
    instances = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("task_id"),
        F.col("l_returnflag").alias("state"), F.col("l_shipdate").alias("logical_date"),
    )
    seeds = t.supplier.filter(F.col("s_acctbal") < 0).select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("node")
    )
    chosen = runs.clear_selection(
        instances, _edges(t), seeds, upstream=True, downstream=True, states=["R", "A"],
        start=datetime(1996, 1, 1), end=datetime(1996, 12, 31),
    )
    return chosen.select("l_orderkey", "l_linenumber", "task_id").distinct()


@query(
    "tree_expand",
    "WITH RECURSIVE " + _EDGES + """
    , walk AS (SELECT 'r' || r_regionkey AS node, [CAST(r_regionkey AS BIGINT)] AS path FROM region
               UNION ALL SELECT child, list_append(path, place) FROM walk JOIN edges ON parent = node),
    home AS (SELECT node, min(path) AS home FROM walk GROUP BY 1),
    shown AS (SELECT 'r' || r_regionkey AS node, [CAST(r_regionkey AS BIGINT)] AS path FROM region
              UNION ALL SELECT child, list_append(home, place) FROM home JOIN edges ON parent = node)
    SELECT array_to_string(path, '/') AS path, node, len(path) - 1 AS depth, path = home AS expanded FROM shown JOIN home USING (node)
    """,
)
def tree(t: Tables) -> DataFrame:
    start = t.region.select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node"),
        F.col("r_regionkey").cast("long").alias("place"),
    )
    lines = runs.tree_expand(_edges(t), start)
    path = F.array_join(F.transform("path", lambda p: p.cast("string")), "/")
    return lines.select(path.alias("path"), "node", F.col("depth").cast("long").alias("depth"), "expanded")
