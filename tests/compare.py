"""Run queries beside their SQL on DuckDB and compare columns, row counts and values.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if hasattr(value, "as_tuple"):
        return float(f"{float(value):.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(_plain(r[i])) if not isinstance(_plain(r[i]), float) else _plain(r[i]) for i in order) for r in rows)


def oracle_rows(folder: str, sql: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    cursor = connection.execute(sql)
    return [c[0] for c in cursor.description], [str(c[1]) for c in cursor.description], cursor.fetchall()


def difference(spark, folder: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    frame = query(spark, folder)
    got = [tuple(r) for r in frame.collect()]
    columns, kinds, wanted = oracle_rows(folder, sql)
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    if len(got) != len(wanted):
        return f"{len(got)} rows against {len(wanted)}"
    a, b = rows_of(frame.columns, got), rows_of(columns, wanted)
    if a != b:
        return f"values {list((a - b).items())[:3]} against {list((b - a).items())[:3]}"
    return None


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from tidemill.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    oracles, failed = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = difference(spark, folder, query, oracles[name])
                note = "" if problem is None else problem
            else:
                problem, note = None, f"{query(spark, folder).count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    where = arguments[0] if arguments else "/root/testdata/sf0.01"
    sys.exit(1 if main(where, arguments[1:]) else 0)
