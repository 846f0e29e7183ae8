"""What several test modules share."""

from __future__ import annotations

import json
from pathlib import Path

SMALL = "/root/testdata/sf0.001"


def as_set(df) -> set:
    return {tuple(r) for r in df.collect()}


def task_sum(events: str, since: int, group: str, metric: str) -> int:
    """A metric of all tasks that the event log has from a line on."""
    lines = [line for p in sorted(Path(events).iterdir()) if p.is_file() for line in p.open()][since:]
    ended = [json.loads(line) for line in lines if '"SparkListenerTaskEnd"' in line]
    return sum((e.get("Task Metrics") or {}).get(group, {}).get(metric, 0) for e in ended)


def lines_of(events: str) -> int:
    return sum(1 for p in Path(events).iterdir() if p.is_file() for _ in p.open())
