"""Daily comparisons from states: the same as from all events, whatever arrives late."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill.operators import experiments, partial_states

KINDS = "unit int, group string, ts timestamp, value decimal(9,2)"


def events(spark, n: int, seed: int):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        unit = draw.choice([None, *range(1, 30)])
        arm = draw.choice([None, "control", "test", "other"]) if unit is None else ("control" if unit % 2 else "test")
        at = draw.choice([None, *[datetime(2026, 1, 1) + timedelta(hours=h) for h in range(0, 100, 7)]])
        rows.append((unit, arm, at, draw.choice([None, Decimal(draw.randrange(-500, 90_000)) / 100])))
    return spark.createDataFrame(rows, KINDS)


def shown(df) -> list[tuple]:
    return sorted((str(r[0]), *[None if v is None else round(v, 6) for v in r[1:]]) for r in df.collect())


def test_late_events_and_batches_done_twice(spark, tmp_path):
    path, seen = str(tmp_path / "states"), None
    sizes = [300, 40, 0, 1, 25]
    for batch, n in enumerate(sizes):
        part = events(spark, n, batch)
        seen = part if seen is None else seen.unionByName(part)
        for _ in range(2 if batch in (0, 3, 4) else 1):
            partial_states.add_to_states(part, "value", path, batch)
        wanted = shown(experiments.daily_pulse(seen, F.col("value"), "control", "test"))
        assert wanted and shown(partial_states.pulse_from_states(spark, path, "control", "test")) == wanted
    held = spark.read.parquet(f"{path}/units")
    assert held.filter("batch_id = 4").count() <= 25 < held.filter("batch_id = 0").count()


def test_empty_first_batch(spark, tmp_path):
    path = str(tmp_path / "states")
    partial_states.add_to_states(events(spark, 0, 0), "value", path, 0)
    assert partial_states.pulse_from_states(spark, path, "control", "test").count() == 0
    part = events(spark, 50, 1)
    partial_states.add_to_states(part, "value", path, 1)
    assert shown(partial_states.pulse_from_states(spark, path, "control", "test")) == shown(experiments.daily_pulse(part, F.col("value"), "control", "test"))


@pytest.mark.parametrize("kind", ["double", "decimal(18,4)", "string"])
def test_values_that_do_not_add_up_exactly(spark, tmp_path, kind):
    with pytest.raises(ValueError):
        partial_states.add_to_states(events(spark, 3, 0).withColumn("value", F.col("value").cast(kind)), "value", str(tmp_path / "s"), 0)


def test_whole_numbers(spark, tmp_path):
    path, part = str(tmp_path / "states"), events(spark, 80, 2).withColumn("value", F.col("value").cast("int"))
    partial_states.add_to_states(part, "value", path, 0)
    assert shown(partial_states.pulse_from_states(spark, path, "control", "test")) == shown(experiments.daily_pulse(part, F.col("value"), "control", "test"))
