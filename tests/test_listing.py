"""Folders listed by the tasks, beside Spark's own listing on the driver."""

from __future__ import annotations

import pytest
from helpers import as_set, lines_of, task_sum
from pyspark.sql import functions as F

from tidemill.sources import files, listing

COLUMNS = ["bucket", "key", "uri", "size", "updated", "is_directory"]


def plant(root, *names: str) -> None:
    for name in names:
        place = root / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text(name)


def test_as_sparks_own_listing(spark, tmp_path):
    plant(
        tmp_path, "a.txt", "b/c.txt", "b/d/e/f/g.csv", "b/.hidden", "b/_SUCCESS", "_x=1/y.txt", "_gone/z.txt", ".dot/z.txt", "k=a%2Fb/m.txt",
        "with blank/n ö.txt", "k=1+2/+.txt", "b/empty.txt",
    )
    (tmp_path / "b/empty.txt").write_text("")
    (tmp_path / "nothing/here").mkdir(parents=True)
    for path in (str(tmp_path), f"file://{tmp_path}/"):
        ours = listing.folder_inventory(spark, path)
        assert ours.columns == COLUMNS
        # Spark's reader leaves empty files out
        assert as_set(ours.filter("size > 0")) == as_set(files.file_inventory(spark, path).select(*COLUMNS))
        assert ours.filter("size = 0").first().key == "b/empty.txt" and ours.count() == 8
    for glob in ("*.txt", "[a-g].*", "?.csv"):
        ours = listing.folder_inventory(spark, str(tmp_path), glob)
        assert as_set(ours.filter("size > 0")) == as_set(files.file_inventory(spark, str(tmp_path), glob).select(*COLUMNS))


def test_no_files_and_refusals(spark, tmp_path):
    assert listing.folder_inventory(spark, str(tmp_path)).count() == 0
    with pytest.raises(FileNotFoundError):
        listing.folder_inventory(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError):
        listing.folder_inventory(spark, str(tmp_path), "{a,b}")


def test_batches_and_tasks(spark, tmp_path, monkeypatch):
    """Every entry is written once, whatever the batches; more folders than a task takes are dealt over tasks."""
    events = spark.conf.get("spark.eventLog.dir").removeprefix("file:")
    names = [f"f{i % 40}/g{i % 3}/{i}" for i in range(600)]
    plant(tmp_path, *names)
    begun = lines_of(events)
    found = listing.folder_inventory(spark, str(tmp_path))
    assert task_sum(events, begun, "Shuffle Write Metrics", "Shuffle Records Written") == 1 + 40 + 120
    assert {r.key for r in found.collect()} == set(names)
    spread = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) >= 6
    monkeypatch.setattr(listing, "BATCH", 2)
    system, base = listing._system(f"file://{tmp_path}/")
    held = list(listing._entries(system, base, "f1/", None))
    assert [b.num_rows for b in held] == [2, 1] and sorted(k for b in held for k in b.column(0).to_pylist()) == ["f1/g0", "f1/g1", "f1/g2"]
