from types import SimpleNamespace

import pytest

from tidemill import session


def fake(master: str, folder: str | None):
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_the_named_folder_is_used():
    assert session.shared_dir(fake("spark://x", "hdfs://n/shared/")) == "hdfs://n/shared"


def test_a_cluster_without_one_is_refused():
    with pytest.raises(RuntimeError):
        session.shared_dir(fake("yarn", None))


def test_a_local_session_gets_its_own():
    own = session.shared_dir(fake("local[2]", None))
    assert own == session.shared_dir(fake("local[2]", None))


def test_scratch_paths_never_meet(spark):
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
    assert not session.path_exists(spark, session.scratch_path(spark, "a"))


def test_checkpoints_are_reliable(spark):
    kept = session.materialize(spark.range(10).selectExpr("id % 3 AS k", "id"))
    assert kept.count() == 10
    assert session.path_exists(spark, spark.sparkContext.getCheckpointDir())
