import os

import pytest

from scriptorium import session


class Cluster:
    """A session on a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "yarn"


def test_scratch_lies_under_the_shared_folder(monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    monkeypatch.setattr(Cluster.conf, "get", lambda key, default: "hdfs:///shared")
    first, second = (session.shared_dir(Cluster, "x") for _ in range(2))
    assert first != second
    assert first.startswith("hdfs:///shared/x-")
    assert session._scratch == [first, second]


def test_scratch_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    path = session.shared_dir(spark, "x")
    spark.range(3).write.parquet(path)
    session.remove_scratch()
    assert not os.path.exists(path)
    session.remove_scratch()


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster, "x")
