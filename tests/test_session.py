from __future__ import annotations

import pytest

from tidemark import session


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class FakeSession:
    """Stands in for a session on another cluster."""

    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master})


def test_work_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(FakeSession("spark://host:7077"), "x")


def test_local_session_may_use_its_own_folder():
    local = FakeSession("local[2]")
    assert session.work_dir(local, "x").rsplit("/", 1)[0] == session.work_dir(local, "y").rsplit("/", 1)[0]


def test_state_partitions_follow_the_cores(spark):
    stateful = session.stateful_session(spark)
    assert stateful.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
    assert stateful.conf.get(session.STATE_STORE) == session.ROCKSDB
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
