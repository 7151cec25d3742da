from __future__ import annotations

import pytest

from stoptide import session


class _Settings(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    applicationId = "app-1"

    def __init__(self, master, checkpoint=None):
        self.master, self._checkpoint = master, checkpoint

    def getConf(self):
        return _Settings()

    def getCheckpointDir(self):
        return self._checkpoint


class _Spark:
    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = _Settings(conf or {})
        self.sparkContext = _Context(master, checkpoint)


def test_scratch_is_in_the_folder_the_cluster_names():
    spark = _Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/cp/"})
    first, second = (session.scratch_dir(spark, "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/cp/x-") and first != second
    assert session.scratch_dir(_Spark("yarn", checkpoint="s3://b/cp"), "x").startswith("s3://b/cp/")


def test_a_cluster_without_that_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(_Spark("yarn"), "x")


def test_a_local_session_may_use_a_temporary_folder():
    assert "stoptide-" in session.scratch_dir(_Spark("local[2]"), "x")


def test_configure_sets_what_jobs_need(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    assert session.configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
