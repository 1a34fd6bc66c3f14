"""Shared work folder: read from the session, private fallback only when unset."""

from __future__ import annotations

import pytest

import os

from shopstream import session


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):            # a cluster would reject core confs here
        raise AssertionError(f"must not set {key}")


class _NoContext:
    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):               # remote sessions expose none
        raise RuntimeError("no SparkContext")


def test_work_dir_reads_the_cluster_setting():
    s = _NoContext({"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert session.work_dir(s) == "hdfs://nn/shared/ckpt"
    assert session.new_run_dir(s, "x").startswith("hdfs://nn/shared/ckpt/shopstream/x-")


def test_work_dir_private_fallback_is_stable_per_application():
    s = _NoContext({"spark.app.id": "app-test-1"})
    a, b = session.work_dir(s), session.work_dir(s)
    assert a == b and os.path.isdir(a)
    other = _NoContext({"spark.app.id": "app-test-2"})
    assert session.work_dir(other) != a


def test_helpers_without_spark_context():
    s = _NoContext({"spark.default.parallelism": "12", "spark.app.id": "app-x"})
    assert session.default_parallelism(s) == 12
    assert session.app_id(s) == "app-x"
    assert session.make_dirs(s, "/tmp/never-created-by-this-test") is False


def test_live_session_uses_configured_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.work_dir(spark) == configured.rstrip("/")
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_work_dir_needs_a_shared_folder_on_a_cluster():
    from shopstream import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Cluster())
