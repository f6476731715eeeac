import pytest

from tableflow.session import apply_settings, scratch_folder, start_session


class Session:
    """What scratch_folder looks at."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = conf


def test_scratch_is_under_the_shared_folder_the_session_names():
    session = Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/check/"})
    first, second = scratch_folder(session, "x"), scratch_folder(session, "x")
    assert first.startswith("hdfs://shared/check/tableflow-x-") and first != second


def test_only_a_local_session_may_leave_it_out():
    assert scratch_folder(Session("local[8]"), "x").startswith("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session("yarn"), "x")


def test_scratch_of_a_real_session(spark):
    assert "/tableflow-x-" in scratch_folder(spark, "x")


def test_settings_fixed_at_start_are_reported(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    refused = apply_settings(spark, {name: "5", "spark.yarn.maxAppAttempts": "1", "spark.executor.memory": "1g"})
    assert spark.conf.get(name) == "5" and "spark.executor.memory" in refused
    spark.conf.set(name, before)


def test_start_session_applies_settings(spark):
    name = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(name)
    assert start_session({name: "7"}).conf.get(name) == "7"
    spark.conf.set(name, before)
