"""File, table and custom sinks, and target dispatch."""

import json

import pytest
from pyspark.errors import AnalysisException

from tableflow import PipelineSpec, register, run
from tableflow.__main__ import main


@pytest.fixture
def write(spark, people):
    """Run a job that writes a view to a target with the given options."""

    def go(place, options, view="emp_data", plugin=""):
        source = {"id": "e", "source": "ext_hive", "location": view, "join": "e"}
        target = {"place": place, "class": plugin, "options": options}
        run(spark, PipelineSpec.from_dict({"source": {"mapping": [source]}, "target": target}))

    return go


@pytest.fixture
def table(spark):
    name = "tableflow_sink_test"
    yield name
    spark.sql(f"drop table if exists {name}")


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def file_options(path, kind="parquet", compression="snappy", mode="error"):
    return {"location": str(path), "format": kind, "compression": compression, "mode": mode}


FORMATS = [("orc", "snappy"), ("orc", "zstd"), ("parquet", "gzip"), ("json", "gzip"), ("csv", "none")]


@pytest.mark.parametrize("kind, compression", FORMATS)
def test_file_formats(spark, people, write, tmp_path, kind, compression):
    path = tmp_path / "out"
    write("hdfs", file_options(path, kind, compression))
    back = spark.read.format(kind).schema(people["emp"].schema).load(str(path))
    assert rows(back) == rows(people["emp"])


def test_file_modes(spark, write, tmp_path):
    path = tmp_path / "out"
    sizes = {"overwrite": 3, "append": 6, "ignore": 6}
    for mode, size in sizes.items():
        write("hdfs", file_options(path, mode=mode))
        assert spark.read.parquet(str(path)).count() == size
    for mode in ("error", "errorifexists"):
        with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
            write("hdfs", file_options(path, mode=mode))


@pytest.mark.parametrize("missing", ["location", "format", "compression", "mode"])
def test_file_options_are_required(write, tmp_path, missing):
    options = file_options(tmp_path / "out")
    del options[missing]
    with pytest.raises(ValueError, match=f"needs option.*{missing}"):
        write("hdfs", options)


@pytest.mark.parametrize("key", ["table", "tablename"])
def test_a_table_must_be_new_by_default(spark, people, write, table, key):
    write("hive", {key: table})
    assert rows(spark.table(table)) == rows(people["emp"])
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        write("hive", {key: table})


def test_table_modes(spark, write, table):
    for mode, size in {"append": 3, "overwrite": 3, "APPEND": 6, "ignore": 6}.items():
        write("hive", {"table": table, "mode": mode})
        assert spark.table(table).count() == size


def test_append_goes_by_name(spark, people, write, table):
    write("hive", {"table": table, "format": "orc"})
    people["emp"].selectExpr("dept", "name", "emp_id + 10 as EMP_ID").createOrReplaceTempView("turned")
    write("hive", {"table": table, "mode": "append"}, view="turned")
    assert sorted(row.emp_id for row in spark.table(table).collect()) == [1, 2, 3, 11, 12, 13]
    with pytest.raises(ValueError, match="do not match"):
        write("hive", {"table": table, "mode": "append"}, view="dept_data")
    spark.catalog.dropTempView("turned")


def test_a_table_may_be_external(spark, write, table, tmp_path):
    write("hive", {"table": table, "format": "orc", "location": str(tmp_path / "ext")})
    assert spark.read.orc(str(tmp_path / "ext")).count() == spark.table(table).count() == 3


def test_custom_sinks(write):
    seen = []

    @register("remember")
    def remember(df, spark, target):
        seen.append((df.count(), target.option("a")))

    class Saver:
        def save(self, df, spark, target):
            seen.append(target.place)

    register("saver", Saver)
    write("hdfs", {"a": 1}, plugin="remember")
    write("hbase", {}, plugin="saver")
    assert seen == [(3, 1), "hbase"]


@pytest.mark.parametrize("place", ["HDFS", "kafka", ""])
def test_places_are_exact(write, place):
    with pytest.raises(ValueError, match="unknown target place.*known: hbase, hdfs, hive"):
        write(place, {})


def test_a_run_needs_a_target(spark):
    tree = {"source": {"mapping": [{"id": "e", "source": "ext_hive", "location": "range(3)", "join": "e"}]}}
    with pytest.raises(ValueError, match="no target"):
        run(spark, PipelineSpec.from_dict(tree))


def test_command_line(spark, people, tmp_path, monkeypatch):
    job = {
        "source": {"mapping": [{"id": "e", "source": "ext_hive", "location": "emp_data", "join": "e"}]},
        "target": {"place": "hdfs", "options": file_options(tmp_path / "out")},
    }
    path = tmp_path / "job.json"
    path.write_text(json.dumps(job))
    monkeypatch.setattr(type(spark), "stop", lambda self: None)  # the session is shared by all tests
    main([str(path)])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    with pytest.raises(SystemExit):
        main([])
