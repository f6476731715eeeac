"""Counts of runs."""

import pytest

from plans import plan_of
from tableflow import PipelineSpec, build, run
from tableflow.plans.metrics import RunMetrics


def spec_of(folder, metrics, join="join b on a.k = b.k", **target):
    mapping = [
        {"index": 1, "id": "a", "source": "ext_hive", "location": "range(10)", "join": "(select id as k from a) a", "where": "id > 1"},
        {"index": 2, "id": "b", "source": "ext_hive", "location": "(select id % 5 as k, id as v from range(100))", "join": join},
        {"index": 3, "id": "unused", "source": "ext_hive", "location": "range(7)"},
    ]
    options = {"location": f"{folder}/out", "format": "parquet", "compression": "snappy", "mode": "overwrite"}
    target = target or {"place": "hdfs", "options": options}
    tree = {"source": {"mapping": mapping, "select": ["a.k", "v"]}, "target": target, "metrics": {"location": metrics}}
    return PipelineSpec.from_dict(tree)


@pytest.mark.parametrize("table", [False, True])
def test_counts_of_each_run_are_added(spark, tmp_path, table):
    metrics = "tableflow_metrics_test" if table else f"{tmp_path}/runs"
    spark.sql("drop table if exists tableflow_metrics_test")
    for _ in range(2):
        run(spark, spec_of(tmp_path, metrics))
    rows = (spark.table(metrics) if table else spark.read.parquet(metrics)).collect()
    want = [("result", "hdfs", 60), ("source", "a", 8), ("source", "b", 100), ("source", "unused", None)]
    assert sorted((r.part, r.id, r.rows) for r in rows) == sorted(want * 2, key=str)
    assert len({r.run for r in rows}) == 2 and all(r.seconds > 0 for r in rows)
    spark.sql("drop table if exists tableflow_metrics_test")


def test_cells_are_counted_as_rows(spark, tmp_path):
    options = {"tablename": f"{tmp_path}/cells", "cf": "d", "bulkload": True, "num-regions": 3, "bulk-stg": f"{tmp_path}/stg"}
    run(spark, spec_of(tmp_path, f"{tmp_path}/runs", place="hbase", options=options))
    got = {(r.part, r.id): r.rows for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert got["result", "hbase"] == 60 and got["source", "b"] == 100


def test_a_side_that_is_not_needed_does_not_block(spark, tmp_path):
    run(spark, spec_of(tmp_path, f"{tmp_path}/runs", join="join (select * from b where v > 1000) b on a.k = b.k"))
    got = {(r.part, r.id): r.rows for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert got["result", "hdfs"] in (0, None)


def test_no_source_is_read_twice(spark, tmp_path):
    spark.range(50).write.parquet(f"{tmp_path}/in")
    source = {"id": "a", "source": "hdfs", "format": "parquet", "location": f"{tmp_path}/in", "join": "a"}
    spec = PipelineSpec.from_dict({"source": {"mapping": [source]}, "target": {"place": "hdfs"}})
    plan = plan_of(build(spark, spec, RunMetrics(spark, f"{tmp_path}/runs")), "simple")
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 2


def test_a_failed_run_leaves_no_counts(spark, tmp_path, monkeypatch):
    def failing(*args):
        raise OSError("lost")

    monkeypatch.setattr("tableflow.plans.flow.write_target", failing)
    with pytest.raises(OSError):
        run(spark, spec_of(tmp_path, f"{tmp_path}/runs"))
    assert not (tmp_path / "runs").exists()
