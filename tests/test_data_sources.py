"""Python data sources as plug-ins: pushed filters, and writes that commit or leave nothing."""

import os

import pyarrow.ipc as ipc
import pytest
from pyspark.sql import functions as F

from plans import plan_of
from tableflow import PipelineSpec, build, register, run
from tableflow.sources.arrow_files import ArrowFiles, ArrowFilesReader
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, IsNull

PLUGIN = "tableflow.sources.arrow_files.ArrowFiles"


def write(spark, df, folder, **options):
    df.createOrReplaceTempView("rows_to_write")
    source = {"id": "r", "source": "ext_hive", "location": "rows_to_write", "join": "r"}
    target = {"place": "hdfs", "class": PLUGIN, "options": {"location": folder} | options}
    run(spark, PipelineSpec.from_dict({"source": {"mapping": [source]}, "target": target}))
    spark.catalog.dropTempView("rows_to_write")


def read(spark, folder, where="", **more):
    source = {"id": "s", "source": "hdfs", "transform": PLUGIN, "location": folder, "join": "s", "where": where} | more
    settings = {"spark.sql.python.filterPushdown.enabled": "true"}
    return build(spark, PipelineSpec.from_dict({"source": {"mapping": [source]}, "spark-config": settings}))


def sorted_rows(spark, count=1000):
    rows = spark.range(count).selectExpr("id as k", "cast(id % 7 as string) as v", "if(id % 5 = 0, null, id / 2) as x", "array(id) as l")
    return rows.repartitionByRange(8, "k")


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_round_trip_append_and_overwrite(spark, tmp_path):
    folder = f"{tmp_path}/files"
    write(spark, sorted_rows(spark), folder)
    assert plain(read(spark, folder)) == plain(sorted_rows(spark))
    write(spark, sorted_rows(spark, 10), folder)
    assert read(spark, folder).count() == 1010
    write(spark, sorted_rows(spark, 10), folder, mode="overwrite")
    assert plain(read(spark, folder)) == plain(sorted_rows(spark, 10))
    assert not [name for name in os.listdir(folder) if not name.endswith(".arrow")]


@pytest.mark.parametrize("where", ["k > 900", "k >= 10 and k < 20", "k = 5", "k in (3, 990, null)", "v = '3' and k <= 50", "x is not null", "k = -1", "x is null and k < 100", "k % 2 = 1"])
def test_filters_are_pushed_and_exact(spark, tmp_path, where):
    folder = f"{tmp_path}/files"
    write(spark, sorted_rows(spark), folder)
    df = read(spark, folder, where)
    assert plain(df) == plain(sorted_rows(spark).where(where))
    if where == "k > 900":
        plan = plan_of(df)
        assert "PushedFilters: [" in plan and "GreaterThan" in plan


def test_files_that_cannot_match_are_not_read(spark, tmp_path):
    folder = f"{tmp_path}/files"
    write(spark, sorted_rows(spark), folder)

    def files(*filters):
        reader = ArrowFilesReader(folder)
        left = list(reader.pushFilters(list(filters)))
        return len(reader.partitions()), len(left)

    assert files() == (8, 0) and files(GreaterThan(("k",), 995), IsNotNull(("k",))) == (1, 0)
    assert files(EqualTo(("k",), 5000)) == (0, 0) and files(In(("k",), (1, 999))) == (2, 0)
    assert files(IsNull(("k",)), EqualTo(("l", "a"), 1)) == (8, 2)


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    folder = f"{tmp_path}/files"
    write(spark, sorted_rows(spark, 20), folder)
    before = sorted(os.listdir(folder))
    bad = sorted_rows(spark).withColumn("k", F.when(F.col("k") == 990, F.raise_error(F.lit("lost"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="lost"):
        write(spark, bad, folder)
    with pytest.raises(Exception, match="lost"):
        write(spark, bad, folder, mode="overwrite")
    assert sorted(os.listdir(folder)) == before and read(spark, folder).count() == 20
    for name in before:
        assert ipc.open_file(f"{folder}/{name}").num_record_batches > 0


def test_a_registered_name_finds_the_data_source(spark, tmp_path):
    register("arrow", ArrowFiles)
    write(spark, sorted_rows(spark, 20), f"{tmp_path}/files")
    assert read(spark, f"{tmp_path}/files", "k < 5", transform="arrow", columns=["v"]).count() == 5
    with pytest.raises(Exception, match="no .arrow files"):
        read(spark, f"{tmp_path}/nothing")
