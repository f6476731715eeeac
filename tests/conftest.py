import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tableflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tableflow-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def people(spark):
    """Three small related views, dropped again after the test."""
    frames = {
        "emp": spark.createDataFrame(
            [(1, "ann", 10), (2, "bob", 20), (3, "cy", None)], "emp_id int, name string, dept int"
        ),
        "dept": spark.createDataFrame([(10, "hr"), (30, "it")], "dept int, title string"),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{name}_data")
    yield frames
    for name in frames:
        spark.catalog.dropTempView(f"{name}_data")
