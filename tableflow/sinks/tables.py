"""Catalog table sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableflow.operators.cells import quoted
from tableflow.spec import TargetSpec


def write_table(df: DataFrame, spark: SparkSession, target: TargetSpec) -> None:
    """Write to a named table; by default it must not exist yet.

    Options: ``table`` (or ``tablename``); optional ``mode``, ``format``, and ``location`` for an
    external table. Appending to an existing table matches columns by name.
    """
    name = target.option("table") or target.require("tablename")[0]
    mode = str(target.option("mode", "errorifexists"))
    if mode.lower() == "append" and spark.catalog.tableExists(name):
        columns = spark.table(name).columns
        if sorted(c.lower() for c in columns) != sorted(c.lower() for c in df.columns):
            raise ValueError(f"columns {df.columns} do not match those of {name}: {columns}")
        df.select(*[quoted(c) for c in columns]).write.insertInto(name)
        return
    writer = df.write.mode(mode)
    if target.option("format"):
        writer = writer.format(target.option("format"))
    if target.option("location"):
        writer = writer.option("path", target.option("location"))
    writer.saveAsTable(name)
