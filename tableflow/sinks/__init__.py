"""Writers: a DataFrame goes to the target of a spec."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

from tableflow.plugins import data_source, is_built_in, resolve
from tableflow.sinks.cells import write_cells
from tableflow.sinks.files import write_files
from tableflow.sinks.tables import write_table
from tableflow.spec import TargetSpec
from tableflow.streaming import write_stream

# The target places, spelled exactly so.
WRITERS: dict[str, Callable[[DataFrame, SparkSession, TargetSpec], None]] = {
    "hdfs": write_files,
    "hive": write_table,
    "hbase": write_cells,
}


def write_target(df: DataFrame, spark: SparkSession, target: TargetSpec) -> None:
    """Write with the target's plug-in, or with the writer of its place."""
    if target.place not in WRITERS:
        known = ", ".join(sorted(WRITERS))
        raise ValueError(f"unknown target place {target.place!r}; known: {known}")
    if df.isStreaming:
        write_stream(df, spark, target)
    elif not is_built_in(target.plugin):
        plugin = data_source(target.plugin)
        if plugin:
            write_data_source(df, spark, target, plugin)
        else:
            resolve(target.plugin, "save")(df, spark, target)
    else:
        WRITERS[target.place](df, spark, target)


def write_data_source(
    df: DataFrame, spark: SparkSession, target: TargetSpec, plugin: type[DataSource]
) -> None:
    """Write with a Python data source: ``mode`` (default: append) and ``location``; all options are its own too."""
    spark.dataSource.register(plugin)
    options = {key: str(value) for key, value in target.options.items() if key not in ("mode", "location")}
    writer = df.write.format(plugin.name()).mode(str(target.option("mode", "append"))).options(**options)
    writer.save(target.option("location"))


__all__ = ["WRITERS", "write_cells", "write_files", "write_table", "write_target"]
