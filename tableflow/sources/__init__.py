"""Readers: a source spec becomes a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

from tableflow.plugins import data_source, is_built_in, resolve
from tableflow.sources.cells import read_cells
from tableflow.sources.files import read_files
from tableflow.sources.joins import read_join
from tableflow.sources.shape import project_and_filter
from tableflow.sources.tables import read_managed_table, read_relation
from tableflow.spec import SourceSpec

# The source kinds. Both spellings of the table kinds mean the same.
READERS: dict[str, Callable[[SparkSession, SourceSpec], DataFrame]] = {
    "hdfs": read_files,
    "ext_hive": read_relation,
    "hive-ext": read_relation,
    "mng_hive": read_managed_table,
    "hive-mng": read_managed_table,
    "hbase": read_cells,
    "join": read_join,
}


def read_source(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """Read one source with its plug-in, or with the reader of its kind."""
    kind = source.source.lower()
    if kind not in READERS:
        known = ", ".join(sorted(READERS))
        raise ValueError(f"source {source.id!r} has unknown kind {source.source!r}; known: {known}")
    if not is_built_in(source.transform):
        plugin = data_source(source.transform)
        if plugin:
            return read_data_source(spark, source, plugin)
        return resolve(source.transform, "transform")(spark, source)
    return READERS[kind](spark, source)


def read_data_source(spark: SparkSession, source: SourceSpec, plugin: type[DataSource]) -> DataFrame:
    """Read with a Python data source; ``custom`` and ``options`` are its options.

    Its filters are pushed where the session has ``spark.sql.python.filterPushdown.enabled``.
    """
    spark.dataSource.register(plugin)
    options = {key: str(value) for key, value in (source.custom | source.options).items()}
    reader = spark.read.format(plugin.name()).options(**options)
    if source.schema.strip():
        reader = reader.schema(source.schema)
    return project_and_filter(reader.load(source.location or None), source)


__all__ = ["READERS", "read_cells", "read_files", "read_join", "read_managed_table", "read_relation", "read_source"]
