"""File source: one path in any format the session knows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableflow.sources.shape import project_and_filter
from tableflow.spec import SourceSpec, as_flag


def read_files(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """Load, project, filter.

    ``schema`` (DDL text) and ``options`` are optional. Give a schema for large JSON or XML input:
    without one Spark reads everything once just to infer it. Formats that are told where to read
    by their options take no ``location``.

    ``custom.stream: true`` makes it a stream of the files of a folder, which needs a schema; ``options`` may have
    ``maxFilesPerTrigger``.
    """
    streams = as_flag(source.custom.get("stream", False))
    if streams and not source.schema.strip():
        raise ValueError(f"source {source.id!r} is a stream of files, which needs a schema")
    reader = (spark.readStream if streams else spark.read).options(**source.options)
    if source.format:
        reader = reader.format(source.format)
    if source.schema.strip():
        reader = reader.schema(source.schema)
    return project_and_filter(reader.load(source.location or None), source)
