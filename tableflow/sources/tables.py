"""Catalog sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableflow.sources.shape import project_and_filter
from tableflow.spec import SourceSpec


def read_relation(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """Anything that can follow ``from``: a table, an earlier source's id, a subquery in brackets."""
    return project_and_filter(spark.sql(f"select * from {source.location}"), source)


def read_managed_table(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """A table by name, usually ``db.table``."""
    return project_and_filter(spark.table(source.location), source)
