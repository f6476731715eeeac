"""What every built-in reader does after loading."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tableflow.spec import SourceSpec


def project_and_filter(df: DataFrame, source: SourceSpec) -> DataFrame:
    """Keep the listed columns, then apply the filter.

    The filter may name columns the projection dropped; Spark resolves them below it. Both reach
    the scan as a pruned read schema and pushed filters.
    """
    if source.columns:
        df = df.select(*source.columns)
    return df.where(source.where) if source.where.strip() else df
