"""File sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableflow.spec import TargetSpec


def write_files(df: DataFrame, spark: SparkSession, target: TargetSpec) -> None:
    """Write with the given format, compression and save mode; all are required."""
    names = ("format", "compression", "mode", "location")
    kind, compression, mode, location = target.require(*names)
    df.write.format(kind).option("compression", compression).mode(mode).save(location)
