"""Build and run a spec."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tableflow.plans.metrics import RunMetrics
from tableflow.plans.shape import duplicate_names, shaped
from tableflow.plugins import is_built_in
from tableflow.session import apply_settings, scoped_settings
from tableflow.sinks import write_target
from tableflow.sources import read_source
from tableflow.sources.marks import mark_read, with_loads_named
from tableflow.spec import PipelineSpec

log = logging.getLogger(__name__)


def build(spark: SparkSession, spec: PipelineSpec, metrics: RunMetrics | None = None) -> DataFrame:
    """The result of a spec as one lazy DataFrame.

    Nothing is computed and nothing cached: sources, join, filter and derived columns form one
    plan, so pruned columns and filters reach the scans. Source views exist only while the plan
    is analyzed; a view of the caller's with the same name is put back.

    The spec's settings are applied to the session and stay, since the caller computes the result
    afterwards; ``run`` puts them back.
    """
    apply_settings(spark, spec.settings)
    with _scoped_views(spark) as register:
        for source in spec.sources:
            df = read_source(spark, source)
            register(source.id, metrics.counted(df, "source", source.id) if metrics else df)
        df = shaped(spark, spec)
    twice = duplicate_names(df)
    # a plug-in sink may know what to do with them; the built-in ones do not
    if twice and (spec.target is None or is_built_in(spec.target.plugin)):
        raise ValueError(f"duplicate column(s) {', '.join(twice)}: list the wanted ones in 'select'")
    return metrics.counted(df, "result", spec.target.place) if metrics else df


def run(spark: SparkSession, spec: PipelineSpec) -> None:
    """Build the result and write it to the target; raises if anything fails.

    The spec's settings hold for this run only. With ``metrics`` in the spec the counts of the run are added to
    a table.
    """
    if spec.target is None:
        raise ValueError("the spec has no target")
    with scoped_settings(spark, spec.settings):
        spec, read = with_loads_named(spark, spec)
        metrics = RunMetrics(spark, spec.metrics) if spec.metrics else None
        write_target(build(spark, spec, metrics), spark, spec.target)
        mark_read(spark, read)
        if metrics:
            metrics.write()
    log.info("wrote target %s", spec.target.place)


@contextmanager
def _scoped_views(spark: SparkSession) -> Iterator[Callable[[str, DataFrame], None]]:
    """Register temp views for the length of a block; a repeated name replaces the earlier one."""
    before: dict[str, DataFrame | None] = {}

    def register(name: str, df: DataFrame) -> None:
        if name not in before:
            before[name] = spark.table(name) if _is_temp_view(spark, name) else None
        df.createOrReplaceTempView(name)

    try:
        yield register
    finally:
        for name, df in before.items():
            spark.catalog.dropTempView(name)
            if df is not None:
                df.createOrReplaceTempView(name)


def _is_temp_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary
