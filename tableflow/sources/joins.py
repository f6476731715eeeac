"""Join source: two earlier sources, joined in a way that join text has no fast form for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableflow.operators.joins import HOT_ROWS, asof_join, full_outer_join, interval_join
from tableflow.sources.shape import project_and_filter
from tableflow.spec import SourceSpec


def read_join(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """``custom`` names ``left`` and ``right`` (earlier sources or tables) and the ``kind``.

    ``full``: ``on`` columns. ``range``: ``left-span`` and ``right-span``, each a start and an end column; optional
    ``by`` columns. ``asof``: ``left-time`` and ``right-time``; optional ``by`` and ``how`` (left or inner).
    ``hot-rows`` is the number of rows a key may have in one task. Hot keys and interval levels are
    counted when the plan is built.
    """
    custom = source.custom

    def needed(name: str):
        if custom.get(name) in (None, "", []):
            raise ValueError(f"join source {source.id!r} needs custom.{name}")
        return custom[name]

    left, right = spark.table(needed("left")), spark.table(needed("right"))
    hot_rows, by = int(custom.get("hot-rows", HOT_ROWS)), list(custom.get("by", []))
    kind = needed("kind")
    if kind == "full":
        df = full_outer_join(left, right, list(needed("on")), hot_rows)
    elif kind == "range":
        df = interval_join(left, right, tuple(needed("left-span")), tuple(needed("right-span")), by)
    elif kind == "asof":
        times = needed("left-time"), needed("right-time")
        df = asof_join(left, right, *times, by, custom.get("how", "left"), hot_rows)
    else:
        raise ValueError(f"join source {source.id!r} has unknown kind {kind!r}; known: asof, full, range")
    return project_and_filter(df, source)
