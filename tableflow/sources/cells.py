"""Cell-store source: wide rows out of a cell table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableflow.operators.cells import cells_to_wide
from tableflow.sinks.store import CellStore
from tableflow.sources.marks import chosen_loads
from tableflow.sources.shape import project_and_filter
from tableflow.spec import SourceSpec, as_flag


def read_cells(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """``rowkey`` and one string column per entry of ``custom.mapping`` (column -> qualifier).

    ``location`` is a table or view name, or a path when it contains a slash. A filter on ``rowkey``
    runs below the grouping, in the scan. ``custom.rows`` gives a range of row keys, ``from`` one to
    before another (``to``), either of which may be left out: of a store with split keys, only the
    regions of the range are read, and the cells that were put one by one.
    ``custom.versions`` and ``custom.increment`` choose loads by their write time or by what earlier runs have read
    (see ``chosen_loads``); loads that are not chosen are not read.
    ``custom.keep_empty_rows: false`` leaves out row keys with none of the mapped cells and reads only
    the mapped cells.
    """
    mapping = source.custom.get("mapping")
    if not mapping:
        raise ValueError(f"cell source {source.id!r} needs custom.mapping")
    span = source.custom.get("rows") or {}
    loads = chosen_loads(spark, source)
    unknown = set(span) - {"from", "to"}
    if unknown:
        raise ValueError(f"custom.rows of cell source {source.id!r} has 'from' and 'to', not {sorted(unknown)}")
    cells = CellStore(spark, source.location, source.format).read(span.get("from"), span.get("to"), loads)
    keep = as_flag(source.custom.get("keep_empty_rows", True))
    wide = cells_to_wide(cells, source.column_family, mapping, keep_empty_rows=keep)
    return project_and_filter(wide, source)
