"""Table operators: reshaping between wide rows and cells, split keys, region layout, joins."""

from tableflow.operators.cells import (
    CELL_COLUMNS,
    cells_to_wide,
    row_key,
    row_to_cells,
    string_schema,
)
from tableflow.operators.joins import asof_join, full_outer_join, interval_join
from tableflow.operators.regions import region_of
from tableflow.operators.splits import split_keys, split_positions

__all__ = [
    "CELL_COLUMNS",
    "asof_join",
    "cells_to_wide",
    "full_outer_join",
    "interval_join",
    "region_of",
    "row_key",
    "row_to_cells",
    "split_keys",
    "split_positions",
    "string_schema",
]
