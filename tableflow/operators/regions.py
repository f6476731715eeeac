"""Placing cells in the regions between split keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tableflow.operators.search import count_up_to


def region_of(key: Column | str, splits: Sequence[str]) -> Column:
    """The region of a row key: the number of split keys that are not greater than it.

    The first and the last region are open-ended, so any key has one.
    """
    key = F.col(key) if isinstance(key, str) else key
    return count_up_to(key, splits)
