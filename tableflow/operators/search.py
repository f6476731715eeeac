"""Binary search of a sorted list as one column expression."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Entries of a list that becomes a tree of conditions.
TREE = 256


def array_literal(values: Sequence, element_type: str) -> Column:
    """A constant array; sent as one JSON text, which Catalyst folds once."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{element_type}>")


def count_up_to(column: Column, ordered: Sequence, element_type: str = "string") -> Column:
    """How many entries of the sorted list are <= the column, in log2(length) comparisons.

    Up to ``TREE`` entries make a balanced tree of conditions, which is compiled. A longer list would
    make too large a method: it is searched in a constant array by halving steps, where a step past
    the end reads null and is not taken.
    """
    if not ordered:
        return F.lit(0)
    if len(ordered) <= TREE:
        return _tree(column, ordered, 0, len(ordered), element_type)
    entries = array_literal(ordered, element_type)
    steps = [1 << bit for bit in reversed(range(len(ordered).bit_length()))]
    return F.reduce(
        array_literal(steps, "int"),
        F.lit(0),
        lambda at, step: F.when(F.get(entries, at + step - 1) <= column, at + step).otherwise(at),
    )


def _tree(column: Column, ordered: Sequence, low: int, high: int, element_type: str) -> Column:
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    above = column >= F.lit(ordered[middle]).cast(element_type)
    return F.when(above, _tree(column, ordered, middle + 1, high, element_type)).otherwise(
        _tree(column, ordered, low, middle, element_type)
    )
