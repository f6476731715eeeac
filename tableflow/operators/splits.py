"""Exact equi-depth split keys, without sorting the whole key column."""

from __future__ import annotations

import math
from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableflow.operators.search import array_literal, count_up_to

# Documented parameters; none of them changes the result.
# Keys a single gap may hold before it is narrowed further; a gap is sorted by one task.
GAP_ROWS = 1_000_000
# Sampled keys per narrowing pass of a large table, and least number per wanted split. The sample and
# its counts are on the driver, and travel with every task: about 40 bytes a key, so 1,000 regions
# mean 20,000 keys or 1 MB.
SAMPLE_KEYS = 10_000
SAMPLE_KEYS_PER_SPLIT = 20


def split_positions(total: int, regions: int) -> list[int]:
    """Sorted positions of the split keys: i * total / (regions - 1), added up, rounded half up."""
    if regions < 1:
        raise ValueError(f"the number of regions must be at least 1, got {regions}")
    count = regions - 1
    positions, at = [], 0.0
    for _ in range(count):
        positions.append(math.floor(at + 0.5))
        at += total / count
    return positions


@dataclass(frozen=True)
class _Gap:
    """Keys strictly between two edges that hold a wanted position."""

    index: int  # how many edges lie below
    start: int  # position of its first key among all keys
    rows: int


def split_keys(
    df: DataFrame,
    regions: int,
    key: str = "rowkey",
    *,
    gap_rows: int = GAP_ROWS,
    sample_keys: int = SAMPLE_KEYS,
    seed: int = 17,
) -> list[str]:
    """The keys that start regions 1, 2, ... when rows are dealt evenly over sorted keys.

    They are the keys at ``split_positions`` of the sorted key column, nulls first and then
    dropped, each key once. There are at most ``regions - 1`` of them and the first is the
    smallest key.

    ``df`` is read several times and must give the same keys each time; store random keys first.

    Sorting every key to read off a few would shuffle the whole column. Instead, a fixed-size
    sample of keys cuts the key space into gaps, each task counts its keys per gap, and only the
    few gaps that hold a wanted position are looked at again. The sample decides how fast the gaps
    shrink, never the result: every position comes from complete counts. Sampled keys are
    counted on their own, so a key that holds a third of all rows is one count, and not a large gap.
    """
    keys = df.select(F.col(key).cast("string").alias("k"))
    total = keys.count()  # of stored rows, from file footers
    positions = split_positions(total, regions) if total else []
    if not positions:
        return []
    if total <= gap_rows:
        return sorted(_sorted_pick(keys.withColumn("gap", F.lit(0)), {0: 0}, positions))

    edges, found, gaps, wanted = [""], set(), None, positions  # no key sorts before the empty one
    while gaps is None or (gaps and max(gap.rows for gap in gaps) > gap_rows):
        rows = total if gaps is None else sum(gap.rows for gap in gaps)
        inside = keys if gaps is None else _inside(keys, edges, gaps)
        size = max(SAMPLE_KEYS_PER_SPLIT * len(wanted), min(sample_keys, rows // 100))
        sample = inside.select("k").sample(min(1.0, size / rows), seed).distinct().collect()
        seed += 1
        sampled = {row.k for row in sample if row.k is not None}
        near = {""} if gaps is None else _edges_around(edges, gaps)
        finer = sorted(near | sampled)
        # counts of all slots: those outside the gaps are few, and need no second search to leave out
        counts = dict(map(tuple, keys.groupBy(_slot(F.col("k"), finer).alias("slot")).count().collect()))
        if gaps is None:
            nulls, empty = counts.get(None, 0), counts.get(1, 0)
            # positions among the non-null keys
            wanted = sorted({at - nulls for at in positions if nulls <= at < total})
            found = {""} if _holds(wanted, 0, empty) else set()
            gaps = [_Gap(1, empty, total - nulls - empty)] if wanted and wanted[-1] >= empty else []
        more, gaps = _narrow(edges, gaps, finer, counts, wanted)
        found |= more
        edges = finer
    if gaps:
        starts = {2 * gap.index: gap.start for gap in gaps}
        found |= _sorted_pick(_inside(keys, edges, gaps), starts, wanted)
    return sorted(found)


def _slot(key: Column, edges: list[str]) -> Column:
    """2 * (edges below) for a key between edges, one less than that for an edge itself; null for null.

    The search is the argument of a lambda, so that it runs once per row and not once per use.
    """
    entries = array_literal(edges, "string")

    def slot(below: Column) -> Column:
        return F.when(F.get(entries, below - 1) == key, 2 * below - 1).otherwise(2 * below)

    found = F.element_at(F.transform(F.array(count_up_to(key, edges)), slot), 1)
    return F.when(key.isNotNull(), found)


def _inside(keys: DataFrame, edges: list[str], gaps: list[_Gap]) -> DataFrame:
    """The keys in the given gaps, each with its slot."""
    slots = keys.withColumn("gap", _slot(F.col("k"), edges))
    return slots.where(F.col("gap").isin([2 * gap.index for gap in gaps]))


def _edges_around(edges: list[str], gaps: list[_Gap]) -> set[str]:
    near = {at for gap in gaps for at in (gap.index - 1, gap.index)}
    return {edges[at] for at in near if 0 <= at < len(edges)}


def _narrow(
    edges: list[str],
    gaps: list[_Gap],
    finer: list[str],
    counts: dict[int, int],
    wanted: list[int],
) -> tuple[set[str], list[_Gap]]:
    """Split keys that are edges of the finer cut, and its gaps that hold the other positions."""
    found, smaller = set(), []
    for gap in gaps:
        first = 2 * bisect_left(finer, edges[gap.index - 1]) + 2
        last = 2 * bisect_left(finer, edges[gap.index]) if gap.index < len(edges) else 2 * len(finer)
        start = gap.start
        for slot in range(first, last + 1):
            rows = counts.get(slot, 0)
            if _holds(wanted, start, rows):
                if slot % 2:
                    found.add(finer[slot // 2])
                else:
                    smaller.append(_Gap(slot // 2, start, rows))
            start += rows
    return found, smaller


def _holds(wanted: list[int], start: int, rows: int) -> bool:
    at = bisect_left(wanted, start)
    return at < len(wanted) and wanted[at] < start + rows


def _sorted_pick(inside: DataFrame, starts: dict[int, int], wanted: list[int]) -> set[str]:
    """Split keys inside the gaps, by numbering each gap's sorted keys; a gap is one task's work.

    ``starts`` has the position of the first key of each gap. Nulls come first and are no split keys.
    """
    gaps = sorted(starts)
    first = array_literal([starts[gap] for gap in gaps], "bigint")
    start = F.get(first, count_up_to(F.col("gap"), gaps, "int") - 1)
    number = F.row_number().over(Window.partitionBy("gap").orderBy("k"))
    at = start + number - 1
    picked = inside.select("k", at.alias("at")).where(F.col("at").isin(wanted))
    return {row.k for row in picked.collect() if row.k is not None}
