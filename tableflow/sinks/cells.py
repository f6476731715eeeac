"""Cell sinks: plain puts, and the sorted bulk load."""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.operators.cells import encoded_columns, row_key, row_to_cells, unpivot_cells
from tableflow.operators.regions import region_of
from tableflow.operators.search import array_literal
from tableflow.operators.splits import split_keys
from tableflow.session import hadoop_path, remove
from tableflow.sinks.store import OPEN_FILES, UNPLACED, CellStore, new_load_id, writing_session
from tableflow.spec import TargetSpec

# Stored bytes, and cells, one task should sort and write; they set the number of tasks, nothing else.
BYTES_PER_TASK = 256 * 1024 * 1024
CELLS_PER_TASK = 10_000_000
# Regions of one task, which keeps a file open for each.
REGIONS_PER_TASK = OPEN_FILES


def write_cells(df: DataFrame, spark: SparkSession, target: TargetSpec) -> None:
    """Every column of every row becomes a cell under one row key and family.

    Options: ``tablename`` (a table, or a path) and ``cf``; optional ``format``, ``location`` for a new
    table, and ``key-columns`` to take the row key from columns instead of a random UUID. With ``bulkload: true`` also
    ``bulk-stg``, a folder every executor shares, and ``num-regions``, or ``buckets`` for a catalog table that is
    read and joined by row key without a shuffle.
    """
    name, cf = target.require("tablename", "cf")
    buckets = int(target.option("buckets", 0))
    store = CellStore(spark, name, target.option("format", ""), target.option("location", ""), buckets)
    keys = target.option("key-columns")
    keys = [keys] if isinstance(keys, str) else keys
    # one write time for the whole load; a later load has a greater one
    version = int(target.option("version", time.time_ns() // 1_000_000))
    if not target.flag("bulkload"):
        if buckets:
            raise ValueError("rows that are put are not moved, so they cannot be bucketed: use bulkload")
        put_cells(df, store, cf, keys, version)
        return
    if store.buckets:
        bulk_load(df, store, cf, 1, target.require("bulk-stg")[0], keys, version)
        return
    regions, staging = target.require("num-regions", "bulk-stg")
    bulk_load(df, store, cf, int(regions), staging, keys, version)


def put_cells(
    df: DataFrame, store: CellStore, cf: str, keys: Sequence[str] | None, version: int
) -> None:
    """Append the cells in one pass; a store that does not exist yet starts with one region."""
    if store.buckets:
        raise ValueError(f"{store.name} is bucketed: rows have to come by bulkload")
    store.put(row_to_cells(df, row_key(df, keys), cf, _long(version)), new_load_id(), version)


def bulk_load(
    df: DataFrame,
    store: CellStore,
    cf: str,
    regions: int,
    staging: str,
    keys: Sequence[str] | None,
    version: int,
) -> None:
    """Key and stage the rows, find or reuse split keys, insert sorted cells, finish the load.

    Rows are stored with their keys first. Split keys, row counts and the cells then all
    see the same keys, also when a lost executor makes Spark run a task twice; and the job that
    produced ``df`` runs once instead of once per pass.
    """
    store.check_format()
    load = new_load_id()
    folder = f"{staging.rstrip('/')}/{load}"
    try:
        rows = store_keyed_rows(df, keys, f"{folder}/rows")
        if store.buckets:
            splits = []
            cells = bucketed_cells(rows, store.buckets, cf, version)
        else:
            splits = store.splits()
            splits = split_keys(rows.frame, regions) if splits is None else splits
            cells = region_cells(rows, splits, cf, version)
        store.add(cells, load)
        store.finish(load, splits, version)
    finally:
        # this run's own folder, named by its load id
        remove(df.sparkSession, folder)


@dataclass(frozen=True)
class KeyedRows:
    """Stored rows: ``rowkey``, and the data columns as text under ``c0``, ``c1``, ..."""

    frame: DataFrame
    path: str
    names: list[str]
    unique: bool  # whether no two rows share a key; else ``spread`` may part rows that do
    size: int  # bytes on disk


def store_keyed_rows(df: DataFrame, keys: Sequence[str] | None, path: str) -> KeyedRows:
    """Write rows with their key.

    Rows with keys of the user's choice also get a random number, ``spread``. Data columns get
    neutral names, so a column called ``rowkey`` or holding odd characters does not matter.
    """
    columns = [row_key(df, keys).alias("rowkey")]
    if keys:
        columns.append(F.floor(F.rand() * (1 << 30)).cast("int").alias("spread"))
    columns += [text.alias(f"c{at}") for at, text in enumerate(encoded_columns(df))]
    keyed = df.select(*columns)
    keyed.write.parquet(path)
    stored = df.sparkSession.read.schema(keyed.schema).parquet(path)
    fs, folder = hadoop_path(df.sparkSession, path)
    size = fs.getContentSummary(folder).getLength()
    return KeyedRows(stored, path, df.columns, unique=not keys, size=size)


def deal_regions(counts: Mapping[int, int], rows_per_task: float) -> tuple[list[int], list[int], int]:
    """First task and number of tasks of each region, and the number of tasks in all.

    Neighbouring regions share a task as long as they are small; a region with more rows than a task
    should have gets several tasks of its own.
    """
    first, parts, tasks, held, regions = [], [], 0, 0, 0
    for region in range(max(counts, default=-1) + 1):
        rows = counts.get(region, 0)
        pieces = max(1, math.ceil(rows / rows_per_task))
        if tasks == 0 or pieces > 1 or held + rows > rows_per_task or regions == REGIONS_PER_TASK:
            tasks, held, regions = tasks + pieces, 0, 0
        first.append(tasks - pieces)
        parts.append(pieces)
        held, regions = held + rows if pieces == 1 else rows_per_task, regions + 1
    return first, parts, tasks


def region_cells(rows: KeyedRows, splits: Sequence[str], cf: str, version: int) -> DataFrame:
    """The cells with their ``region``, each task's sorted by region, row key and qualifier.

    The rows of each region are counted, which reads the keys alone, and dealt to tasks by region; a
    large region, or one hot key, to several. One exchange moves the rows, whatever their number and
    that of the regions. What is shuffled and sorted are rows, not the many more cells: a row becomes
    its cells, in qualifier order, in the task that writes them. Only where rows may share a key are
    the cells sorted once more.
    """
    placed = _staged(rows).withColumn("region", region_of("rowkey", splits))
    counts = {row["region"]: row["count"] for row in placed.groupBy("region").count().collect()}
    total = sum(counts.values())
    share = max(rows.size / BYTES_PER_TASK, total * len(rows.names) / CELLS_PER_TASK)
    first, parts, tasks = deal_regions(counts, max(1.0, total / share if share else total))
    piece = F.xxhash64("rowkey") if rows.unique else F.col("spread")
    task = F.get(array_literal(first, "int"), F.col("region")) + F.pmod(
        piece, F.get(array_literal(parts, "int"), F.col("region"))
    ).cast("int")
    placed = placed.repartitionById(max(1, tasks), task).sortWithinPartitions("region", "rowkey")
    cells = _in_qualifier_order(rows, placed, cf, version)
    return cells if rows.unique else cells.sortWithinPartitions("region", "rowkey", "qualifier")


def bucketed_cells(rows: KeyedRows, buckets: int, cf: str, version: int) -> DataFrame:
    """The cells of rows dealt to tasks as the table's buckets are: one file per bucket and load.

    The cells of a row key are one bucket however many they are, as in any bucketed table.
    """
    dealt = _staged(rows).repartition(buckets, "rowkey").withColumn("region", F.lit(UNPLACED))
    return _in_qualifier_order(rows, dealt, cf, version)


def _staged(rows: KeyedRows) -> DataFrame:
    return writing_session(rows.frame.sparkSession).read.schema(rows.frame.schema).parquet(rows.path)


def _in_qualifier_order(rows: KeyedRows, placed: DataFrame, cf: str, version: int) -> DataFrame:
    texts = {name: F.col(f"c{at}") for at, name in enumerate(rows.names)}
    in_order = {name: texts[name] for name in sorted(texts)}
    return unpivot_cells(placed, F.col("rowkey"), in_order, cf, _long(version), ["region"])


def _long(number: int) -> Column:
    return F.lit(number).cast("bigint")
