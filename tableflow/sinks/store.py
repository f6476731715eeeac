"""Where cells live: a partitioned table of cells, and beside it a table of its loads.

    <store>          the cells, partitioned by load and region
    <store>_loads    one row per finished load: format, split keys, write time
    <store>_stream   cells that streams have put, in batches that Spark's own log knows

Both are ordinary tables, in the catalog or addressed by path, and only Spark's writers write them. A
load overwrites partitions of its own and no others (dynamic partition overwrite), for which Spark
stages the files in a folder of that one job: loads may overlap, and a task that runs twice
leaves nothing. The load's row is written last, and readers take the loads that have one. A load that
dies before leaves no cells, split keys or format that anyone reads, and can be repeated.

Every load was laid out by split keys it names in its row, its own or those of an earlier load.
A range of row keys is therefore looked up load by load.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Collection
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.operators.cells import CELL_COLUMNS
from tableflow.session import moved_to, private_session

_CELLS = "rowkey string, cf string, qualifier string, version bigint, value string"
_PARTS = ("load", "region")
_SCHEMA = f"{_CELLS}, load string, region int"
_LOADS = "format string, splits array<string>, version bigint, load string"
# Region of cells that were put one by one rather than laid out by key.
UNPLACED = -1
# Formats that keep null, '' and ' x ' apart; text formats do not.
KINDS = ("parquet", "orc")
# Regions a task keeps a file open for. Its rows come in region order, which Spark does not know
# after the unpivot: without open files it would sort them by region once more.
OPEN_FILES = 64


def new_load_id() -> str:
    """A load id that sorts by time and reads as text, never as a number."""
    now = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
    return f"{now}-{uuid.uuid4().hex}"


def writing_session(spark: SparkSession) -> SparkSession:
    """A session whose inserts overwrite only the partitions they bring."""
    mode = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
    return private_session(spark, mode | {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)})


class PartitionedTable:
    """A table by name or by path (a name with a slash), to which writers bring partitions of their own."""

    def __init__(self, spark: SparkSession, name: str, parts: tuple[str, ...]):
        self.spark, self.parts = spark, parts
        self.by_path = "/" in name
        self.name = name.rstrip("/") if self.by_path else name.replace(":", ".")

    def exists(self) -> bool:
        """Whether the catalog has the table; of a path only its files tell."""
        return not self.by_path and self.spark.catalog.tableExists(self.name)

    def described(self, what: str) -> str | None:
        if not self.exists():
            return None
        row = self.spark.sql(f"describe table extended {self.name}").where(F.col("col_name") == what).first()
        return row.data_type if row else None

    def frame(self, kind: str = "parquet", schema: str | None = None) -> DataFrame | None:
        """The rows; None if there is no such table."""
        if not self.by_path:
            if not self.exists():
                return None
            if schema:  # a view has nothing to refresh
                self.spark.catalog.refreshTable(self.name)
            return self.spark.table(self.name)
        try:
            reader = self.spark.read.format(kind)
            return (reader.schema(schema) if schema else reader).load(self.name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def create(self, schema: str, kind: str = "parquet", folder: str = "", buckets: int = 0) -> None:
        """Create the table if there is none; a folder comes with its first files."""
        if self.by_path:
            return
        bucketed = f" clustered by (rowkey) sorted by (rowkey) into {buckets} buckets" if buckets else ""
        at = f" location '{folder}'" if folder else ""
        parts = f" partitioned by ({', '.join(self.parts)})"
        self.spark.sql(f"create table if not exists {self.name} ({schema}) using {kind}{parts}{bucketed}{at}")

    def insert(self, rows: DataFrame, kind: str = "parquet") -> None:
        """Write rows over the partitions they belong to, and no others.

        The rows belong to a ``writing_session`` or are handed over to one.
        """
        session = rows.sparkSession
        if session.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
            session = writing_session(session)
        with moved_to(session, rows) as own:
            if self.by_path:
                own.write.format(kind).mode("overwrite").partitionBy(*self.parts).save(self.name)
            else:
                own.write.mode("overwrite").insertInto(self.name)


@dataclass(frozen=True)
class Load:
    """A finished load. ``splits`` are the keys it was laid out by; None if it was put."""

    id: str
    format: str
    splits: tuple[str, ...] | None
    version: int

    def regions(self, first: str | None, end: str | None) -> tuple[int, int]:
        """The regions that row keys from ``first`` to before ``end`` are in."""
        low = 0 if first is None else bisect_right(self.splits, first)
        return low, len(self.splits) if end is None else bisect_left(self.splits, end)


class CellStore:
    """A store by path (a name with a slash) or by table name (``namespace:table`` or ``db.table``).

    ``folder`` is where a table that does not exist yet keeps its data, if not in the warehouse;
    ``buckets`` makes it a table bucketed by row key.
    """

    def __init__(self, spark: SparkSession, name: str, kind: str = "", folder: str = "", buckets: int = 0):
        self.spark, self.asked, self.folder, self.asked_buckets = spark, kind.lower(), folder, buckets
        self.cells = PartitionedTable(spark, name, _PARTS)
        self.name = self.cells.name
        self.finished = PartitionedTable(spark, f"{self.name}_loads", ("load",))
        self.streamed = PartitionedTable(spark, f"{self.name}_stream", ())
        if self.cells.by_path and buckets:
            raise ValueError(f"only a catalog table can be bucketed, not {self.name}")

    def loads(self) -> list[Load]:
        """Finished loads, oldest first."""
        rows = self.finished.frame(schema=_LOADS)
        if rows is None:
            return []
        found = [
            Load(row.load, row.format, None if row.splits is None else tuple(row.splits), row.version)
            for row in rows.collect()
        ]
        return sorted(found, key=lambda load: load.id)

    def exists(self) -> bool:
        return bool(self.loads()) or self._streamed() is not None

    @property
    def kind(self) -> str:
        """The format of the store: the table's, else its first load's, else the one asked for."""
        first = self.cells.described("Provider")
        if self.cells.by_path:
            first = next((load.format for load in self.loads()), None)
        return (first or self.asked or "parquet").lower()

    @property
    def buckets(self) -> int:
        """Buckets of the table; 0 if it has none."""
        return int(self.cells.described("Num Buckets") or 0) if self.cells.exists() else self.asked_buckets

    def check_format(self) -> None:
        """A store has one format, whoever writes, and one that loses nothing."""
        kind = self.kind
        if self.asked and self.asked != kind:
            raise ValueError(f"{self.name} holds {kind} cells, not {self.asked}")
        if kind not in KINDS:
            raise ValueError(f"cells cannot be kept as {kind}: use {' or '.join(KINDS)}")
        if self.asked_buckets and self.asked_buckets != self.buckets:
            raise ValueError(f"{self.name} has {self.buckets} buckets, not {self.asked_buckets}")

    def splits(self) -> list[str] | None:
        """The split keys later loads reuse, or None when the store does not exist.

        The list is shorter than the number of regions its creator asked for.
        """
        of_a_load = (list(load.splits) for load in self.loads() if load.splits is not None)
        return next(of_a_load, None if self._streamed() is None else [])

    def read(
        self,
        first: str | None = None,
        end: str | None = None,
        loads: Collection[Load] | None = None,
    ) -> DataFrame:
        """The cells, of row keys from ``first`` to before ``end`` and of some loads if given.

        Also of a plain folder or table of cells that no sink of ours wrote. Loads and key ranges
        become partition filters: each load's regions of the range are read, by the split keys of that
        load, and the cells that were put one by one. What streams have put belongs to no load: it is
        part of all cells, and not of some loads'.
        """
        known = self.loads()
        streamed = None if loads is not None else self._streamed()
        if streamed is not None:
            cells = self._cells_of(known, first, end).select(*CELL_COLUMNS).unionByName(streamed)
        elif not known:
            cells = self.cells.frame(self.asked or "parquet")
            if cells is None:
                raise ValueError(f"there are no cells at {self.name}")
        else:
            cells = self._cells_of(known if loads is None else loads, first, end)
        if first is not None:
            cells = cells.where(F.col("rowkey") >= first)
        if end is not None:
            cells = cells.where(F.col("rowkey") < end)
        return cells.select(*CELL_COLUMNS)

    def stream_path(self) -> str:
        """Where streams put cells of a store that is addressed by path."""
        if not self.streamed.by_path:
            raise ValueError(f"a stream puts cells into a store by path, not into table {self.name}")
        return self.streamed.name

    def _streamed(self) -> DataFrame | None:
        return self.streamed.frame("parquet", _CELLS) if self.streamed.by_path else None

    def _cells_of(self, loads: Collection[Load], first: str | None, end: str | None) -> DataFrame:
        """Cells of finished loads, which of a path may even differ in format."""
        by_format = defaultdict(list)
        for load in loads:
            by_format[load.format].append(load)
        parts = []
        for kind, own in by_format.items():
            frame = self.cells.frame(kind, _SCHEMA)
            if frame is not None:
                parts.append(frame.where(_partitions(own, first, end)))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], _SCHEMA)

    def add(self, cells: DataFrame, load: str) -> None:
        """Write the cells of a load by ``region``; nobody reads them before its ``finish``."""
        kind = self.kind
        self.cells.create(_SCHEMA, kind, self.folder, self.asked_buckets)
        self.cells.insert(cells.withColumn("load", F.lit(load)).select(*CELL_COLUMNS, *_PARTS), kind)

    def finish(self, load: str, splits: list[str] | None, version: int) -> None:
        """Make a load visible, by one row."""
        keys = F.from_json(F.lit(None if splits is None else json.dumps(splits)), "array<string>")
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(self.kind).alias("format"),
            keys.alias("splits"),
            F.lit(version).cast("bigint").alias("version"),
            F.lit(load).alias("load"),
        )
        self.finished.create(_LOADS, folder=f"{self.folder.rstrip('/')}_loads" if self.folder else "")
        self.finished.insert(row)

    def put(self, cells: DataFrame, load: str, version: int) -> None:
        """Add cells where the tasks that made them left them: no shuffle, no sort."""
        self.check_format()
        splits = None if self.exists() else []
        self.add(cells.withColumn("region", F.lit(UNPLACED)), load)
        self.finish(load, splits, version)


def _partitions(loads: Collection[Load], first: str | None, end: str | None) -> Column:
    """Whether a partition may hold cells of the loads in a range of row keys."""
    by_regions = defaultdict(list)
    for load in loads:
        narrowed = load.splits is not None and (first is not None or end is not None)
        by_regions[load.regions(first, end) if narrowed else None].append(load.id)
    wanted = []
    for regions, ids in by_regions.items():
        own = F.col("load").isin(ids)
        if regions is not None:
            own &= F.col("region").between(*regions) | (F.col("region") == UNPLACED)
        wanted.append(own)
    return reduce(or_, wanted, F.lit(False)) if len(wanted) != 1 else wanted[0]
