"""Incremental reads of cell stores: which loads a job has read is kept from run to run."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tableflow.sinks.store import CellStore, Load, PartitionedTable
from tableflow.spec import PipelineSpec, SourceSpec

_MARKS = "job string, store string, version bigint, load string, run string"


def _marks(spark: SparkSession, increment: dict) -> PartitionedTable:
    missing = [name for name in ("job", "marks") if not increment.get(name)]
    if missing:
        raise ValueError(f"custom.increment needs {' and '.join(missing)}")
    return PartitionedTable(spark, increment["marks"], ("run",))


def unread_loads(spark: SparkSession, source: SourceSpec) -> list[Load]:
    """The finished loads of a source's store that its job has no mark of, oldest first.

    Marks name loads rather than a time: a load that began before the last run and ended after it is
    read by the next one.
    """
    increment = source.custom["increment"]
    store = CellStore(spark, source.location, source.format)
    rows = _marks(spark, increment).frame(schema=_MARKS)
    seen = set()
    if rows is not None:
        own = rows.where((F.col("job") == increment["job"]) & (F.col("store") == store.name))
        seen = {row.load for row in own.select("load").collect()}
    return [load for load in store.loads() if load.id not in seen]


def chosen_loads(spark: SparkSession, source: SourceSpec) -> list[Load] | None:
    """The loads a cell source reads; None for all.

    ``custom.versions`` bounds their write time, ``after`` one and up to another (``to``);
    ``custom.increment`` leaves out what the ``job`` has read by earlier runs, as its ``marks`` (a table or a
    path) say; ``custom.loads`` names them.
    """
    custom = source.custom
    if not {"versions", "increment", "loads"} & set(custom):
        return None
    span = custom.get("versions") or {}
    unknown = set(span) - {"after", "to"}
    if unknown:
        raise ValueError(f"custom.versions of cell source {source.id!r} has 'after' and 'to', not {sorted(unknown)}")
    if "loads" in custom:
        named = set(custom["loads"])
        loads = [load for load in CellStore(spark, source.location, source.format).loads() if load.id in named]
    elif "increment" in custom:
        loads = unread_loads(spark, source)
    else:
        loads = CellStore(spark, source.location, source.format).loads()
    low, high = (None if span.get(name) is None else int(span[name]) for name in ("after", "to"))
    return [
        load
        for load in loads
        if (low is None or load.version > low) and (high is None or load.version <= high)
    ]


def with_loads_named(spark: SparkSession, spec: PipelineSpec) -> tuple[PipelineSpec, list[tuple[SourceSpec, list[Load]]]]:
    """The spec with each incremental source's loads named, so that they stay the same until they are marked."""
    sources, read = [], []
    for source in spec.sources:
        if "increment" in source.custom:
            loads = chosen_loads(spark, source)
            read.append((source, loads))
            source = dataclasses.replace(source, custom=source.custom | {"loads": [load.id for load in loads]})
        sources.append(source)
    return dataclasses.replace(spec, sources=sources), read


def mark_read(spark: SparkSession, read: Sequence[tuple[SourceSpec, list[Load]]]) -> None:
    """Note that loads were read, once what came of them is written.

    A run that ends between the two reads them again: a target that is to have them once overwrites.
    """
    for source, loads in read:
        increment = source.custom["increment"]
        if loads:
            store, run = CellStore(spark, source.location, source.format).name, uuid.uuid4().hex
            rows = [(increment["job"], store, load.version, load.id, run) for load in loads]
            marks = _marks(spark, increment)
            marks.create(_MARKS)
            marks.insert(spark.createDataFrame(rows, _MARKS).coalesce(1))
