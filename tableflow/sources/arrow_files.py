"""Arrow files through Spark's Python Data Source API: read in parts with pushed filters, written with commit.

Each file holds the least and greatest value of its columns. A filter that is pushed leaves out the files
that cannot hold a match, and is applied to the rows of the others, so that Spark need not.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, ipc
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema

# readers and writers travel with their tasks: executors need not have this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ENDING = ".arrow"
_STATS = b"tableflow.ranges"
# What a file's range says about a filter, and the filter itself.
_RANGES = {
    EqualTo: lambda low, high, value: low <= value <= high,
    GreaterThan: lambda low, high, value: high > value,
    GreaterThanOrEqual: lambda low, high, value: high >= value,
    LessThan: lambda low, high, value: low < value,
    LessThanOrEqual: lambda low, high, value: low <= value,
    In: lambda low, high, values: any(value is not None and low <= value <= high for value in values),
}
_MASKS = {
    EqualTo: pc.equal,
    GreaterThan: pc.greater,
    GreaterThanOrEqual: pc.greater_equal,
    LessThan: pc.less,
    LessThanOrEqual: pc.less_equal,
    In: lambda column, values: pc.is_in(column, pa.array([v for v in values if v is not None], column.type)),
}


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _files(path: str) -> list[str]:
    where, folder = _folder(path)
    entries = where.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(entry.path for entry in entries if entry.path.endswith(_ENDING))


@dataclass
class ArrowFile(InputPartition):
    path: str


class ArrowFiles(DataSource):
    """Options: ``path``, given as the location."""

    @classmethod
    def name(cls) -> str:
        return "arrow_files"

    def schema(self) -> T.StructType:
        files = _files(self.options["path"])
        if not files:
            raise ValueError(f"no {_ENDING} files in {self.options['path']}")
        where, _ = _folder(self.options["path"])
        with where.open_input_file(files[0]) as file:
            return from_arrow_schema(ipc.open_file(file).schema.remove_metadata())

    def reader(self, schema: T.StructType) -> ArrowFilesReader:
        return ArrowFilesReader(self.options["path"])

    def writer(self, schema: T.StructType, overwrite: bool) -> ArrowFilesWriter:
        return ArrowFilesWriter(self.options["path"], overwrite)


class ArrowFilesReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.filters = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes comparisons of a column with a value; the others are left to Spark."""
        for one in filters:
            known = type(one) in _MASKS or isinstance(one, IsNotNull)
            if known and len(one.attribute) == 1 and getattr(one, "value", 0) is not None:
                self.filters.append(one)
            else:
                yield one

    def partitions(self) -> list[ArrowFile]:
        where, _ = _folder(self.path)
        found = []
        for path in _files(self.path):
            with where.open_input_file(path) as file:
                ranges = json.loads((ipc.open_file(file).schema.metadata or {}).get(_STATS, b"{}"))
            if all(_may_match(one, ranges) for one in self.filters):
                found.append(ArrowFile(path))
        return found

    def read(self, partition: ArrowFile) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file is left
            return
        where, _ = _folder(self.path)
        with where.open_input_file(partition.path) as file:
            reader = ipc.open_file(file)
            for number in range(reader.num_record_batches):
                batch = reader.get_batch(number).replace_schema_metadata(None)
                masks = [_mask(one, batch) for one in self.filters]
                yield batch.filter(reduce(pc.and_, masks)) if masks else batch


def _may_match(one: Filter, ranges: dict) -> bool:
    span = ranges.get(one.attribute[0])
    if span is None or type(one) not in _RANGES:
        return True
    low, high = span
    return low is not None and _RANGES[type(one)](low, high, one.value)


def _mask(one: Filter, batch: pa.RecordBatch) -> pa.Array:
    column = batch.column(one.attribute[0])
    return pc.is_valid(column) if isinstance(one, IsNotNull) else _MASKS[type(one)](column, one.value)


@dataclass
class WrittenFile(WriterCommitMessage):
    path: str | None


class ArrowFilesWriter(DataSourceArrowWriter):
    """Tasks write into a folder of the job's own; its files become visible when all tasks have ended."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, uuid.uuid4().hex
        # made once, on the driver: a task that still runs when the job is aborted finds no folder
        _folder(self.path)[0].create_dir(self._staging(), recursive=True)

    def _staging(self) -> str:
        return f"{_folder(self.path)[1]}/_job-{self.job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WrittenFile:
        rows = [batch for batch in batches if len(batch)]
        if not rows:
            return WrittenFile(None)
        table = pa.Table.from_batches(rows)
        ranges = {}
        for name, column in zip(table.column_names, table.columns, strict=True):
            if pa.types.is_integer(column.type) or pa.types.is_string(column.type):
                span = pc.min_max(column).as_py()
                ranges[name] = [span["min"], span["max"]]
        where, _ = _folder(self.path)
        path = f"{self._staging()}/part-{uuid.uuid4().hex}{_ENDING}"
        schema = table.schema.with_metadata({_STATS: json.dumps(ranges).encode()})
        with where.open_output_stream(path) as out, ipc.new_file(out, schema) as file:
            for batch in rows:
                file.write_batch(batch.cast(schema))
        return WrittenFile(path)

    def commit(self, messages: list[WrittenFile]) -> None:
        """Moves what the tasks that count have written; what others left goes with their folder."""
        where, folder = _folder(self.path)
        where.create_dir(folder, recursive=True)
        before = _files(self.path)
        for message in messages:
            if message is not None and message.path:
                where.move(message.path, f"{folder}/{message.path.rsplit('/', 1)[1]}")
        if self.overwrite:
            for path in before:
                where.delete_file(path)
        self.abort(messages)

    def abort(self, messages: list[WrittenFile]) -> None:
        where, _ = _folder(self.path)
        if where.get_file_info(self._staging()).type == fs.FileType.Directory:
            where.delete_dir(self._staging())
