"""Canonical text for cell values: what is written reads back with its type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ZONED = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_LOCAL = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# JSON keeps whole microseconds, and the offset of zoned times.
_JSON = {"timestampFormat": _ZONED, "timestampNTZFormat": _LOCAL}
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def encode_value(column: Column, kind: T.DataType) -> Column:
    """A value of any type as text; null stays null."""
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.BinaryType):
        return F.base64(column)
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, _ZONED)
    if isinstance(kind, _NESTED):
        return F.to_json(_with_entries(column, kind), _JSON)
    return column.cast("string")


def decode_value(column: Column, kind: T.DataType | str) -> Column:
    """Text back as a value of the type; text that does not fit gives null."""
    if isinstance(kind, str):
        kind = T._parse_datatype_string(kind)
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.BinaryType):
        return F.try_to_binary(column, F.lit("base64"))
    if isinstance(kind, _NESTED):
        return _with_maps(F.from_json(column, _entries_type(kind), _JSON), kind)
    return column.try_cast(kind)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(field.dataType) for field in kind)


def _entries_type(kind: T.DataType) -> T.DataType:
    """The type with every map, however deep, as an array of its entries: JSON keys are text only."""
    if isinstance(kind, T.MapType):
        entry = T.StructType().add("key", _entries_type(kind.keyType)).add("value", _entries_type(kind.valueType))
        return T.ArrayType(entry)
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_entries_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _entries_type(f.dataType), f.nullable) for f in kind])
    return kind


def _rebuilt(column: Column, kind: T.DataType, step: Callable[[Column, T.DataType], Column]) -> Column:
    """A struct or array with ``step`` applied to what it holds."""
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: step(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [step(column.getField(f.name), f.dataType).alias(f.name) for f in kind]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def _with_entries(column: Column, kind: T.DataType) -> Column:
    if not _has_map(kind):
        return column
    if isinstance(kind, T.MapType):
        return F.transform(
            F.map_entries(column),
            lambda e: F.struct(
                _with_entries(e.getField("key"), kind.keyType).alias("key"),
                _with_entries(e.getField("value"), kind.valueType).alias("value"),
            ),
        )
    return _rebuilt(column, kind, _with_entries)


def _with_maps(column: Column, kind: T.DataType) -> Column:
    if not _has_map(kind):
        return column
    if isinstance(kind, T.MapType):
        return F.map_from_entries(
            F.transform(
                column,
                lambda e: F.struct(
                    _with_maps(e.getField("key"), kind.keyType).alias("key"),
                    _with_maps(e.getField("value"), kind.valueType).alias("value"),
                ),
            )
        )
    return _rebuilt(column, kind, _with_maps)
