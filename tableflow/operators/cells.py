"""The sparse cell model: one row per (row key, column family, qualifier, version)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions.codec import encode_value

CELL_COLUMNS = ("rowkey", "cf", "qualifier", "version", "value")
_KEY = "__rowkey"


def quoted(name: str) -> str:
    """A column name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def string_schema(names: Iterable[str]) -> T.StructType:
    """A schema of nullable strings."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def row_key(df: DataFrame, key_columns: Sequence[str] | None = None) -> Column:
    """The row key of each row: a fresh random UUID, or the text of the key columns.

    Several key columns are joined by ``|`` with ``|`` and ``\\`` inside a part escaped, so
    different keys never give the same text. A null key part stops the job.
    """
    if not key_columns:
        return F.uuid()
    parts = encoded_columns(df, key_columns)
    if len(parts) == 1:
        key = parts[0]
    else:
        escaped = [F.regexp_replace(part, r"([|\\])", r"\\$1") for part in parts]
        key = escaped[0]
        for part in escaped[1:]:
            key = F.concat(key, F.lit("|"), part)
    return F.coalesce(key, F.raise_error(f"null row key from {', '.join(key_columns)}"))


def encoded_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """The named columns (default: all) as canonical text, under the given names."""
    names = list(columns or df.columns)
    fields = df.select([quoted(name) for name in names]).schema.fields
    return [
        encode_value(F.col(quoted(name)), field.dataType).alias(name)
        for name, field in zip(names, fields)
    ]


def row_to_cells(
    df: DataFrame, key: Column, cf: str, version: Column, columns: Sequence[str] | None = None
) -> DataFrame:
    """One cell per column per row; a null column gives a cell with a null value.

    The reshaping runs in the scan's own stage; nothing is shuffled.
    """
    names = list(columns or df.columns)
    return unpivot_cells(df, key, dict(zip(names, encoded_columns(df, names))), cf, version)


def unpivot_cells(
    df: DataFrame,
    key: Column,
    texts: Mapping[str, Column],
    cf: str,
    version: Column,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Cells from a row key and one text column per qualifier; a row's cells follow each other.

    ``carry`` names columns every cell of a row repeats.
    """
    kept = [F.col(name).alias(f"__{name}") for name in carry]
    wide = df.select(key.alias(_KEY), *kept, *[text.alias(name) for name, text in texts.items()])
    ids, values = [_KEY, *[f"__{name}" for name in carry]], [quoted(name) for name in texts]
    return wide.unpivot(ids, values, "qualifier", "value").select(
        F.col(_KEY).alias("rowkey"),
        F.lit(cf).alias("cf"),
        "qualifier",
        version.alias("version"),
        "value",
        *[F.col(f"__{name}").alias(name) for name in carry],
    )


def cells_to_wide(
    cells: DataFrame,
    cf: str,
    mapping: Mapping[str, str],
    keep_empty_rows: bool = True,
) -> DataFrame:
    """One row per row key: ``rowkey`` and, per mapping entry, the newest value of a qualifier.

    ``mapping`` goes from output column to qualifier. A missing cell is null, and so is one whose
    newest version is null; equal versions are decided by the greater value. Row keys with none
    of the mapped cells are kept unless ``keep_empty_rows`` is false, which lets the scan skip
    every other cell.

    Each task reduces its cells to one row per row key before the one shuffle, so a row key that
    holds a large part of the table reaches its reducer as a few rows.
    """
    if "rowkey" in mapping:
        raise ValueError("an output column of a cell mapping cannot be called 'rowkey'")
    if not mapping:
        return cells.select("rowkey").distinct()
    qualifiers = list(dict.fromkeys(mapping.values()))
    if not keep_empty_rows:
        cells = cells.where((F.col("cf") == cf) & F.col("qualifier").isin(qualifiers))
    # What is sorted and shuffled is a small number and one struct, and nothing of unmapped cells.
    slot = F.when(F.col("qualifier") == qualifiers[0], F.lit(0))
    for at, qualifier in enumerate(qualifiers[1:], 1):
        slot = slot.when(F.col("qualifier") == qualifier, F.lit(at))
    slots = cells.withColumn("slot", F.when(F.col("cf") == cf, slot))
    cell = F.when(F.col("slot").isNotNull(), F.struct("version", "value"))
    reduced = slots.select("rowkey", "slot", cell.alias("cell"))

    def newest(qualifier: str) -> Column:
        at = qualifiers.index(qualifier)
        return F.max(F.when(F.col("slot") == at, F.col("cell")))["value"]

    values = [newest(qualifier).alias(name) for name, qualifier in mapping.items()]
    return reduced.groupBy("rowkey").agg(*values)
