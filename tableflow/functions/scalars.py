"""Parsing, time, suffix-lookup and byte helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The time format, and the result for text that is no whole number.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
NOT_A_LONG = -99


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_long(text: Column | str) -> Column:
    """Text as a long, or -99 when it is not exactly an optional sign and digits in range."""
    text = _col(text)
    number = F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("bigint"))
    return F.coalesce(number, F.lit(NOT_A_LONG).cast("bigint"))


def diff_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds from start to end, both ``yyyy-MM-dd HH:mm:ss`` text in the session time zone."""
    return F.unix_timestamp(_col(end), TIME_FORMAT) - F.unix_timestamp(_col(start), TIME_FORMAT)


def now_text() -> Column:
    """The current time as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(F.current_timestamp(), TIME_FORMAT)


def suffix_values(
    pairs: Column | str, suffixes: Sequence[str], name: str = "name", value: str = "value"
) -> Column:
    """For each suffix, the value of the last pair whose name ends with it, else null.

    ``pairs`` is an array of structs with the two named fields; the result is an array in the
    order of ``suffixes``.
    """
    pairs = _col(pairs)

    def last_match(suffix: str) -> Column:
        matches = F.filter(pairs, lambda pair: pair[name].endswith(suffix))
        return F.try_element_at(matches, F.lit(-1))[value]

    return F.array(*[last_match(suffix) for suffix in suffixes])


def text_bytes(text: Column | str) -> Column:
    """Text as UTF-8 bytes; null gives no bytes rather than null."""
    return F.coalesce(F.encode(_col(text), "UTF-8"), F.lit(b""))


def cell_text(data: Column | str) -> Column:
    """Bytes of a qualifier or value as text; malformed sequences become U+FFFD."""
    return F.make_valid_utf8(_col(data).cast("string"))
