"""Column functions; every one is a built-in Spark expression."""

from tableflow.functions.codec import decode_value, encode_value
from tableflow.functions.scalars import (
    cell_text,
    diff_seconds,
    now_text,
    parse_long,
    suffix_values,
    text_bytes,
)

__all__ = [
    "cell_text",
    "decode_value",
    "diff_seconds",
    "encode_value",
    "now_text",
    "parse_long",
    "suffix_values",
    "text_bytes",
]
