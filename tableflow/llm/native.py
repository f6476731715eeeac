"""Column expressions that several native operators use."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: all but words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a text whose A-Z are lower-cased
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed. ``lower`` does just that where all is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def plain_words(text: Column) -> Column:
    """The words, in order; a null text has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")
