"""Expressions over delimited text lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = "".join(map(chr, range(33)))


def fields(line: Column, separator: str) -> Column:
    """The line's fields; separators at the very end open no further field."""
    return F.split(F.rtrim(line, F.lit(separator)), f"\\Q{separator}\\E")


def field(parts: Column, index: int) -> Column:
    """One field, NULL when the line is too short."""
    return F.get(parts, index)


def strip(text: Column) -> Column:
    """Drop blanks and control characters at both ends."""
    return F.btrim(text, F.lit(_BLANKS))


def whole_number(text: Column, kind: str = "bigint") -> Column:
    """A plain decimal integer; NULL for padding, fractions or overflow."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast(kind))
