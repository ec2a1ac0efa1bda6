"""Field access and number parsing for delimited text lines.

All of these give null instead of raising, so that a bad line can be kept and
explained rather than failing a whole job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with a meaning of their own in a pattern.
_SPECIAL = ".$|()[{^?*+\\"


def fields(line: Column, separator: str) -> Column:
    """Split a line on a literal character; empty trailing fields are kept.

    One character, escaped or not, is split on without a regular expression.
    """
    if len(separator) != 1:
        raise ValueError(f"separator must be one character, not {separator!r}")
    pattern = f"\\{separator}" if separator in _SPECIAL else separator
    return F.split(line, pattern, -1)


def field(parts: Column, index: int) -> Column:
    """The field at ``index``, or null when the line has fewer fields."""
    return F.get(parts, F.lit(index))


def number(text: Column) -> Column:
    """Text as a double, or null when it is not a finite number."""
    value = text.try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def numbers(text: Column, separator: str) -> Column:
    """A delimited list of numbers; an element that is not a number is null."""
    return F.transform(fields(text, separator), number)


def first_word(line: Column) -> Column:
    """The first whitespace-delimited field of a line, or null."""
    return F.nullif(F.regexp_extract(line, r"^\s*(\S+)", 1), F.lit(""))
