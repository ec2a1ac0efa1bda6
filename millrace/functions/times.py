"""Conversions between wall-clock times and instants.

The tables hold times without a zone.  Watermarks need instants, and Spark's
plain casts between the two use the session time zone, so a result could move
when that setting changes.  These conversions read wall-clock times as UTC
whatever the session says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

#: Pattern for times in reports; fixed, so that it does not follow the locale.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def wall_to_instant(column: str) -> Column:
    """A ``timestamp_ntz`` column as a ``timestamp``, read as UTC."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {_EPOCH}, {column}))")


def instant_to_wall(column: str) -> Column:
    """A ``timestamp`` column as the UTC wall-clock time without a zone."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({column}), {_EPOCH})")


def label(wall_time: Column) -> Column:
    """A wall-clock time as report text."""
    return F.date_format(wall_time, TIME_PATTERN)
