"""Exact order statistics of a column, without sorting the table."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BUCKETS = 1 << 14


class Limits(NamedTuple):
    """The smallest and largest key, and how many there are."""

    low: int | None
    high: int | None
    count: int


def limits_of(rows: DataFrame, key: str) -> Limits:
    keys = rows.select(F.col(key).cast("bigint").alias("key"))
    return Limits(*keys.agg(F.min("key"), F.max("key"), F.count("key")).first())


def values_at(
    rows: DataFrame, key: str, positions: Iterable[int], limits: Limits | None = None
) -> dict[int, int]:
    """The value of an integer column at given 0-based sorted positions.

    Counts the rows in equal slices of the key range and narrows each position
    to its slice until a slice is one value wide.  A pass reads only ``key``,
    combines in the map tasks and brings at most ``_BUCKETS`` counts for a
    position to the driver.  Keys that spread over ``r`` values take
    ``log(r, 16384)`` passes whatever the number of rows.  Positions past the
    end have no entry.
    """
    keys = rows.select(F.col(key).cast("bigint").alias("key")).dropna()
    low, high, count = limits or limits_of(rows, key)
    found: dict[int, int] = {}
    # position -> (low, high, rows below low)
    open_ranges = {p: (low, high, 0) for p in set(positions) if 0 <= p < count}
    while open_ranges:
        for position, (lo, hi, _) in list(open_ranges.items()):
            if lo == hi:
                found[position] = lo
                del open_ranges[position]
        slices = sorted({(lo, hi) for lo, hi, _ in open_ranges.values()})
        if not slices:
            break
        counts = _slice_counts(keys, slices)
        for position, (lo, hi, below) in open_ranges.items():
            width = _width(lo, hi)
            for bucket, n in counts[lo, hi]:
                if position < below + n:
                    start = lo + bucket * width
                    open_ranges[position] = (start, min(start + width - 1, hi), below)
                    break
                below += n
    return found


def _width(low: int, high: int) -> int:
    return (high - low) // _BUCKETS + 1


def _slice_counts(
    keys: DataFrame, slices: list[tuple[int, int]]
) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Rows in each bucket of each key range, in one pass."""
    where = F.lit(None)
    near = F.lit(False)
    for index, (low, high) in enumerate(slices):
        inside = F.col("key").between(low, high)
        bucket = F.expr(f"(key - {low}L) div {_width(low, high)}L")
        where = F.when(inside, F.struct(F.lit(index).alias("i"), bucket.alias("b"))).otherwise(where)
        near = near | inside
    counted = keys.filter(near).groupBy(where.alias("slice")).count().collect()
    result = {limits: [] for limits in slices}
    for (index, bucket), n in counted:
        result[slices[index]].append((bucket, n))
    return {limits: sorted(buckets) for limits, buckets in result.items()}
