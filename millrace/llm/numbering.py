"""Numbers for all rows of a table in a stated order, without one task for all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

#: ``monotonically_increasing_id`` holds the partition above these bits.
_BITS = 33


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with their place in ``order`` as ``name`` (long, from 0), filed.

    The rows are dealt out by ranges of the order, numbered where they then lie,
    and each range adds the rows of the ranges before it: one small row a range.
    Rows that are equal in ``order`` follow one another in any order; their place
    in the table is the last key of the ranges, so a key with very many rows
    is cut as well.  Without rows there is no number.
    """
    tie, at, part = "_numbered_tie", "_numbered_at", "_numbered_part"
    keys = [*order, F.col(tie)]
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys)
    filed = stored(
        dealt.sortWithinPartitions(*keys).drop(tie).withColumn(at, F.monotonically_increasing_id()),
        "numbered",
    )
    ranges = filed.groupBy(F.shiftright(at, _BITS).alias(part)).agg(F.count("*").alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col(at).bitwiseAND(F.lit((1 << _BITS) - 1))
    return (
        filed.withColumn(part, F.shiftright(at, _BITS))
        .join(stored(offsets, "offsets"), part)
        .withColumn(name, F.col("_before") + inside)
        .drop(at, part, "_before")
    )
