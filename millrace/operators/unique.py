"""Exact unique users over any range of windows, from one bitmap file a window.

Users get numbers once.  A window's users are bits, 32,768 to a row; the union of windows is
the union of bits, so a range of windows needs no events.  Unions may overlap, which is why two
spans of a power of two windows cover any range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored

#: A task's numbers follow one another; each task begins a range of its own.
_RANGE_BITS = 33


def number_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``user, number`` of every distinct user that ``known`` (such a table) lacks, filed.

    Numbers are given in the tasks, without a common counter: dense within a task, so
    bitmaps stay full.  Those of ``known`` are never given again.  A null user has none.
    """
    new = users.select("user").dropna().distinct()
    first = 0
    if known is not None:
        new = new.join(known.select("user"), "user", "left_anti")
        most = known.agg(F.max("number")).first()[0]
        first = 0 if most is None else ((most >> _RANGE_BITS) + 1) << _RANGE_BITS
    return stored(
        new.withColumn("number", F.monotonically_increasing_id() + F.lit(first + 1)), "numbers"
    )


def window_bitmaps(events: DataFrame, numbers: DataFrame, window: str) -> DataFrame:
    """``window, bucket, bits``: the users of each window.

    ``window`` is a whole number.  Events are brought down to one row a user and
    window in the map tasks before they meet the numbers.
    """
    seen = events.select(F.col(window).cast("bigint").alias("window"), "user").dropna().distinct()
    number = F.col("number")
    return (
        seen.join(numbers, "user")
        .groupBy("window", F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def window_spans(bitmaps: DataFrame, longest: int) -> DataFrame:
    """``level, window, bucket, bits``: the users of ``2 ** level`` windows from ``window`` on.

    For ranges of up to ``longest`` windows.  A level joins the one below with itself by one
    aggregate, and has a span for every window that it reaches.
    """
    levels = [bitmaps.select(F.lit(0).alias("level"), "window", "bucket", "bits")]
    level = 0
    while 2 << level <= longest:
        below = levels[-1]
        moved = below.withColumn("window", F.col("window") - (1 << level))
        level += 1
        both = below.unionByName(moved).groupBy("window", "bucket")
        joined = both.agg(F.bitmap_or_agg("bits").alias("bits"))
        levels.append(stored(joined.select(F.lit(level).alias("level"), "window", "bucket", "bits"), "spans"))
    return reduce(DataFrame.unionByName, levels)


def unique_in_ranges(spans: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each range ``first, last`` (both included) with ``unique_users``; 0 where nobody was.

    Two spans a range are read, whatever its length.  A range must not be longer than the
    spans were made for, and one that is listed again is answered once.
    """
    ranges = ranges.select(
        F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last")
    ).distinct()
    level = F.floor(F.log2(F.col("last") - F.col("first") + 1)).cast("int")
    second = F.col("last") + 1 - F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("level"))
    asked = (
        ranges.withColumn("level", level)
        .withColumn("window", F.explode(F.array_distinct(F.array(F.col("first"), second))))
    )
    found = (
        asked.join(spans, ["level", "window"])
        .groupBy("first", "last", "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
        .groupBy("first", "last")
        .agg(F.sum("n").alias("unique_users"))
    )
    return ranges.join(found, ["first", "last"], "left").withColumn(
        "unique_users", F.coalesce("unique_users", F.lit(0).cast("bigint"))
    )
