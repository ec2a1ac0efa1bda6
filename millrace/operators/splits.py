"""Train/test splits that come out the same every time."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored
from .positions import limits_of, values_at

BASE, TEST = "base", "test"


def fold_starts(rows: DataFrame, key: str, folds: int) -> list[int | None]:
    """The key at which each of ``folds`` equal blocks in key order begins.

    A row at position ``p`` of ``n`` belongs to block ``p * folds div n``.  A
    start is None for blocks that get no rows.
    """
    limits = limits_of(rows, key)
    first = [-(-fold * limits.count // folds) for fold in range(folds)]
    at = values_at(rows, key, first, limits)
    return [at.get(position) for position in first]


def contiguous_folds(rows: DataFrame, key: str, folds: int = 5) -> DataFrame:
    """Add ``fold``: equal blocks of consecutive rows in the order of ``key``.

    ``key`` is a unique whole number.  Only the block limits are looked up; the
    rows are labelled where they are, without a shuffle or a sort.
    """
    starts = [start for start in fold_starts(rows, key, folds)[1:] if start is not None]
    passed = [(F.col(key) >= start).cast("int") for start in starts]
    return rows.withColumn("fold", reduce(add, passed, F.lit(0)))


def fold_slices(rows: DataFrame, key: str, folds: int) -> list[DataFrame]:
    """The blocks of ``contiguous_folds`` one by one, as key ranges a scan can skip on."""
    starts = [start for start in fold_starts(rows, key, folds) if start is not None]
    slices = []
    for start, end in zip(starts, [*starts[1:], None]):
        block = rows.filter(F.col(key) >= start)
        slices.append(block if end is None else block.filter(F.col(key) < end))
    return slices


def fold_pair(
    rows: DataFrame, key: str, fold: int, folds: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Base and test rows of one fold, as key ranges a scan can skip on."""
    starts = fold_starts(rows, key, folds)
    start, end = starts[fold], next((s for s in starts[fold + 1 :] if s is not None), None)
    if start is None:
        return rows, rows.filter(F.lit(False))
    before, after = F.col(key) < start, F.col(key) >= start
    if end is not None:
        before, after = before | (F.col(key) >= end), after & (F.col(key) < end)
    return rows.filter(before), rows.filter(after)


def fold_roles(folded: DataFrame, folds: int = 5) -> DataFrame:
    """Every row once for each fold: ``test`` in its own, ``base`` in the others.

    The result is ``folds`` times the input, the same as writing one pair of
    outputs for each fold; ``fold`` becomes the pair the row is in.
    """
    own = F.col("fold")
    paired = folded.withColumn("pair", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    return (
        paired.withColumn("role", F.when(F.col("pair") == own, TEST).otherwise(BASE))
        .drop("fold")
        .withColumnRenamed("pair", "fold")
    )


def user_holdout(
    rows: DataFrame,
    start: int,
    stop: int,
    max_test: int = 0,
    user: str = "user_id",
    key: str = "pos",
) -> DataFrame:
    """Add ``role``: ``test`` for ratings ``start`` to ``stop`` of each user, else ``base``.

    Ratings of a user are counted from 1 in the order of ``key``, a unique whole
    number.  With a positive ``max_test`` only that many of the chosen ratings,
    the first in the order of ``key`` over all users, are test rows.

    Only the first ``stop`` ratings of a user take part in the ranking.  Spark
    drops the rest in the map tasks (``WindowGroupLimit``), so a user with a
    third of all rows costs no more than another.  What comes back to the rows
    is one key range for each user, filed first, so that the join can split
    the rows of such a user.
    """
    chosen = ranked_between(rows, start, stop, user, key)
    last = _last_test_key(chosen, key, max_test) if max_test > 0 else None
    ranges = stored(
        chosen.groupBy(user).agg(F.min(key).alias("_from"), F.max(key).alias("_to")), "ranges"
    )
    is_test = F.col(key).between(F.col("_from"), F.col("_to"))
    if last is not None:
        is_test = is_test & (F.col(key) <= last)
    return (
        rows.join(ranges, user, "left")
        .withColumn("role", F.when(is_test, TEST).otherwise(BASE))
        .drop("_from", "_to")
    )


def ranked_between(rows: DataFrame, start: int, stop: int, user: str, key: str) -> DataFrame:
    """``user, key, rank`` of the ratings ``start`` to ``stop`` of each user."""
    rank = F.row_number().over(Window.partitionBy(user).orderBy(key))
    return (
        rows.select(user, key)
        .withColumn("rank", rank)
        .filter(F.col("rank") <= stop)
        .filter(F.col("rank") >= start)
    )


def _last_test_key(chosen: DataFrame, key: str, max_test: int) -> int | None:
    """The key of the last row within the cap, or None when all rows are."""
    chosen = chosen.select(key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return values_at(chosen, key, [max_test - 1]).get(max_test - 1)
    finally:
        chosen.unpersist()


def split_by_date(rows: DataFrame, time: str, cutoff: str) -> DataFrame:
    """Add ``split``: ``train`` before the cutoff, ``test`` from it on."""
    before = F.col(time) < F.lit(cutoff).cast("timestamp_ntz")
    return rows.withColumn("split", F.when(before, "train").otherwise("test"))


def write_pairs(rows: DataFrame, path: str, order: tuple[str, ...] = ("user_id", "item_id")) -> None:
    """Write base and test rows as ``fold=/role=`` folders, each sorted by ``order``.

    One sort over all folders: Spark cuts the sort ranges from a sample of the
    rows, so a large folder or a busy user spreads over many files.  A split
    without folds is written under ``role=`` only.
    """
    folders = [name for name in ("fold", "role") if name in rows.columns]
    rows.orderBy(*folders, *order).write.mode("overwrite").partitionBy(*folders).parquet(path)
