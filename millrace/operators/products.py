"""The best items of each user by the product of their factors, without all products.

Items are taken by falling length.  No item can score more than both lengths multiplied, so
a user is done once the next items' length times its own is below its n-th score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot, matrix
from ..storage import stored

#: Numbers of one block of items at most, 32 MB; the block travels with the function.
BLOCK_NUMBERS = 1 << 22
#: Items of the first block; each further one has four times as many.
FIRST = 1 << 12
#: Users and items multiplied at a time.
_USERS, _ITEMS = 256, 1 << 10
# Lengths are compared with this much room, so that rounding cannot lose an item.
_ROOM = 1 + 1e-9
# Quick products are off by less than this share of both lengths multiplied.
_OFF = 1e-12

_BEST = "best array<struct<score:double,item_id:bigint>>"


def _with_norm(rows: DataFrame, id: str) -> DataFrame:
    factors = F.col("factors").cast("array<double>")
    return (
        rows.select(F.col(id).cast("bigint").alias(id), factors.alias("factors"))
        .withColumn("norm", F.sqrt(dot(F.col("factors"), F.col("factors"))))
    )


def _merged(
    scores: np.ndarray, ids: np.ndarray, new: np.ndarray, new_ids: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` best of each row out of two sets, ties to the smaller id."""
    both = np.hstack([scores, new])
    named = np.hstack([ids, np.broadcast_to(new_ids, new.shape)])
    if both.shape[1] > 8 * n:
        # Only what reaches the n-th score of its row; ties with it all stay.
        least = -np.partition(-both, n - 1, axis=1)[:, n - 1 : n]
        some = (both >= least).sum(axis=1).max()
        top = np.argpartition(-both, some - 1, axis=1)[:, :some] if some < both.shape[1] else None
        if top is not None:
            both, named = np.take_along_axis(both, top, 1), np.take_along_axis(named, top, 1)
    order = np.lexsort((named, -both), axis=-1)[:, :n]
    return np.take_along_axis(both, order, 1), np.take_along_axis(named, order, 1)


def _scored(
    users: np.ndarray, lengths: np.ndarray, scores: np.ndarray, ids: np.ndarray, block: tuple
) -> np.ndarray:
    """Take a block's items into the lists ``scores, ids`` in place; gives the items met by each."""
    item_ids, factors, norms = block
    met = np.zeros(len(users), dtype=np.int64)
    for begin in range(0, len(item_ids), _ITEMS):
        open_ = np.flatnonzero(lengths * norms[begin] * _ROOM >= scores[:, -1])
        if not len(open_):
            break
        end = begin + _ITEMS
        quick = users[open_] @ factors[begin:end].T
        met[open_] += quick.shape[1]
        may = scores[open_, -1] - _OFF * lengths[open_] * norms[begin]
        reached = quick >= may[:, None]
        near = np.flatnonzero(reached.any(axis=0))
        if not len(near):
            continue
        raised = reached.any(axis=1)
        own = open_[raised]
        # Products in a fixed order, whatever the number of users and items.
        new = np.einsum("ij,kj->ik", users[own], factors[begin:end][near])
        scores[own], ids[own] = _merged(
            scores[own], ids[own], new, item_ids[begin:end][near], scores.shape[1]
        )
    return met


def _round(users: DataFrame, block: tuple, next_norm: float, n: int) -> DataFrame:
    """Users after one block: their lists, the items met, and whether they go on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, _USERS):
                part = batch.slice(begin, _USERS)
                m = part.num_rows
                factors = matrix(part["factors"], block[1].shape[1])
                lengths = part["norm"].to_numpy()
                lists = part["best"]
                sizes = np.diff(lists.offsets.to_numpy())
                own = np.arange(n) < sizes[:, None]
                scores, ids = np.full((m, n), -np.inf), np.full((m, n), np.iinfo(np.int64).max)
                flat = lists.flatten()
                scores[own] = flat.field("score").to_numpy()
                ids[own] = flat.field("item_id").to_numpy()
                met = _scored(factors, lengths, scores, ids, block)
                full = np.isfinite(scores)
                ends = np.concatenate(([0], np.cumsum(full.sum(axis=1)))).astype(np.int32)
                best = pa.StructArray.from_arrays(
                    [pa.array(scores[full]), pa.array(ids[full])], ["score", "item_id"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part["user_id"],
                        part["factors"],
                        part["norm"],
                        pa.ListArray.from_arrays(pa.array(ends), best),
                        pa.array(part["scored"].to_numpy() + met),
                        pa.array(lengths * next_norm * _ROOM >= scores[:, -1]),
                    ],
                    names=["user_id", "factors", "norm", "best", "scored", "open"],
                )

    schema = f"user_id bigint, factors array<double>, norm double, {_BEST}, scored bigint, open boolean"
    return stored(users.mapInArrow(work, schema), "best")


def _blocks(items: DataFrame) -> Iterator[tuple[tuple, float]]:
    """Blocks of items by falling length, and the length that follows each (-1 after the last)."""
    size, rest = FIRST, items
    while True:
        found = rest.orderBy(F.desc("norm"), "item_id").limit(size + 1).toArrow().combine_chunks()
        if not len(found):
            return
        factors = found["factors"].combine_chunks()
        width = len(factors[0])
        norms, ids = found["norm"].to_numpy(), found["item_id"].to_numpy()
        block = ids[:size], matrix(factors, width)[:size], norms[:size]
        if len(found) <= size:
            yield block, -1.0
            return
        yield block, float(norms[size])
        length, last = float(norms[size - 1]), int(ids[size - 1])
        shorter = (F.col("norm") == length) & (F.col("item_id") > last)
        rest = items.filter((F.col("norm") < length) | shorter)
        size = min(4 * size, max(FIRST, BLOCK_NUMBERS // max(width, 1)))


def top_products(users: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """The ``n`` best items of each user, exactly: ``user_id, place, item_id, score, scored``.

    ``users`` has ``user_id, factors`` and ``items`` has ``item_id, factors``, one row an id, all
    factors of one length without nulls.  Ties go to the smaller id; with fewer
    items all are listed.  ``scored`` says with how many items the user was compared.

    Items come in blocks by falling length, ``BLOCK_NUMBERS`` numbers of them at a time
    through the driver.  Users stay where they are: a block is a map-only step, and only users
    whose bound reaches their n-th score go on to the next one.  The first blocks hold
    the long items, so most users are done early unless all items are about as long.
    """
    items = stored(_with_norm(items, "item_id"), "items")
    rest = _with_norm(users, "user_id").selectExpr(
        "*", f"cast(array() AS {_BEST.partition(' ')[2]}) AS best", "0L AS scored"
    )
    done = []
    for block, next_norm in _blocks(items):
        after = _round(rest, block, next_norm, n)
        if next_norm < 0:
            done.append(after)
            break
        done.append(after.filter(~F.col("open")))
        rest = after.filter("open").drop("open")
        if not rest.limit(1).count():
            break
    if not done:
        done = [rest]
    listed = reduce(DataFrame.unionByName, (part.select("user_id", "best", "scored") for part in done))
    return listed.select("user_id", "scored", F.posexplode("best").alias("place", "item")).select(
        "user_id",
        (F.col("place") + 1).alias("place"),
        F.col("item.item_id").alias("item_id"),
        F.col("item.score").alias("score"),
        "scored",
    )
