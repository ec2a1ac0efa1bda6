"""Which listed vectors may be alike: their heads meet in tiles, each the heads of two blocks of ids.

Features are in one order for all ids.  The head of a vector is its first features, as few as can be
with what follows shorter than the threshold: two vectors that share nothing in their heads cannot
reach it.  A head travels as one row to each tile of its block, so what is sent does not
grow with the pairs that meet.  In the tile, those that meet are bounded by what their heads
share, and by what both have left after the end of the shorter one; few pairs leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, ShortType, StructField, StructType

from .given import small_batches, trim

#: Features of the heads in a tile, and of those in all tiles below which there are fewer tiles.
TILE, FEW = 3_000_000, 1 << 16
#: Blocks of ids if there are no more than a tile can hold, so that many tasks have work.
BLOCKS = 8
#: Meetings, features and weights that are handled at once.
_MEETINGS, _ENTRIES, _DENSE = 1 << 18, 1 << 18, 1 << 22
# Bounds are compared with this much room, so that rounding cannot lose a pair.
_SLACK = 1e-9


def _rest(rows: np.ndarray, begin: np.ndarray, squares: np.ndarray, after: np.ndarray) -> np.ndarray:
    """For each entry the sum of its row from there on, and ``after`` of the row."""
    before = np.zeros(len(squares) + 1)
    np.cumsum(squares, out=before[1:])
    rest = (before[begin[1:]] + after)[rows]
    rest -= before[:-1]
    return rest


def rounded_up(sizes: np.ndarray) -> np.ndarray:
    """The next numbers of 16 bits that are not smaller, as the whole numbers with the same bits."""
    short = sizes.astype(np.float16)
    low = short < sizes
    short[low] = np.nextafter(short[low], np.float16(np.inf))
    return short.view(np.int16)


def heads(vectors: DataFrame, threshold: float) -> DataFrame:
    """``id, codes, sizes, after`` of ``id, features, weights, norm2``, features ascending in each row.

    ``sizes`` are the weights' shares of the vector's length (see ``rounded_up``); ``after`` is the
    share of ``norm2`` that follows the head.
    """
    small_batches(vectors.sparkSession)
    codes = StructField("codes", vectors.schema["features"].dataType)
    sizes = StructField("sizes", ArrayType(ShortType()))
    out = StructType([vectors.schema["id"], codes, sizes, StructField("after", DoubleType())])
    schema = to_arrow_schema(out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            rows, begin = np.repeat(np.arange(len(n)), n), np.concatenate(([0], np.cumsum(n)))
            weights = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            size = np.abs(weights) / np.sqrt(batch.column(3).to_numpy(zero_copy_only=False))[rows]
            rest = _rest(rows, begin, size * size, np.zeros(len(n)))
            kept = rest >= threshold**2 - _SLACK
            length = np.bincount(rows[kept], minlength=len(n))
            offsets = pa.array(np.concatenate(([0], np.cumsum(length))), pa.int32())
            after = np.append(rest, 0.0)[begin[:-1] + length]
            columns = [
                batch.column(0),
                pa.ListArray.from_arrays(offsets, batch.column(1).flatten().filter(pa.array(kept))),
                pa.ListArray.from_arrays(offsets, pa.array(rounded_up(size[kept]))),
                pa.array(np.where(length < n, np.maximum(after, 0.0), 0.0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return vectors.select("id", "features", "weights", "norm2").mapInArrow(work, out)


class _Side(NamedTuple):
    """Heads of some ids, long ones first: ``places``, ``begin``, ``after`` by row, the others by entry."""

    places: np.ndarray
    begin: np.ndarray
    after: np.ndarray
    rows: np.ndarray
    codes: np.ndarray
    sizes: np.ndarray
    rest: np.ndarray

    def only(self, common: np.ndarray) -> _Side:
        """The entries of the codes that are marked, by their numbers among these."""
        kept = np.flatnonzero(common[self.codes])
        number = np.cumsum(common, dtype=np.int32) - 1
        rows = self.rows[kept]
        begin = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(self.places)))))
        codes = number[self.codes[kept]]
        return self._replace(begin=begin, rows=rows, codes=codes, sizes=self.sizes[kept], rest=self.rest[kept])


class _Rest:
    """What follows a code in the heads of a side and after them, as a share of ``norm2``."""

    def __init__(self, side: _Side, width: int):
        self.width, self.begin, self.last = width, side.begin, side.codes[side.begin[1:] - 1]
        self.ends, self.rest = side.after, side.rest
        self.keys = side.rows * np.int64(width) + side.codes

    def after(self, rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
        found = self.ends[rows]
        inside = np.flatnonzero(self.last[rows] > codes)
        at = np.searchsorted(self.keys, rows[inside] * self.width + codes[inside], side="right")
        found[inside] = self.rest[at]
        return found


def _sides(table: pa.Table, blocks: list[int]) -> tuple[list[_Side], int]:
    """The heads of each block, and the number of different features."""
    lists = table["codes"].combine_chunks()
    n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.concatenate(([0], np.cumsum(n)))
    codes = lists.flatten().to_numpy(zero_copy_only=False)
    different = np.sort(codes)
    different = different[np.concatenate(([True], different[1:] != different[:-1]))[: len(different)]]
    number = np.empty(len(codes), dtype=np.int32)
    for start in range(0, len(codes), _ENTRIES):
        number[start : start + _ENTRIES] = np.searchsorted(different, codes[start : start + _ENTRIES])
    codes, width = number, max(len(different), 1)
    del lists, different, number
    sizes = table["sizes"].combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.float16)
    block, places, after = (table[name].to_numpy() for name in ("block", "place", "after"))
    sides = []
    for one in blocks:
        own = np.flatnonzero((block == one) & (n > 0))
        own = own[np.argsort(-n[own], kind="stable")]
        own_begin = np.concatenate(([0], np.cumsum(n[own])))
        rows = np.repeat(np.arange(len(own), dtype=np.int32), n[own])
        at = np.arange(own_begin[-1]) + np.repeat(begin[own] - own_begin[:-1], n[own])
        size, code = sizes[at].astype(np.float32), codes[at]
        del at
        # The squares of numbers of 16 bits are exact here.
        rest = _rest(rows, own_begin, size * size, after[own])
        rest *= 1 + 1e-6
        sides.append(_Side(places[own], own_begin, after[own], rows, code, size, rest.astype(np.float32)))
    return sides, width


def _pairs(sides: list[_Side], width: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the first and last of ``sides`` that may reach the threshold, each pair once; ``sides`` is used up."""
    counts = [np.bincount(side.codes, minlength=width) for side in sides]
    common = counts[0] > 1 if len(sides) == 1 else (counts[0] > 0) & (counts[1] > 0)
    if not common.any():
        return
    rests = [_Rest(side, width) for side in sides]
    width = int(common.sum())
    sides[:] = [side.only(common) for side in sides]
    del counts, common
    if len(sides) == 1:
        yield from _bounded(*sides, *sides, *rests, *rests, width, threshold, True, True)
        return
    (a, b), (rest_a, rest_b) = sides, rests
    yield from _bounded(a, b, rest_a, rest_b, width, threshold, False, False)
    for y, x in _bounded(b, a, rest_b, rest_a, width, threshold, False, True):
        yield x, y


def _bounded(
    a: _Side, b: _Side, rest_a: _Rest, rest_b: _Rest, width: int, threshold: float, same: bool, ties: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Those pairs where ``b`` has the shorter head or, with ``ties``, one as long; of one side, each pair once."""
    # A feature's entries in b by falling rest: those that an entry of a meets come first.
    order = np.lexsort((-b.rest, b.codes))
    owner, key = b.rows[order], 2.0 * b.codes[order] + (1.5 - b.rest[order])
    del order
    first = np.concatenate(([0], np.cumsum(np.bincount(b.codes, minlength=width))))[a.codes]
    most = 2.0 * a.codes
    most += 1.5 + 1e-7
    most -= (threshold**2 - _SLACK) / a.rest.astype(np.float64)
    count = np.searchsorted(key, most, side="right")
    count -= first
    np.maximum(count, 0, out=count)
    del key, most
    lengths = np.diff(b.begin)
    # Rows of a by falling length of their heads: where a row of b comes in this order.
    place = np.arange(len(lengths)) if same else np.searchsorted(
        -np.diff(rest_a.begin), -np.diff(rest_b.begin), side="right" if ties else "left"
    )
    group = max(_DENSE // width, 1)
    dense = np.zeros(group * width, dtype=np.float32)
    met = np.concatenate(([0], np.cumsum(np.bincount(a.rows, weights=count, minlength=len(a.places)))))
    row = 0
    while row < len(a.places):
        end = max(int(np.searchsorted(met, met[row] + _MEETINGS, side="right")) - 1, row + 1)
        part = slice(a.begin[row], a.begin[end])
        n = count[part]
        own = np.repeat(a.rows[part], n).astype(np.int64)
        at = np.arange(len(own)) + np.repeat(first[part] - (np.cumsum(n) - n), n)
        other = owner[at]
        pair = np.unique(((own - row) * len(b.places) + other)[place[other] > own])
        left, right = row + pair // len(b.places), pair % len(b.places)
        row = end
        cost = np.concatenate(([0], np.cumsum(lengths[right])))
        start = 0
        while start < len(pair):
            stop = int(np.searchsorted(cost, cost[start] + _ENTRIES, side="right")) - 1
            stop = min(max(stop, start + 1), int(np.searchsorted(left, left[start] + group)))
            x, y = left[start:stop], right[start:stop]
            start, low = stop, x[0]
            part = slice(a.begin[low], a.begin[x[-1] + 1])
            filled = (a.rows[part] - low) * width + a.codes[part]
            dense[filled] = a.sizes[part]
            n = lengths[y]
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(b.begin[y] - (ends - n), n)
            shared = dense[np.repeat((x - low) * width, n) + b.codes[at]] * b.sizes[at].astype(np.float64)
            dense[filled] = 0
            dot = np.add.reduceat(shared, ends - n)
            # Whatever else they share follows the end of the shorter head in both.
            cut = np.minimum(rest_a.last[x], rest_b.last[y])
            may = dot + np.sqrt(rest_a.after(x, cut) * rest_b.after(y, cut)) >= threshold - _SLACK
            yield x[may], y[may]


def met_in_tiles(listed: DataFrame, threshold: float) -> DataFrame:
    """``id_a, id_b`` of ``place, codes, sizes, after``: the pairs of places that may reach the threshold.

    Each pair once, and few others.  File ``listed``: it is read twice.
    """
    small_batches(listed.sparkSession)
    total = listed.agg(F.sum(F.size("codes"))).first()[0] or 0
    blocks = max(-(-2 * total // TILE), min(BLOCKS, -(-total // FEW)), 1)
    block = F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int")
    tile = F.transform(
        F.sequence(F.lit(0), F.lit(blocks - 1)),
        lambda other: F.least("block", other) * blocks + F.greatest("block", other),
    )
    dealt = listed.withColumn("block", block).withColumn("tile", F.explode(tile))
    kind = listed.schema["place"].dataType
    out = StructType([StructField("id_a", kind), StructField("id_b", kind)])
    schema = to_arrow_schema(out)

    def work(table: pa.Table) -> pa.Table:
        trim()
        one, other = divmod(table["tile"][0].as_py(), blocks)
        sides, width = _sides(table, sorted({one, other}))
        places = sides[0].places, sides[-1].places
        found = []
        for x, y in _pairs(sides, width, threshold):
            x, y = places[0][x], places[1][y]
            columns = [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))]
            found.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        return pa.Table.from_batches(found, schema=schema)

    return dealt.groupBy("tile").applyInArrow(work, out)
