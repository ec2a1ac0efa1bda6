"""Exact largest inner products, pruned by lengths and rotated partial sums."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

#: Vectors of a block of candidates and of queries, longest candidate blocks
#: that give the first bounds, rows the rotation is fitted on at most (about),
#: and parts that each range of lengths is dealt into.
BLOCK, QUERIES, SEEDS, SAMPLE, SALTS = 1024, 512, 2, 10_000, 8

_EXACT = float(1 << 53)


class Block(NamedTuple):
    """Vectors in the order of descending length."""

    ids: np.ndarray
    values: np.ndarray  # whole numbers, n x d
    lengths: np.ndarray
    heads: np.ndarray  # first coordinates after the rotation
    tails: np.ndarray  # length of the other coordinates

    @classmethod
    def of(cls, ids: np.ndarray, values: np.ndarray, rotation: np.ndarray) -> Block:
        turned = values.astype("float64") @ rotation
        head = min(turned.shape[1], max(8, turned.shape[1] // 4))
        tails = np.sqrt(np.einsum("ij,ij->i", turned[:, head:], turned[:, head:]))
        lengths = np.sqrt(np.einsum("ij,ij->i", turned, turned))
        return cls(ids, values, lengths, turned[:, :head].copy(), tails)

    def packed(self) -> list[bytes]:
        return [part.tobytes() for part in self]

    @classmethod
    def unpacked(cls, parts: list[bytes]) -> Block:
        ids = np.frombuffer(parts[0], dtype=np.int64)
        n = len(ids)
        kinds = ("int64", "float64", "float64", "float64")
        rest = [np.frombuffer(p, dtype=k) for p, k in zip(parts[1:], kinds, strict=True)]
        return cls(ids, rest[0].reshape(n, -1), rest[1], rest[2].reshape(n, -1), rest[3])


_PARTS = ["ids", "data", "lengths", "heads", "tails"]
_BINARY = ", ".join(f"{name} binary" for name in _PARTS)


def best(queries: Block, block: Block, floors: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Up to ``k`` best rows of a block for each query that reach the query's floor.

    Gives positions of queries, ids and scores.  Rows shorter than any query
    needs are left out first (Cauchy-Schwarz on whole lengths), then pairs whose
    partial sum and lengths of the rest stay below the floor.  Only the others
    get a whole inner product, in whole numbers.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        needed = np.where(queries.lengths > 0, floors / queries.lengths, -np.inf).min()
    m = int(np.searchsorted(-block.lengths, -needed * (1 - 1e-9), side="right"))
    slack = 1e-9 * (queries.lengths.max() * (block.lengths.max() if len(block.ids) else 0) + 1)
    bound = queries.heads @ block.heads[:m].T
    bound += queries.tails[:, None] * block.tails[None, :m]
    open_ = bound >= floors[:, None] - slack
    open_ &= queries.ids[:, None] != block.ids[None, :m]
    q, c = np.nonzero(open_)
    if slack * 1e9 < _EXACT:
        if len(q) * 4 > open_.size:
            whole = queries.values.astype("float64") @ block.values[:m].T.astype("float64")
            scores = whole[q, c].astype(np.int64)
        else:
            scores = np.empty(len(q), dtype=np.int64)
            for begin in range(0, len(q), 65536):
                part = slice(begin, begin + 65536)
                left = queries.values[q[part]].astype("float64")
                scores[part] = np.einsum("ij,ij->i", left, block.values[c[part]].astype("float64"))
    else:  # beyond what doubles hold: Python's whole numbers
        left, right = queries.values.astype(object), block.values.astype(object)
        scores = np.array([int(left[i] @ right[j]) for i, j in zip(q, c, strict=True)], np.int64)
    keep = scores >= floors[q]
    q, ids, scores = q[keep], block.ids[c[keep]], scores[keep]
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.searchsorted(q, q, side="left")
    keep = np.arange(len(q)) - first < k
    return q[keep], ids[keep], scores[keep]


def _blocks(rows: DataFrame, rows_of_one: int, rotation: np.ndarray) -> DataFrame:
    """Rows ``id, v`` packed into blocks of like length, with ``longest`` and ``n``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(rotation)
        for batch in batches:
            for begin in range(0, batch.num_rows, rows_of_one):
                part = batch.slice(begin, rows_of_one)
                lists = part.column(1)
                values = np.zeros((len(lists), width), dtype=np.int64)
                sizes = np.diff(lists.offsets.to_numpy())
                inside = np.arange(width)[None, :] < sizes[:, None]
                values[inside] = lists.flatten().to_numpy()
                block = Block.of(part.column(0).to_numpy().astype(np.int64), values, rotation)
                order = np.lexsort((block.ids, -block.lengths))
                block = Block(*(x[order] for x in block))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.lengths[0]]),
                        pa.array([len(block.ids)], pa.int64()),
                        *(pa.array([x], pa.binary()) for x in block.packed()),
                    ],
                    names=["longest", "n", *_PARTS],
                )

    parts = max(1, -(-rows.count() // (8 * rows_of_one)))
    sorted_rows = rows.repartitionByRange(parts, F.desc("length"), "id").sortWithinPartitions(
        F.desc("length"), "id"
    )
    return sorted_rows.select("id", "v").mapInArrow(
        pack, f"longest double, n bigint, {_BINARY}"
    )


def _band(longest: Column) -> Column:
    """Number of a narrow range of lengths; the longest vectors have the highest."""
    return F.when(longest > 0, F.floor(8 * F.log2(longest))).otherwise(F.lit(-10_000)).cast("int")


def _seeded(queries: DataFrame, seeds: list[Block], k: int) -> DataFrame:
    """Query blocks with ``floors`` (what a row must reach) and ``least``, the length needed."""

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = [batch.column(name)[i].as_py() for name in _PARTS]
                block = Block.unpacked(parts)
                none = np.full(len(block.ids), -np.inf)
                found = [best(block, other, none, k) for other in seeds]
                q = np.concatenate([f[0] for f in found])
                scores = np.concatenate([f[2] for f in found])
                order = np.lexsort((-scores, q))
                q, scores = q[order], scores[order]
                place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
                floors = none.copy()
                floors[q[place == k - 1]] = scores[place == k - 1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    needed = np.where(block.lengths > 0, floors / block.lengths, -np.inf).min()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([max(0.0, float(needed)) * (1 - 1e-9)]),
                        *(pa.array([x], pa.binary()) for x in [*parts, floors.tobytes()]),
                    ],
                    names=["least", *_PARTS, "floors"],
                )

    return queries.select(*_PARTS).mapInArrow(seed, f"least double, {_BINARY}, floors binary")


def _scored(pairs: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score`` of the best rows for each pair of blocks."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name, i=i: batch.column(name)[i].as_py()
                queries = Block.unpacked([get(f"q_{name}") for name in _PARTS])
                block = Block.unpacked([get(name) for name in _PARTS])
                floors = np.frombuffer(get("floors"), dtype="float64")
                q, ids, scores = best(queries, block, floors, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.ids[q]), pa.array(ids), pa.array(scores)],
                    names=["query_id", "vec_id", "score"],
                )

    return pairs.mapInArrow(score, "query_id bigint, vec_id bigint, score bigint")


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """Each component times ``scale``, rounded down; null unless all are finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    floor = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when(vector.isNotNull() & ~F.exists(vector, bad), floor)


def top_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` largest inner products of each query: ``query_id, rank, vec_id, score``.

    Vectors are taken in whole numbers (``whole_numbers``).  Queries are the
    rows for which ``is_query`` holds, candidates all rows but those with the
    query's id.  The result is exact; ties go to the smaller id; a query has
    fewer rows if there are fewer candidates.

    Rows are dealt by length into blocks.  The longest blocks, a fixed number,
    give each query a floor for its k-th score.  A block of queries then meets
    only blocks of candidates long enough to reach a floor of one of its
    queries, and within them only pairs whose rotated partial sum plus the
    lengths of the rest can.  The rotation comes from the singular vectors of
    a bounded sample; a poor one prunes less and changes no result.

    Null vectors, vectors with a null or non-finite component and rows without
    an id take no part; a vector shorter than others counts as ending in zeros.
    Repeated rows are candidates each.  Ids must be whole numbers; a score that
    no 64-bit number holds is an error.  An empty
    table gives no rows.  Other columns are not read.
    """
    numbers = whole_numbers(F.col(vector_column))
    rows = stored(
        vectors.select(
            F.col(id_column).cast("bigint").alias("id"),
            numbers.alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("query"),
        )
        .filter("id IS NOT NULL AND v IS NOT NULL")
        .withColumn(
            "length",
            F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)),
        ),
        "vectors",
    )
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    count, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not count:
        return spark.createDataFrame([], schema)
    width = max(width, 1)
    step = -(-count // SAMPLE)
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).select("v").collect()
    fitted = np.zeros((len(sample), width))
    for i, row in enumerate(sample):
        fitted[i, : len(row["v"])] = row["v"]
    _, turned = np.linalg.eigh(fitted.T @ fitted)
    rotation = np.ascontiguousarray(turned[:, ::-1])

    blocks = stored(
        _blocks(rows, BLOCK, rotation)
        .withColumn("band", _band(F.col("longest")))
        .withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)).cast("int")),
        "blocks",
    )
    heaviest = blocks.orderBy(F.desc("longest")).select(*_PARTS).limit(SEEDS).collect()
    seeds = [Block.unpacked([bytes(row[name]) for name in _PARTS]) for row in heaviest]
    queries = _seeded(_blocks(rows.filter("query"), QUERIES, rotation), seeds, k)
    bands = F.lit(sorted(row["band"] for row in blocks.select("band").distinct().collect()))
    lowest = _band(F.col("least"))
    met = stored(
        queries.select(
            *(F.col(name).alias(f"q_{name}") for name in _PARTS),
            "floors",
            F.explode(F.filter(bands, lambda band: band >= lowest)).alias("band"),
        ).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))),
        "queries",
    )
    pairs = met.join(blocks.select("band", "salt", *_PARTS), ["band", "salt"])
    scored = _scored(pairs.drop("band", "salt"), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
