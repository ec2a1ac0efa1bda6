"""Inner products of given pairs of sparse vectors, each vector one row with its features.

A vector travels as two arrays of numbers and is multiplied in numpy in the task of the pair, so
nothing is joined feature by feature.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..storage import stored

#: Pairs of a group, and ids of a family's block, that one task multiplies at once.
GROUP, BLOCK = 1 << 12, 1 << 9
#: Rows of a table of bits, of 64 each.
_WORDS = 1 << 16
#: Numbers that are multiplied at once.
_CHUNK = 1 << 21
_BATCH, _SETTING = 1 << 24, "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, most: int = _BATCH) -> None:
    """Lower the bytes that a task sends to Python at once."""
    if int(spark.conf.get(_SETTING).rstrip("bB")) > most:
        spark.conf.set(_SETTING, str(most))


def trim() -> None:
    """Give back what this worker has freed: it stays for later steps, and others run beside it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def likely(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in ``wanted``, and few others, by a table of bits that every task gets.

    The table has ``_WORDS`` rows at most, so a join of what is left moves only that.
    """
    at = F.pmod(F.xxhash64(key), F.lit(_WORDS * 64))
    word, bit = F.shiftright(at, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    bits = wanted.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    found = rows.withColumn("_word", word).join(F.broadcast(stored(bits, "bits", tidy=True)), "_word")
    return found.filter(F.col("_bits").bitwiseAND(bit) != 0).select(rows.columns)


def listed(vectors: DataFrame) -> DataFrame:
    """``id, features, weights, norm2``: one row for each id of ``id, feature, weight``."""
    entry = F.when(F.col("feature").isNotNull(), F.struct("feature", "weight"))
    rows = (
        vectors.filter(F.col("weight") != 0)
        .groupBy("id")
        .agg(F.collect_list(entry).alias("row"), F.sum(F.col("weight") * F.col("weight")).alias("norm2"))
    )
    return rows.select(
        "id", F.col("row.feature").alias("features"), F.col("row.weight").alias("weights"), "norm2"
    )


def _multiplied(n: int, a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of ``n`` pairs and their common features; a side is row, code and weight
    of its entries."""
    width = int(max(a[1].max(initial=0), b[1].max(initial=0))) + 1
    key_a, key_b = a[0] * width + a[1], b[0] * width + b[1]
    order = np.argsort(key_b, kind="stable")
    key_b, own = key_b[order], b[2][order]
    if not len(key_b):
        return np.zeros(n), np.zeros(n, dtype=np.int64)
    begins = np.flatnonzero(np.concatenate(([True], key_b[1:] != key_b[:-1])))
    key_b, own = key_b[begins], np.add.reduceat(own, begins)
    at = np.minimum(np.searchsorted(key_b, key_a), len(key_b) - 1)
    hit = key_b[at] == key_a
    rows = a[0][hit]
    dots = np.bincount(rows, weights=a[2][hit] * own[at[hit]], minlength=n)
    return dots, np.bincount(rows, minlength=n)


def _entries(features: pa.ListArray, weights: pa.ListArray) -> tuple:
    """The row of each entry, its feature and its weight; a null list has none."""
    sizes = pc.fill_null(pc.list_value_length(features), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(features)), sizes)
    return rows, features.flatten(), weights.flatten().to_numpy(zero_copy_only=False)


def pair_products(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """``id_a, id_b, dot, common, norm2_a, norm2_b`` of ``id_a, id_b``; an id without a list is zero.

    For pairs that have little in common with each other: each brings both its vectors.  File
    ``lists``, so that Spark can split an id that is in very many pairs.
    """
    small_batches(pairs.sparkSession)
    names = ["id", "features", "weights", "norm2"]
    a, b = (lists.select(*(F.col(n).alias(f"{n}_{s}") for n in names)) for s in "ab")
    kept = ["id_a", "id_b", "norm2_a", "norm2_b"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (_entries(batch[f"features_{s}"], batch[f"weights_{s}"]) for s in "ab")
            both = pa.chunked_array([one[1], other[1]]).combine_chunks().dictionary_encode()
            codes = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            cut = len(one[1])
            dots, common = _multiplied(
                batch.num_rows, (one[0], codes[:cut], one[2]), (other[0], codes[cut:], other[2])
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in kept), pa.array(dots), pa.array(common)],
                names=[*kept, "dot", "common"],
            )

    joined = pairs.select("id_a", "id_b").join(a, "id_a", "left").join(b, "id_b", "left")
    own = [joined.schema[name] for name in kept]
    more = [StructField("dot", DoubleType()), StructField("common", LongType())]
    return joined.mapInArrow(work, StructType([*own, *more]))


def tiles(pairs: DataFrame) -> DataFrame:
    """``group, id_a, id_b``: pairs dealt into groups in which few ids have many of the pairs.

    Ids of a family (those with the same smallest partner) are dealt into blocks of some ``BLOCK``
    ids, and the pairs of two blocks are in one group, so the vectors of a family are sent once for
    each pair of its blocks and not for each pair of ids.  A group has some ``GROUP`` pairs, and no
    more than two blocks of one family can have.  File ``pairs``: it is read several times.
    """
    ends = pairs.select(F.col("id_a").alias("id"), F.col("id_a").alias("family"))
    near = stored(
        ends.unionByName(pairs.select(F.col("id_b").alias("id"), F.col("id_a").alias("family")))
        .groupBy("id")
        .agg(F.min("family").alias("family")),
        "near",
    )
    sizes = stored(near.groupBy("family").agg(F.count("*").alias("size")), "families")
    piece = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK))
    blocks = stored(near.join(sizes, "family").select("id", F.xxhash64("family", piece).alias("block")), "blocks")
    groups = -(-max(pairs.count(), 1) // GROUP)
    a, b = (blocks.toDF(f"id_{s}", f"block_{s}") for s in "ab")
    group = F.pmod(F.xxhash64("block_a", "block_b"), F.lit(groups))
    return pairs.join(a, "id_a").join(b, "id_b").select(group.alias("group"), "id_a", "id_b")


def needed(dealt: DataFrame) -> DataFrame:
    """``group, id``: the ids of each group, once."""
    one, other = (dealt.select("group", F.col(f"id_{s}").alias("id")) for s in "ab")
    return one.unionByName(other).distinct()


def family_products(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """``id_a, id_b, dot, common`` of pairs of numbered ids that are found in families.

    ``features`` are whole numbers.  The products are those of ``pair_products``, but a vector is
    sent once to each group of pairs (see ``tiles``).
    """
    dealt = stored(tiles(pairs), "tiles")
    sent = needed(dealt).join(lists.select("id", "features", "weights"), "id").withColumnRenamed("group", "to")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right["id"].to_numpy()
        rows, features, weights = _entries(*(right[n].combine_chunks() for n in ("features", "weights")))
        sizes = np.bincount(rows, minlength=len(ids))
        begins = np.cumsum(sizes) - sizes
        codes = np.unique(features.to_numpy(), return_inverse=True)[1].reshape(-1)
        order = np.argsort(ids)
        a, b = (order[np.searchsorted(ids[order], left[f"id_{s}"].to_numpy())] for s in "ab")

        def side(at: np.ndarray) -> tuple:
            own = np.repeat(np.arange(len(at)), sizes[at])
            first = np.cumsum(sizes[at]) - sizes[at]
            place = np.arange(len(own)) - first[own] + begins[at][own]
            return own, codes[place], weights[place]

        step = np.cumsum(sizes[a] + sizes[b]) // _CHUNK
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1), len(a)]
        dots, common = np.zeros(len(a)), np.zeros(len(a), dtype=np.int64)
        for start, end in zip(cuts, cuts[1:]):
            part = slice(start, end)
            dots[part], common[part] = _multiplied(end - start, side(a[part]), side(b[part]))
        return pa.table(
            {"id_a": left["id_a"], "id_b": left["id_b"], "dot": dots, "common": common}
        )

    out = StructType(
        [pairs.schema["id_a"], pairs.schema["id_b"], StructField("dot", DoubleType()), StructField("common", LongType())]
    )
    return dealt.groupBy("group").cogroup(sent.groupBy("to")).applyInArrow(work, out)
