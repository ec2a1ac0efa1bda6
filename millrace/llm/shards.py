"""Shards by a permutation of the row numbers that anyone can compute.

A row's place in the shuffled table is a Feistel permutation of its number in
the order of the ids.  Place, shard and slot follow from the number, the count of
rows and a seed, and the number follows from shard and slot, without a table.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .numbering import numbered

#: Half rounds of the permutation; each moves one half by a hash of the other.
ROUNDS = 8
#: Values of a half stay below 2^31, so that products fit a long in any SQL.
MASK = (1 << 31) - 1
#: Odd factors below 2^31 for mixing a half with its key.
FACTORS = (1597334677, 747796405)


def halves(n: int) -> tuple[int, int]:
    """The sizes of both halves: their product is the least above ``n`` of this shape.

    Less than one in sqrt(n) places lie outside, and they are fewer than the first size.
    """
    wide = isqrt(max(n, 1) - 1) + 1
    return wide, -(-max(n, 1) // wide)


def keys(seed: int) -> list[int]:
    """One key for each half round."""
    return [(seed * 1000003 + k * 1664525 + 1013904223) * 22695477 % (1 << 31) for k in range(ROUNDS)]


def _spread(value: Column, key: Column) -> Column:
    """31 bits that depend on all bits of the value and the key."""
    for factor in FACTORS:
        value = value * F.lit(factor) + key
        value = value.bitwiseXOR(F.shiftright(value, 29)).bitwiseAND(F.lit(MASK))
    return value.bitwiseXOR(F.shiftright(value, 15))


def _half_rounds(value: Column, n: int, seed: int, back: bool) -> Column:
    """One pass through all half rounds, on places of both halves' product."""
    wide, high = (F.lit(size).cast("long") for size in halves(n))
    steps = list(enumerate(keys(seed)))
    listed = F.array(
        *(
            F.struct(F.lit(k % 2 == 0).alias("first"), F.lit(key).cast("long").alias("key"))
            for k, key in (reversed(steps) if back else steps)
        )
    )
    sign = F.lit(-1 if back else 1)

    def moved(state: Column, step: Column) -> Column:
        x, y = state["x"], state["y"]
        return F.struct(
            F.when(step["first"], F.pmod(x + sign * _spread(y, step["key"]), wide))
            .otherwise(x)
            .alias("x"),
            F.when(step["first"], y)
            .otherwise(F.pmod(y + sign * _spread(x, step["key"]), high))
            .alias("y"),
        )

    start = F.struct(
        F.pmod(value, wide).alias("x"), F.call_function("div", value, wide).alias("y")
    )
    return F.aggregate(listed, start, moved, lambda state: state["y"] * wide + state["x"])


def _walked(value: Column, n: int, seed: int, back: bool) -> Column:
    wide, high = halves(n)
    outside = wide * high - n
    first = _half_rounds(value, n, seed, back)
    if not outside:
        return first

    def again(place: Column, _: Column) -> Column:
        return F.when(place < n, place).otherwise(_half_rounds(place, n, seed, back))

    # A cycle meets every outside place once at most, so this many steps suffice.
    steps = F.sequence(F.lit(1), F.lit(outside))
    walked = F.transform(
        F.array(first),
        lambda place: F.when(place < n, place).otherwise(F.aggregate(steps, place, again)),
    )
    return walked[0]


def place(number: Column, n: int, seed: int = 1) -> Column:
    """Where the row with this number stands after the shuffle: 0 to ``n - 1``, each once."""
    return _walked(number.cast("long"), n, seed, back=False)


def number_at(where: Column, n: int, seed: int = 1) -> Column:
    """The row number that ``place`` brings here."""
    return _walked(where.cast("long"), n, seed, back=True)


def shard_and_slot(number: Column, n: int, shards: int, seed: int = 1) -> Column:
    """``shard int`` and ``slot long`` of a row number, as a struct.

    Shards take turns along the shuffled rows: counts differ by one at most, and
    the slots of a shard are 0, 1, 2 and so on without a gap.
    """
    return F.transform(
        F.array(place(number, n, seed)),
        lambda at: F.struct(
            (at % shards).cast("int").alias("shard"),
            F.call_function("div", at, F.lit(shards)).alias("slot"),
        ),
    )[0]


def number_of(shard: Column, slot: Column, n: int, shards: int, seed: int = 1) -> Column:
    """The row number that stands in a slot of a shard."""
    return number_at(slot.cast("long") * shards + shard, n, seed)


def sharded(
    documents: DataFrame,
    shards: int = 24,
    seed: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row with ``row_number long, shard int, slot long, size long, text_crc32 long``.

    ``size`` is the UTF-8 bytes of the text plus 8, a null text having none;
    ``text_crc32`` is the unsigned CRC of these bytes, 0 for none.  Numbers go by
    id (null last), size and CRC, so they do not depend on files or tasks.  Rows
    equal in all three, repeated rows among them, take their numbers in any order.

    The law is on rows: counts of two shards differ by one at most.  Copies of a
    text are rows of their own and fall where their numbers fall.

    ``carry`` names the columns that stay, by default all; columns under the
    names of the new ones are replaced.  No rows give no rows.
    """
    new = ["size", "text_crc32", "row_number", "shard", "slot"]
    wanted = documents.columns if carry is None else carry
    kept = [name for name in wanted if name not in new or name in (id_column, text_column)]
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = documents.select(
        F.col(id_column).alias("_shard_id"),
        *(F.col(name).alias(f"_kept_{k}") for k, name in enumerate(kept)),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = [F.col("_shard_id").asc_nulls_last(), F.col("size"), F.col("text_crc32")]
    # Filed, since dealing out by ranges looks at the rows twice.
    placed = numbered(stored(rows, "sized"), order, "row_number")
    n = placed.count()
    return placed.withColumn("_at", shard_and_slot(F.col("row_number"), n, shards, seed)).select(
        *(F.col(f"_kept_{k}").alias(name) for k, name in enumerate(kept) if name not in new),
        "size",
        "text_crc32",
        "row_number",
        F.col("_at.shard").alias("shard"),
        F.col("_at.slot").alias("slot"),
    )


def write_shards(rows: DataFrame, path: str, rows_in_file: int = 100_000) -> None:
    """Write ``shard=k`` folders whose files hold ranges of slots, each file in slot order."""
    (
        rows.repartition("shard", F.call_function("div", F.col("slot"), F.lit(rows_in_file)))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
