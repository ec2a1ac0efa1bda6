"""A bounded set of bits that keeps most rows out of a costly step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored

#: Rows of a bit table at most; each holds 64 bits, so a table is 1 MB.
WORDS = 1 << 16


def _place(keys: list[Column]) -> tuple[Column, Column]:
    position = F.pmod(F.xxhash64(*keys), F.lit(WORDS * 64))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (position % 64).cast("int"))
    return F.shiftright(position, 6), bit


def bit_table(keys: DataFrame) -> DataFrame:
    """One bit for the hash of each row, as ``bit_word, bit_mask``: ``WORDS`` rows at most."""
    word, bit = _place([F.col(name) for name in keys.columns])
    return (
        keys.select(word.alias("bit_word"), bit.alias("bit"))
        .groupBy("bit_word")
        .agg(F.bit_or("bit").alias("bit_mask"))
    )


def marked(rows: DataFrame, bits: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add boolean ``name``: true for every key that is in the table, and for few others.

    The table has a fixed size, so it is broadcast whatever the input's size;
    the rows stay where they are.
    """
    word, bit = _place([F.col(key) for key in keys])
    table = bits.withColumnsRenamed({"bit_word": "_bit_word", "bit_mask": "_bit_mask"})
    joined = rows.withColumn("_bit_word", word).join(F.broadcast(table), "_bit_word", "left")
    found = F.coalesce(F.col("_bit_mask").bitwiseAND(bit) != 0, F.lit(False))
    return joined.withColumn(name, found).drop("_bit_word", "_bit_mask")


def without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``dropped`` (one column, the key).

    Only rows that the bit table cannot clear are shuffled.  Rows without a key stay.
    """
    bits = stored(bit_table(dropped), "bits")
    split = marked(rows, bits, [key], "_bit_hit")
    unsure = split.filter("_bit_hit").join(dropped.distinct(), key, "left_anti")
    kept = split.filter("NOT _bit_hit").unionByName(unsure)
    return kept.select(rows.columns)
