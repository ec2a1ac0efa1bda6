"""Which ids may be alike: lists of whole numbers that each id is sent, and counted in its task.

A feature's ids are listed once.  Every id gets the lists of its features, cut down to the
ids with which enough is left from that feature on, as a number and one byte of
weight each.  The task of an id adds them up partner by partner, and only pairs whose sum
and count may still reach the bounds leave it; what they share exactly is joined for these alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

#: Numbers of a list in one row, and of an id's lists that one task adds up at once.
BLOCK = 1 << 15
#: Where several common features are asked for, those that so many ids have are met by all.
SELDOM = 1 << 8
# Bounds are compared with this much room, so that rounding cannot lose a pair.
_SLACK = 1e-9
_STEPS = 127


def placed(groups: DataFrame, name: str = "copies") -> DataFrame:
    """Add ``place``, a number without large gaps in the rows' order; an ``int`` where they all fit."""
    numbered = stored(groups.withColumn("_n", F.monotonically_increasing_id()), name, tidy=True)
    part, at = F.shiftright("_n", 33), F.col("_n").bitwiseAND(F.lit((1 << 33) - 1))
    last, most = numbered.agg(F.max(part), F.max(at)).first()
    each = (most or 0) + 1
    kind = "int" if ((last or 0) + 1) * each < 1 << 31 else "bigint"
    return numbered.withColumn("place", (part * each + at).cast(kind)).drop("_n")


def index_rows(ranked: DataFrame, min_common: int, least: float) -> DataFrame:
    """``place, feature, weight, size, df, from2, lists`` of the features that several ids have.

    ``size`` is the weight's share of the vector's length, ``from2`` the share of the squared
    length from the feature's rank on, 1 for features that all may meet at, and ``lists`` what
    the lists hold together that the id may be sent.
    """
    rows = ranked.filter(F.col("feature").isNotNull())
    size = F.abs(F.col("weight")) / F.sqrt("norm2")
    later = Window.partitionBy("id").orderBy(F.desc("rank")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    from2 = F.sum(F.col("weight") * F.col("weight") / F.col("norm2")).over(later)
    if min_common > 1:
        # From such a feature on an id has only features that are at least as frequent.
        from2 = F.when(F.col("df") > SELDOM, from2).otherwise(1.0)
    lists = F.sum(F.when(F.col("from2") >= least * (1 - 1e-6), F.col("df")).otherwise(0))
    return rows.select(
        "id", "place", "feature", "weight", size.alias("size"), "df", from2.alias("from2")
    ).withColumn("lists", lists.over(Window.partitionBy("id"))).drop("id")


def _often(min_common: int) -> Column:
    return F.col("df") > (SELDOM if min_common > 1 else 0)


def shipped(rows: DataFrame, least: float, length: int = BLOCK) -> DataFrame:
    """What meets: ``place, block, size, entries, sizes``, the ids met and their shares.

    ``least`` is what the products of both ``from2`` must reach.  Only lists of more than
    ``length`` numbers are taken apart, and only ids with so many in all their lists go to
    several tasks, so ordinary ids are one row a feature however many ids there are.
    """
    # Rounded up, so a sum of products is never too small.
    size = F.least(F.ceil(F.col("size") * _STEPS), F.lit(_STEPS)).cast("tinyint")
    entry = F.struct("place", size.alias("size"), (F.col("from2") * (1 + 1e-6)).cast("float").alias("from2"))
    piece = F.pmod(F.xxhash64("place"), F.ceil(F.col("df") / length))
    index = rows.groupBy("feature", piece.alias("piece")).agg(
        F.collect_list(entry).alias("listed"), F.max("from2").alias("most")
    )
    blocks = F.greatest(F.ceil(F.col("lists") / length), F.lit(1)).cast("int")
    block = F.explode(F.sequence(F.lit(0), blocks - 1))
    met = F.filter(
        "listed",
        lambda e: (e["place"] > F.col("place"))
        & (F.col("from2") * e["from2"] >= least)
        & ((F.col("blocks") == 1) | (F.pmod(F.hash(e["place"]), F.col("blocks")) == F.col("block"))),
    )
    return (
        rows.select("place", "feature", size.alias("size"), "from2", blocks.alias("blocks"), block.alias("block"))
        .join(stored(index, "lists"), "feature")
        .filter(F.col("from2") * F.col("most") * (1 + 1e-6) >= least)
        .select("place", "block", "size", met.alias("met"))
        .filter(F.size("met") > 0)
        .select("place", "block", "size", F.col("met.place").alias("entries"), F.col("met.size").alias("sizes"))
    )


def _summed(values: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """One entry a pair."""
    order = np.lexsort((values["b"], values["a"]))
    a, b = values["a"][order], values["b"][order]
    begins = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(a)])
    found = {"a": a[begins], "b": b[begins], "block": values["block"][order][begins]}
    for name in ("sum", "common"):
        own = values[name][order]
        found[name] = np.add.reduceat(own, begins) if len(own) else own
    return found


def may_reach(
    rows: DataFrame, threshold: float, min_common: int, keep: float, lists: DataFrame
) -> DataFrame:
    """``id_a, id_b`` by place, each pair once: all that may reach both bounds, and some others.

    ``lists`` is what ``shipped`` gives with ``(keep * threshold) ** 2``.  What did
    not meet is worth ``keep * threshold`` at most.  With ``min_common`` such features are
    among the frequent ones of either id, where less than that is left: so few may be missing.
    """
    need = threshold * (1 - keep) - _SLACK

    def met(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        there = batch["entries"]
        own = np.repeat(np.arange(batch.num_rows), np.diff(there.offsets.to_numpy()))
        sizes = batch["size"].to_numpy()[own].astype(np.int64)
        return {
            "a": batch["place"].to_numpy()[own],
            "b": there.flatten().to_numpy(),
            "block": batch["block"].to_numpy()[own],
            "sum": sizes * batch["sizes"].flatten().to_numpy(),
            "common": np.ones(len(own), dtype=np.int64),
        }

    def kept(pairs: dict[str, np.ndarray], least: int) -> pa.RecordBatch:
        may = (pairs["sum"] >= need * _STEPS**2) & (pairs["common"] >= least)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(pairs["a"][may].astype(np.int64)),
                pa.array(pairs["b"][may].astype(np.int64)),
                pa.array(pairs["common"][may]),
            ],
            names=["id_a", "id_b", "met"],
        )

    missing = None
    if min_common > 1:
        missing = stored(
            rows.filter(_often(min_common) & (F.col("from2") < keep * threshold * (1 + 1e-6)))
            .groupBy("place")
            .agg(F.count("*").alias("missing")),
            "missing",
        )
        two = missing.select(F.max("missing")).first()[0] or 0
        at_least = max(min_common - 2 * two, 1)
    else:
        at_least = 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = met(batch)
            if carried is not None:
                new = {name: np.concatenate([carried[name], new[name]]) for name in new}
            pairs = _summed(new)
            # The last id and block may go on in the next batch.
            last = (pairs["a"] == batch["place"][-1].as_py()) & (
                pairs["block"] == batch["block"][-1].as_py()
            )
            carried = {name: values[last] for name, values in pairs.items()}
            yield kept({name: values[~last] for name, values in pairs.items()}, at_least)
        if carried is not None:
            yield kept(carried, at_least)

    dealt = lists.repartition("place", "block").sortWithinPartitions("place", "block")
    found = dealt.mapInArrow(work, "id_a bigint, id_b bigint, met bigint")
    if missing is not None and at_least < min_common:
        for s in "ab":
            found = found.join(missing.toDF(f"id_{s}", f"missing_{s}"), f"id_{s}", "left")
        may = F.col("met") + F.coalesce("missing_a", F.lit(0)) + F.coalesce("missing_b", F.lit(0))
        found = found.filter(may >= min_common)
    return found.select("id_a", "id_b")


def completed(found: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``id_a, id_b, copies_a, copies_b, common, cosine`` of pairs of places, over all they share."""
    one = rows.select("place", "feature", "weight")
    sums = (
        found.join(one.toDF("id_a", "feature", "w_a"), "id_a")
        .join(one.toDF("id_b", "feature", "w_b"), ["id_b", "feature"])
        .groupBy("id_a", "id_b")
        .agg(F.sum(F.col("w_a") * F.col("w_b")).alias("dot"), F.count("*").alias("common"))
    )
    return named(sums, groups)


def named(sums: DataFrame, groups: DataFrame) -> DataFrame:
    """``id_a, id_b, copies_a, copies_b, common, cosine`` of places with ``dot`` and ``common``."""
    names = groups.select("place", "id", "copies", "norm2")
    pairs = (
        sums.join(names.toDF("id_a", "a", "copies_1", "norm2_a"), "id_a")
        .join(names.toDF("id_b", "b", "copies_2", "norm2_b"), "id_b")
        .withColumn("cosine", F.col("dot") / F.sqrt(F.col("norm2_a") * F.col("norm2_b")))
    )
    first = F.col("a") < F.col("b")
    return pairs.select(
        F.least("a", "b").alias("id_a"),
        F.greatest("a", "b").alias("id_b"),
        F.when(first, F.col("copies_1")).otherwise(F.col("copies_2")).alias("copies_a"),
        F.when(first, F.col("copies_2")).otherwise(F.col("copies_1")).alias("copies_b"),
        "common",
        "cosine",
    )
