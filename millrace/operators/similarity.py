"""Cosine similarity of sparse vectors stored as ``id, feature, weight`` rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import discard, stored
from .given import family_products, likely, listed, pair_products
from .heads import heads, met_in_tiles
from .meeting import completed, index_rows, may_reach, named, placed, shipped

# Bounds are compared with this much room, so that rounding cannot lose a pair.
_SLACK = 1e-9
# With several common features, what is left of two vectors counts down to this share of the bound.
_KEEP = 0.25
_MARKS = ["sign_1", "sign_2", "features"]


class SimilarPairs(NamedTuple):
    """``pairs``: ``id_a, id_b, copies_a, copies_b, common, cosine``.
    ``copies``: ``id, same_as``, every id and the id that stands for its copies.
    """

    pairs: DataFrame
    copies: DataFrame


def pair_similarity(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """The cosine of given pairs: ``id_a, id_b, cosine``, each pair once.

    0 without a common feature; an id that has no rows is the zero vector.  A
    pair that is listed again counts once.  The vectors are filed, each in one row, so
    that an id in very many pairs can be split, and a pair is multiplied where its rows meet.
    """
    pairs = pairs.select("id_a", "id_b").distinct()
    dots = pair_products(pairs, stored(listed(vectors), "listed"))
    cosine = F.col("dot") / (F.sqrt("norm2_a") * F.sqrt("norm2_b"))
    return dots.select(
        "id_a", "id_b", F.when(F.col("common") > 0, cosine).otherwise(0.0).alias("cosine")
    )


def similar_pairs(vectors: DataFrame, threshold: float, min_common: int = 1) -> SimilarPairs:
    """All pairs with a cosine of at least ``threshold``, exactly.

    With ``min_common``, only pairs that share so many features.  Pairs that share
    fewer are most of those that meet at all, so what meets is first counted as
    plain numbers in the task of each id (see ``meeting``), and only pairs with
    enough in common are joined with their vectors.

    Ids with the same vector are copies of each other; pairs are formed between
    one id of each set of copies, so a set with a third of all ids costs as much
    as one id.  ``copies`` leads back to every id.

    Without it, the rest is prefix filtering (Bayardo, Ma and Srikant, 2007).  Features are
    ranked from rare to frequent, and the head of a vector is its rarest part,
    as short as it can be with a remaining tail shorter than the threshold.  Two
    vectors that share nothing in their heads cannot reach the threshold, so
    only heads are joined, and only where the rest of both together can reach it.  The
    pairs that are left are multiplied family by family (see ``given``): a vector is sent to
    groups of pairs, not to each of its pairs.

    Ranks are steps of the document frequency, four to a doubling.  Lengths are
    then sums by id and rank, at most some 250 rows an id, and no window ever
    holds a whole vector.

    ``vectors`` is read several times; pass a stored table.  It may also have one row an id, as
    ``terms.tfidf`` gives with ``listed``: ``id, features, weights, norm2`` without weights of 0,
    features ascending, and rare ones before frequent ones for speed.  Then the heads meet in
    tiles (see ``heads``), and an entry is never a row of a join or shuffle.
    """
    if "features" in vectors.columns:
        if min_common == 1:
            return _similar_lists(vectors, threshold)
        vectors = vectors.select("id", F.inline(F.arrays_zip("features", "weights"))).toDF("id", "feature", "weight")
    vectors = vectors.filter(F.col("weight") != 0).select("id", "feature", "weight")
    groups = placed(_groups(_signatures(vectors)))
    ranked = stored(_ranked(vectors, groups, stored(_numbered(vectors), "features")), "ranked")
    if min_common > 1:
        least = (_KEEP * threshold) ** 2
        rows = stored(index_rows(ranked, min_common, least), "index")
        found = may_reach(rows, threshold, min_common, _KEEP, shipped(rows, least))
        pairs = completed(stored(found, "met"), rows, groups)
    else:
        met = stored(_met(_heads(ranked, threshold), threshold), "met")
        entries = ranked.filter(F.col("feature").isNotNull()).select(
            F.col("place").alias("id"), "feature", "weight"
        )
        pairs = named(family_products(met, stored(listed(entries), "listed")), groups)
    pairs = pairs.filter((F.col("cosine") >= threshold) & (F.col("common") >= min_common))
    return SimilarPairs(pairs, copies_of(vectors))


def _similar_lists(vectors: DataFrame, threshold: float) -> SimilarPairs:
    """``similar_pairs`` of rows ``id, features, weights, norm2``."""
    signed = stored(_signatures(vectors), "signatures", tidy=True)
    groups = placed(_groups(signed))
    places = groups.select("id", "place")
    top = stored(heads(vectors, threshold).join(places, "id").drop("id"), "heads", tidy=True)
    met = stored(met_in_tiles(top, threshold), "met", tidy=True)
    discard(top)
    ends = met.select(F.col("id_a").alias("place")).unionByName(met.select(F.col("id_b").alias("place")))
    wanted = stored(ends.distinct().join(places, "place"), "wanted", tidy=True)
    rows = likely(vectors, wanted, "id").join(wanted, "id").select(F.col("place").alias("id"), "features", "weights")
    rows = stored(rows, "listed", tidy=True)
    products = stored(family_products(met, rows), "products", tidy=True)
    discard(rows)
    pairs = named(products, groups).filter(F.col("cosine") >= threshold)
    return SimilarPairs(pairs, _copies(signed))


def copies_of(vectors: DataFrame) -> DataFrame:
    """``id, same_as``: each id and the smallest id with exactly the same vector.

    The groups have one row a set of copies and are filed, so a very large set
    makes only one side of the join large, which Spark can split.  ``vectors`` as in ``similar_pairs``.
    """
    if "features" not in vectors.columns:
        vectors = vectors.filter(F.col("weight") != 0)
    return _copies(stored(_signatures(vectors), "signatures"))


def _copies(signed: DataFrame) -> DataFrame:
    groups = stored(_groups(signed).withColumnRenamed("id", "same_as"), "groups")
    return signed.join(groups.select(*_MARKS, "same_as"), _MARKS).select("id", "same_as")


def _groups(signed: DataFrame) -> DataFrame:
    return signed.groupBy(*_MARKS).agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.min("norm2").alias("norm2")
    )


def _signatures(vectors: DataFrame) -> DataFrame:
    """Per id, two independent 64-bit marks of the set of (feature, weight)."""
    if "features" in vectors.columns:
        return vectors.select(
            "id",
            F.xxhash64("features", "weights").alias("sign_1"),
            F.xxhash64(F.lit(1), "weights", "features").alias("sign_2"),
            F.size("features").cast("bigint").alias("features"),
            "norm2",
        )
    return vectors.groupBy("id").agg(
        F.bit_xor(F.xxhash64("feature", "weight")).alias("sign_1"),
        F.bit_xor(F.xxhash64(F.lit(1), "weight", "feature")).alias("sign_2"),
        F.count("*").alias("features"),
        F.sum(F.col("weight") * F.col("weight")).alias("norm2"),
    )


def _numbered(vectors: DataFrame) -> DataFrame:
    """``feature, number, df`` of the features that more than one id has.

    The numbers stand for the features in all later joins, whatever their type.
    They hold only as long as these rows are written once and read from there.
    """
    frequency = vectors.groupBy("feature").agg(F.count("*").alias("df"))
    return frequency.filter(F.col("df") > 1).withColumn("number", F.monotonically_increasing_id())


def _ranked(vectors: DataFrame, groups: DataFrame, features: DataFrame) -> DataFrame:
    """Vectors of the ids that stand for copies: ``id, feature, weight, norm2, place, rank, df``.

    ``rank`` grows with the number of ids that have the feature.  A feature of
    one id alone has rank 0 and no number: it is part of the length only.
    """
    rank = F.floor(4 * F.log2("df")).cast("int")
    return (
        vectors.join(groups.select("id", "norm2", "place"), "id")
        .join(features, "feature", "left")
        .select(
            "id",
            "place",
            F.col("number").alias("feature"),
            "weight",
            "norm2",
            F.coalesce(rank, F.lit(0)).alias("rank"),
            F.coalesce("df", F.lit(1)).alias("df"),
        )
    )


def _heads(ranked: DataFrame, threshold: float) -> DataFrame:
    """``place, feature, size, from2, after2`` of the rows of the heads.

    ``size`` is the weight's share of the vector's length; ``from2`` is the share of ``norm2``
    from the row's rank on, ``after2`` what follows the rank.
    """
    later = Window.partitionBy("id").orderBy(F.desc("rank")).rowsBetween(Window.unboundedPreceding, -1)
    lengths = (
        ranked.groupBy("id", "rank")
        .agg(F.sum(F.col("weight") * F.col("weight") / F.col("norm2")).alias("here2"))
        .withColumn("after2", F.coalesce(F.sum("here2").over(later), F.lit(0.0)))
        .withColumn("from2", F.col("here2") + F.col("after2"))
        .filter(F.col("from2") >= threshold**2 - _SLACK)
        .drop("here2")
    )
    return (
        ranked.filter(F.col("feature").isNotNull())
        .join(lengths, ["id", "rank"])
        .select("place", "feature", (F.col("weight") / F.sqrt("norm2")).alias("size"), "from2", "after2")
    )


def _met(heads: DataFrame, threshold: float) -> DataFrame:
    """``id_a, id_b`` by place, each pair once: those that may reach the threshold.

    The rarest common feature of two vectors has the largest product of ``from2``, whose root
    bounds their cosine, so they need to meet only where this product suffices.  From the last
    feature met on, all they share lies after its rank.
    """
    names = ["size", "from2", "after2"]
    a, b = (
        heads.select("feature", F.col("place").alias(f"id_{s}"), *(F.col(n).alias(f"{n}_{s}") for n in names))
        for s in "ab"
    )
    met = a.join(b, "feature").filter(
        (F.col("id_a") < F.col("id_b")) & (F.col("from2_a") * F.col("from2_b") >= threshold**2 - _SLACK)
    )
    sums = met.groupBy("id_a", "id_b").agg(
        F.sum(F.col("size_a") * F.col("size_b")).alias("dot"),
        F.min(F.col("after2_a") * F.col("after2_b")).alias("missing2"),
    )
    most = F.col("dot") + F.sqrt(F.greatest("missing2", F.lit(0.0)))
    return sums.filter(most >= threshold - _SLACK).select("id_a", "id_b")
