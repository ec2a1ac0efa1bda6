"""Queries on ratings: recommendations and similar items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import recommend as op
from ..operators.products import top_products
from ..storage import stored
from .inputs import part_ratings, table
from .registry import query

MIN_COSINE = 0.2
MIN_USERS = 3


@query()
def als_top_n(spark: SparkSession, root: str) -> DataFrame:
    model = op.factorise(part_ratings(spark, root), rank=8, iterations=5, seed=1)
    return op.top_items(model, 5)


_SIMILAR = f"""
    WITH r AS (
      SELECT o_custkey AS u, l_partkey AS i, sum(l_quantity) AS w
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
    marks AS (SELECT i, string_agg(u || ' ' || w, ',' ORDER BY u) AS mark, sum(w * w) AS norm2
              FROM r GROUP BY i),
    same AS (SELECT i, norm2, min(i) OVER (PARTITION BY mark) AS same_as,
                    count(*) OVER (PARTITION BY mark) AS copies FROM marks),
    v AS (SELECT i, u, w, norm2, copies FROM r JOIN same USING (i) WHERE i = same_as),
    pairs AS (
      SELECT a.i AS item_a, b.i AS item_b, count(*) AS common,
             any_value(a.copies) AS copies_a, any_value(b.copies) AS copies_b,
             sum(a.w * b.w) / sqrt(any_value(a.norm2) * any_value(b.norm2)) AS cosine
      FROM v a JOIN v b ON a.u = b.u AND a.i < b.i GROUP BY a.i, b.i)
    SELECT item_a, item_b, copies_a, copies_b, common, round(cosine, 8) AS cosine
    FROM pairs WHERE cosine >= {MIN_COSINE} AND common >= {MIN_USERS}
    """


def _pairs(found: op.SimilarPairs) -> DataFrame:
    return found.pairs.select(
        F.col("id_a").alias("item_a"),
        F.col("id_b").alias("item_b"),
        "copies_a",
        "copies_b",
        "common",
        F.round("cosine", 8).alias("cosine"),
    )


@query(_SIMILAR)
def item_similarity(spark: SparkSession, root: str) -> DataFrame:
    ratings = stored(part_ratings(spark, root), "ratings")
    return _pairs(op.similar_items(ratings, MIN_COSINE, MIN_USERS))


@query(_SIMILAR)
def item_similarity_blocked(spark: SparkSession, root: str) -> DataFrame:
    """The same pairs through blocks of the inverted index."""
    ratings = stored(part_ratings(spark, root), "ratings")
    return _pairs(op.similar_items_blocked(ratings, MIN_COSINE, MIN_USERS))


@query(
    """
    WITH r AS (
      SELECT o_custkey AS u, l_partkey AS i, sum(l_quantity) AS w
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
    twice AS (
      SELECT u, 2 * i AS i, w FROM r UNION ALL SELECT u, 2 * i + 1 AS i, w FROM r WHERE i % 10 = 0),
    marks AS (SELECT i, string_agg(u || ' ' || w, ',' ORDER BY u) AS mark FROM twice GROUP BY i)
    SELECT i AS item, min(i) OVER (PARTITION BY mark) AS same_as FROM marks
    """
)
def item_copies(spark: SparkSession, root: str) -> DataFrame:
    """The item that stands for each item, where every tenth part is sold under two numbers."""
    ratings = part_ratings(spark, root)
    numbers = F.when(F.col("item_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    twice = ratings.withColumn("more", F.explode(numbers)).withColumn(
        "item_id", 2 * F.col("item_id") + F.col("more")
    )
    found = op.item_copies(stored(twice, "ratings"))
    return found.select(F.col("id").alias("item"), "same_as")


@query(
    """
    SELECT DISTINCT o_custkey AS user_id, 0.0::double AS residual
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """
)
def als_residuals(spark: SparkSession, root: str) -> DataFrame:
    """How far each user's factors are from the best ones for the items' factors.

    The last half step solves that for every user: the sum over the user's
    ratings of (score - rating) * item factors, plus regularisation * ratings *
    user factors, is 0, here relative to the sum of rating * item factors.
    """
    regularisation = 0.1
    ratings = stored(part_ratings(spark, root), "ratings")
    model = op.factorise(ratings, rank=8, iterations=5, regularisation=regularisation, seed=1)
    users = stored(model.userFactors.toDF("user_id", "x"), "users")
    items = stored(model.itemFactors.toDF("item_id", "y"), "items")
    met = ratings.join(items, "item_id").join(users, "user_id")
    dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    sums = (
        met.select("user_id", "rating", (dot - F.col("rating")).alias("off"), F.arrays_zip("x", "y").alias("f"))
        .select("user_id", "rating", "off", F.posexplode("f").alias("k", "f"))
        .groupBy("user_id", "k")
        .agg(
            F.sum(F.col("off") * F.col("f.y") + regularisation * F.col("f.x")).alias("slope"),
            F.sum(F.col("rating") * F.col("f.y")).alias("pull"),
        )
    )
    share = F.sqrt(F.sum(F.col("slope") ** 2) / F.sum(F.col("pull") ** 2))
    return sums.groupBy("user_id").agg(F.round(share, 3).alias("residual"))


@query(
    """
    SELECT DISTINCT o_custkey AS user_id, 5::bigint AS items, true AS falling
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """
)
def als_places(spark: SparkSession, root: str) -> DataFrame:
    """Each user's list has five different items with scores that do not rise."""
    listed = als_top_n(spark, root)
    one = F.sort_array(F.collect_list(F.struct("place", "score")))  # five a user
    falls = F.forall(
        F.sequence(F.lit(1), F.size("list") - 1),
        lambda k: F.element_at("list", k)["score"] >= F.element_at("list", k + 1)["score"],
    )
    return (
        listed.groupBy("user_id")
        .agg(F.count_distinct("item_id").alias("items"), one.alias("list"))
        .select("user_id", "items", falls.alias("falling"))
    )


@query()
def als_top_items_pruned(spark: SparkSession, root: str) -> DataFrame:
    """The same lists as ``als_top_n``, with the share of all items that each user was compared with."""
    model = op.factorise(part_ratings(spark, root), rank=8, iterations=5, seed=1)
    items = model.itemFactors.agg(F.count("*")).scalar()
    return op.pruned_top_items(model, 5).withColumn("share", F.col("scored") / items).drop("scored")


@query(
    """
    WITH v AS (
      SELECT vec_id, 1 + label AS w,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
      FROM embeddings),
    s AS (
      SELECT a.vec_id AS user_id, b.vec_id AS item_id,
             b.w * list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS score
      FROM v a JOIN v b ON true)
    SELECT user_id, cast(row_number() OVER (
             PARTITION BY user_id ORDER BY score DESC, item_id) AS integer) AS place, item_id, score
    FROM s QUALIFY place <= 5
    """
)
def factor_top_items(spark: SparkSession, root: str) -> DataFrame:
    """Given factors: every vector as a user, and weighted by its label as an item."""
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(256 * x).cast("double"))
    rows = table(spark, root, "embeddings").select("vec_id", "label", whole.alias("factors"))
    weight = 1 + F.col("label")
    items = rows.select(
        F.col("vec_id").alias("item_id"), F.transform("factors", lambda x: x * weight).alias("factors")
    )
    return top_products(rows.withColumnRenamed("vec_id", "user_id"), items, 5).drop("scored")
