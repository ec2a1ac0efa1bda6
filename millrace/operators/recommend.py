"""Recommendations from ratings, and similar items."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import shared_folder
from .blocked import blocked_pairs
from .products import top_products
from .similarity import SimilarPairs, copies_of, similar_pairs


def factorise(
    ratings: DataFrame,
    rank: int = 10,
    iterations: int = 10,
    regularisation: float = 0.1,
    implicit: bool = False,
    seed: int = 1,
) -> ALSModel:
    """Fit user and item factors to ``user_id, item_id, rating``.

    Ids must fit into 32 bits, a limit of Spark's ALS.
    """
    shared_folder(ratings.sparkSession)  # where ALS cuts its lineage
    als = ALS(
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        rank=rank,
        maxIter=iterations,
        regParam=regularisation,
        implicitPrefs=implicit,
        coldStartStrategy="drop",
        seed=seed,
    )
    return als.fit(ratings.select("user_id", "item_id", "rating"))


def top_items(model: ALSModel, n: int, users: DataFrame | None = None) -> DataFrame:
    """The ``n`` best items of each user (or of ``users``): ``user_id, place, item_id, score``.

    Exact, but only items that can be among them are scored, see ``top_products``.  Scores have the
    precision of the factors, which are floats.
    """
    return pruned_top_items(model, n, users).select(
        F.col("user_id").cast("int").alias("user_id"),
        "place",
        F.col("item_id").cast("int").alias("item_id"),
        F.col("score").cast("float").cast("double").alias("score"),
    )


def pruned_top_items(model: ALSModel, n: int, users: DataFrame | None = None) -> DataFrame:
    """The same as ``top_items`` with ``scored``, without scoring all items with all users.

    Scores are sums of doubles, where Spark's own are of floats.
    """
    factors = model.userFactors.toDF("user_id", "factors")
    if users is not None:
        factors = factors.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return top_products(factors, model.itemFactors.toDF("item_id", "factors"), n)


def similar_items(ratings: DataFrame, min_cosine: float, min_users: int = 1) -> SimilarPairs:
    """Item pairs with alike ratings: cosine over users, ``common`` users in both.

    Items are the vectors and users their features.  With ``min_users`` above 1 the users
    of an item send it the numbers of their other items, which it counts, and only
    pairs with enough users are compared.  A user who rated very many items sends them only
    where much of both vectors is left to the frequent users.

    Items with the same ratings stand for each other: ``copies_a, copies_b``
    say for how many, and ``copies`` names them all.
    """
    return similar_pairs(_item_vectors(ratings), min_cosine, min_users)


def similar_items_blocked(
    ratings: DataFrame, min_cosine: float, min_users: int = 1
) -> SimilarPairs:
    """The same pairs by ``blocked_pairs``: items meet at a user only where enough of both is left.

    Meant for a low bound.  A user who rated everything with an ordinary weight opens no pair; one
    whose rating outweighs the rest of most items does, and ``similar_items`` with
    ``min_users`` above 1 is the better choice then.
    """
    return blocked_pairs(_item_vectors(ratings), min_cosine, min_users)


def item_copies(ratings: DataFrame) -> DataFrame:
    """``id, same_as``: each item and the smallest one with the same ratings."""
    return copies_of(_item_vectors(ratings))


def _item_vectors(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        F.col("item_id").alias("id"),
        F.col("user_id").alias("feature"),
        F.col("rating").alias("weight"),
    )
