"""Queries on train/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import splits as op
from ..storage import new_folder
from .inputs import event_ratings, purchases
from .registry import query

_FOLDS = """
    SELECT event_id, user_id, value,
           cast((row_number() OVER (ORDER BY event_id) - 1) * 5
                // count(*) OVER () AS integer) AS fold
    FROM events
"""


@query(f"SELECT event_id AS pos, fold FROM ({_FOLDS})")
def contiguous_folds(spark: SparkSession, root: str) -> DataFrame:
    return op.contiguous_folds(event_ratings(spark, root), "pos").select("pos", "fold")


@query(
    f"""
    WITH f AS ({_FOLDS}), pairs AS (SELECT cast(unnest(range(5)) AS integer) AS pair)
    SELECT pair AS fold, CASE WHEN f.fold = pair THEN 'test' ELSE 'base' END AS role,
           count(*) AS ratings, count(DISTINCT user_id) AS users, min(event_id) AS first_pos,
           round(sum(value), 2) AS total
    FROM f CROSS JOIN pairs GROUP BY 1, 2
    """
)
def fold_roles(spark: SparkSession, root: str) -> DataFrame:
    folded = op.contiguous_folds(event_ratings(spark, root), "pos")
    return op.fold_roles(folded).groupBy("fold", "role").agg(
        F.count("*").alias("ratings"),
        F.count_distinct("user_id").alias("users"),
        F.min("pos").alias("first_pos"),
        F.round(F.sum("rating"), 2).alias("total"),
    )


@query(
    f"""
    WITH f AS ({_FOLDS}), pairs AS (SELECT cast(unnest(range(5)) AS integer) AS pair)
    SELECT pair AS fold, CASE WHEN f.fold = pair THEN 'test' ELSE 'base' END AS role,
           event_id AS pos, user_id
    FROM f CROSS JOIN pairs
    """
)
def fold_outputs(spark: SparkSession, root: str) -> DataFrame:
    """The five written pairs, read back."""
    folded = op.contiguous_folds(event_ratings(spark, root), "pos")
    path = new_folder(spark, "folds")
    op.write_pairs(op.fold_roles(folded), path)
    return spark.read.parquet(path).select("fold", "role", "pos", "user_id")


def _holdout_sql(start: int, stop: int, cap: int = 0) -> str:
    within = f"AND nth <= {cap}" if cap else ""
    return f"""
    WITH ranked AS (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events),
    chosen AS (
      SELECT event_id, row_number() OVER (ORDER BY event_id) AS nth
      FROM ranked WHERE r BETWEEN {start} AND {stop})
    SELECT e.event_id AS pos, e.user_id,
           CASE WHEN c.event_id IS NOT NULL {within} THEN 'test' ELSE 'base' END AS role
    FROM events e LEFT JOIN chosen c USING (event_id)
    """


def _holdout(spark: SparkSession, root: str, start: int, stop: int, cap: int = 0) -> DataFrame:
    ratings = event_ratings(spark, root)
    return op.user_holdout(ratings, start, stop, cap).select("pos", "user_id", "role")


@query(_holdout_sql(1, 10))
def user_holdout_ua(spark: SparkSession, root: str) -> DataFrame:
    return _holdout(spark, root, 1, 10)


@query(_holdout_sql(11, 20))
def user_holdout_ub(spark: SparkSession, root: str) -> DataFrame:
    return _holdout(spark, root, 11, 20)


@query(_holdout_sql(1, 10, 500))
def user_holdout_capped(spark: SparkSession, root: str) -> DataFrame:
    return _holdout(spark, root, 1, 10, 500)


@query(
    """
    SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'train' ELSE 'test' END AS split
    FROM events
    """
)
def split_by_date(spark: SparkSession, root: str) -> DataFrame:
    return op.split_by_date(purchases(spark, root), "ts", "2024-01-20").select("event_id", "split")
