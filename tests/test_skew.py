"""Joins with a small side leave the other side free to be split where one key is hot."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import classify, terms
from millrace.operators.similarity import copies_of, pair_similarity
from millrace.operators.splits import user_holdout

ROWS = 60_000


@pytest.fixture
def skewed(spark):
    """No broadcasts, and limits at which half of the rows on one key are skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def split(frame) -> bool:
    frame.collect()
    return "skew=true" in frame._jdf.queryExecution().executedPlan().toString()


def hot(spark, cold: int):
    """``id`` and a key that is 0 for half of the rows."""
    key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % cold)
    return spark.range(0, ROWS, 1, 8).withColumn("key", key.cast("bigint"))


def test_holdout_of_a_hot_user(skewed):
    rows = hot(skewed, 500).select(F.col("key").alias("user_id"), F.col("id").alias("pos"))
    assert split(user_holdout(rows, 1, 5))


def test_weights_of_a_hot_term(skewed):
    tf = hot(skewed, 500).select(
        F.col("id").alias("doc_id"), F.col("key").cast("string").alias("term"), F.lit(2).alias("tf")
    )
    assert split(terms.tfidf(tf, ROWS))


def test_copies_of_a_hot_vector(skewed):
    vectors = hot(skewed, 500).select("id", F.col("key").alias("feature"), F.lit(1.0).alias("weight"))
    assert split(copies_of(vectors))


def test_lengths_of_a_hot_id(skewed):
    vectors = skewed.range(ROWS).select("id", F.lit(1).alias("feature"), F.lit(1.0).alias("weight"))
    pairs = hot(skewed, 500).select(F.col("key").alias("id_a"), F.col("id").alias("id_b"))
    assert split(pair_similarity(vectors, pairs))


def test_scores_of_a_hot_term(skewed):
    rows = hot(skewed, 500).withColumn("term", F.col("key").cast("string"))
    tf = rows.select(F.col("id").alias("doc_id"), "term", F.lit(1).cast("bigint").alias("tf"))
    labels = rows.select(F.col("id").alias("doc_id"), (F.col("id") % 3 % 2).alias("label"))
    model = classify.train_naive_bayes(tf, labels)
    assert split(classify.naive_bayes_scores(model, tf, labels))
