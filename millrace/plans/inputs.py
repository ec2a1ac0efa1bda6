"""The test tables as the rows the operators work on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))


def purchases(spark: SparkSession, root: str) -> DataFrame:
    """Events as purchases, still numbered by ``event_id``: every event counts."""
    return table(spark, root, "events").select(
        "event_id",
        "ts",
        F.col("user_id").cast("string").alias("user"),
        F.col("event_type").alias("product"),
        F.col("value").alias("price"),
    )


def purchase_lines(spark: SparkSession, root: str) -> DataFrame:
    """The same as ``event_id`` and a ``user,product,price`` line."""
    line = F.concat_ws(",", "user", "product", F.col("price").cast("string"))
    return purchases(spark, root).select("event_id", line.alias("value"))


def order_purchases(spark: SparkSession, root: str) -> DataFrame:
    """Order lines as purchases: ``user, product, price, ts``."""
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("product"),
        F.col("l_extendedprice").alias("price"),
        F.col("o_orderdate").alias("ts"),
    )


def event_ratings(spark: SparkSession, root: str) -> DataFrame:
    """Events as ratings in file order: ``user_id, item_id, rating, pos``."""
    return table(spark, root, "events").select(
        "user_id",
        F.col("event_id").alias("item_id"),
        F.col("value").alias("rating"),
        F.col("event_id").alias("pos"),
    )


def part_ratings(spark: SparkSession, root: str) -> DataFrame:
    """How much of a part a customer bought, as a rating."""
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return joined.groupBy(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")
    ).agg(F.sum("l_quantity").alias("rating"))


def vectors(spark: SparkSession, root: str) -> DataFrame:
    """``vec_id, label, features array<double>``."""
    return table(spark, root, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("features")
    )


def point_lines(spark: SparkSession, root: str) -> DataFrame:
    """Vectors as ``vec_id`` and a ``label<TAB>f1,f2,...`` line."""
    texts = F.array_join(F.col("features").cast("array<string>"), ",")
    line = F.concat_ws("\t", F.col("label").cast("string"), texts)
    return vectors(spark, root).select("vec_id", line.alias("value"))


def document_ids(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id")


def documents(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", "text")


def labelled_documents(spark: SparkSession, root: str) -> DataFrame:
    """``doc_id, text, label``: documents with a known quality."""
    labels = table(spark, root, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents(spark, root).join(labels, "doc_id").select("doc_id", "text", "label")
