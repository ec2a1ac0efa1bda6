"""Figures about purchases: per batch, per window, per product, per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def purchase_summary(purchases: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Purchases, exact unique users, revenue and the most popular product.

    One row for each combination of ``keys``, or one row in all without keys;
    the latter exists for no input too, with zeros and no product.  The smaller
    name wins a tie between products.

    A single scan feeds both groupings, by user and by product.  Each is
    combined in the map tasks and shuffled on the full grouping key, so a
    window, user or product that owns most of the rows does not land in one
    task; only the combined rows meet by ``keys``.
    """
    keys = list(keys)
    combined = purchases.groupingSets(
        [[*keys, "user"], [*keys, "product"]], *keys, "user", "product"
    ).agg(
        F.grouping("user").alias("is_product"),
        F.count("*").alias("n"),
        F.sum("price").alias("revenue"),
    )
    product = F.col("is_product") == 1
    best = F.min(F.when(product, F.struct((-F.col("n")).alias("rank"), "product")))
    return (
        combined.groupBy(*keys)
        .agg(
            F.coalesce(F.sum(F.when(product, F.col("n"))), F.lit(0)).alias("purchases"),
            F.count_if(~product & F.col("user").isNotNull()).alias("unique_users"),
            F.coalesce(F.sum(F.when(product, F.col("revenue"))), F.lit(0.0)).alias("revenue"),
            best.alias("best"),
        )
        .select(
            *keys,
            "purchases",
            "unique_users",
            "revenue",
            F.col("best.product").alias("top_product"),
            F.coalesce(-F.col("best.rank"), F.lit(0)).alias("top_count"),
        )
    )


def with_window(events: DataFrame, time: str, duration: str) -> DataFrame:
    """Add ``window_start``, the start of the tumbling window of each event."""
    return events.withColumn("window_start", F.window(time, duration)["start"])


def report_line(summary: DataFrame) -> DataFrame:
    """Add ``line``, the most popular product as a sentence."""
    return summary.withColumn(
        "line",
        F.format_string(
            "%s leads with %d sold", "top_product", "top_count"
        ),
    )


def product_counts(purchases: DataFrame) -> DataFrame:
    """Purchases of each product, unordered: ``product, n``."""
    return purchases.groupBy("product").agg(F.count("*").alias("n"))


def products_by_popularity(purchases: DataFrame) -> DataFrame:
    """Products by falling number of purchases, ties by name; sorted in parallel."""
    return product_counts(purchases).orderBy(F.desc("n"), "product")


def first_rows(rows: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a stated order; each task keeps only its own ``n``."""
    return rows.orderBy(*order).limit(n)


def user_totals(purchases: DataFrame) -> DataFrame:
    """Number of purchases and revenue of each user: ``user, n, revenue``.

    Works on a stream as well, where it is the running state of all batches.
    """
    return purchases.groupBy("user").agg(
        F.count("*").alias("n"), F.sum("price").alias("revenue")
    )
