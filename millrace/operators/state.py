"""Running state after every batch, computed from a finished table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def user_totals_history(purchases: DataFrame, batch: str) -> DataFrame:
    """The totals of every user seen so far, after each batch.

    ``batch`` is a whole number counting batches without gaps.  Rows are first
    added up by user and batch, so a user has at most one row a batch in the
    window.  A total then stands until the user's next batch, and that span is
    spelled out in place, without a join on a batch-by-user grid.
    """
    last_batch = purchases.agg(F.max(batch)).scalar()
    per_batch = purchases.groupBy("user", F.col(batch).alias("batch")).agg(
        F.count("*").alias("n"), F.sum("price").alias("revenue")
    )
    order = Window.partitionBy("user").orderBy("batch")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = per_batch.select(
        "user",
        "batch",
        F.lead("batch").over(order).alias("next_batch"),
        F.sum("n").over(so_far).alias("n"),
        F.sum("revenue").over(so_far).alias("revenue"),
    )
    until = F.coalesce(F.col("next_batch") - 1, last_batch)
    return spans.select(
        F.explode(F.sequence(F.col("batch"), until)).alias("batch"), "user", "n", "revenue"
    )
