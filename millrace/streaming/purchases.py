"""Purchase streams: preview, batch summaries, window summaries, user totals.

Each ``start_*`` function takes a streaming frame and gives the started query.
The default trigger is one batch every ten seconds; ``once=True`` works off what
is there and stops, in as many batches as the source's limits ask for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.times import instant_to_wall
from ..operators.lines import accepted, parse_purchases, quarantined
from ..operators.summary import first_rows, purchase_summary, user_totals
from ..storage import write_batch
from .state_reader import state_at

#: Fixed value: the length of a batch.
BATCH_INTERVAL = "10 seconds"


def triggered(writer: DataStreamWriter, checkpoint: str, once: bool) -> DataStreamWriter:
    """Set the cadence and the checkpoint that every query needs to restart."""
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=BATCH_INTERVAL)


def start_each_batch(
    stream: DataFrame,
    action: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = False,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``action(rows, batch_id)`` on every batch."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(action)
    return triggered(writer, checkpoint, once).start()


def start_console(
    lines: DataFrame, checkpoint: str, rows: int = 10, once: bool = False
) -> StreamingQuery:
    """Print the first rows of every batch."""
    writer = lines.writeStream.format("console").option("numRows", rows)
    return triggered(writer.option("truncate", False), checkpoint, once).start()


def start_preview(
    rows: DataFrame,
    order: list[str],
    out: str,
    checkpoint: str,
    n: int = 10,
    once: bool = False,
) -> StreamingQuery:
    """File the first ``n`` rows of every batch in a stated order."""

    def preview(batch: DataFrame, batch_id: int) -> None:
        write_batch(first_rows(batch, order, n), out, batch_id)

    return start_each_batch(rows, preview, checkpoint, once)


def start_summaries(
    lines: DataFrame, out: str, checkpoint: str, quarantine: str | None = None, once: bool = False
) -> StreamingQuery:
    """File one summary row for every batch, and its bad lines if asked to.

    An empty batch gives a row of zeros without a product.
    """

    def summarise(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_purchases(batch)
        if quarantine is None:
            write_batch(purchase_summary(accepted(parsed)), out, batch_id)
            return
        parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(purchase_summary(accepted(parsed)), out, batch_id)
            write_batch(quarantined(parsed), quarantine, batch_id)
        finally:
            parsed.unpersist()

    return start_each_batch(lines, summarise, checkpoint, once)


def window_totals(events: DataFrame, time: str, duration: str, lateness: str) -> DataFrame:
    """Purchases, exact unique users, revenue and top product of each event-time window.

    ``time`` is a timestamp; rows have ``user, product, price``.  Each event
    counts once for its user and once for its product, so that on a stream the
    first grouping makes users countable and products comparable exactly.  Both
    groupings forget a window once the watermark has passed it, and it is
    emitted then.  Of equally frequent products the smaller name wins.
    """

    def side(kind: int, name: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(name).cast("string").alias("name"))

    counted = (
        events.withWatermark(time, lateness)
        .withColumn("side", F.explode(F.array(side(0, "user"), side(1, "product"))))
        .groupBy(F.window(time, duration).alias("window"), "side.kind", "side.name")
        .agg(F.count("*").alias("n"), F.sum("price").alias("revenue"))
    )
    users, products = F.col("kind") == 0, F.col("kind") == 1
    best = F.min(F.when(products, F.struct((-F.col("n")).alias("rank"), F.col("name"))))
    return (
        counted.groupBy(F.window(F.window_time("window"), duration).alias("window"))
        .agg(
            F.sum(F.when(users, F.col("n"))).alias("purchases"),
            F.count(F.when(users, F.col("name"))).alias("unique_users"),
            F.sum(F.when(users, F.col("revenue"))).alias("revenue"),
            best.alias("best"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "purchases",
            "unique_users",
            "revenue",
            F.col("best.name").alias("top_product"),
            (-F.col("best.rank")).alias("top_count"),
        )
    )


def start_window_totals(
    events: DataFrame,
    time: str,
    duration: str,
    lateness: str,
    out: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Append each window's totals once the window is closed."""
    totals = window_totals(events, time, duration, lateness).withColumn(
        "window_start", instant_to_wall("window_start")
    )
    writer = totals.writeStream.outputMode("append").format("parquet").option("path", out)
    return triggered(writer, checkpoint, once).start()


def start_user_totals(
    purchases: DataFrame,
    out: str,
    checkpoint: str,
    mode: str = "update",
    once: bool = False,
) -> StreamingQuery:
    """File the running totals of users after every batch.

    ``update`` files the users that changed.  ``complete`` files all users each
    time, which is the whole state again and again: right for a small state.
    """

    def file(changed: DataFrame, batch_id: int) -> None:
        write_batch(changed, out, batch_id)

    writer = user_totals(purchases).writeStream.outputMode(mode).foreachBatch(file)
    return triggered(writer, checkpoint, once).start()


def latest_totals(
    spark: SparkSession, checkpoint: str, batch_id: int | None = None, variable: str | None = None
) -> DataFrame:
    """The totals of all users after a batch, by default the last: ``user, n, revenue``.

    Read from the state in the stream's checkpoint, in either mode; ``variable`` is ``state`` for
    ``custom_state.custom_user_totals``.  What the stream has filed is not read.
    """
    rows = state_at(spark, checkpoint, batch_id, variable)
    return rows.toDF("user", "n", "revenue")
