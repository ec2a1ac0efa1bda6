"""Queries that run the tables through Structured Streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import label, wall_to_instant
from ..operators.lines import accepted, parse_purchases
from ..operators.splits import fold_slices
from ..operators.summary import user_totals
from ..sources.lines import stream_lines
from ..storage import new_folder, read_batches, stored, write_batch
from ..streaming.custom_state import custom_user_totals, rocksdb_state
from ..streaming.holdout import holdout_stream, parse_rating_lines
from ..streaming.purchases import (
    latest_totals,
    start_each_batch,
    start_preview,
    start_summaries,
    start_user_totals,
    start_window_totals,
)
from ..streaming.state_reader import kept_batches, state_changes
from .inputs import event_ratings, purchase_lines
from .registry import query
from .replay import replay

BATCHES = 3
LATENESS = "1 hour"

_BATCHED = f"""
    SELECT *, cast((row_number() OVER (ORDER BY event_id) - 1) * {BATCHES}
              // count(*) OVER () AS bigint) AS batch_id FROM events
"""


def _drops(spark: SparkSession, root: str, folder: str) -> list[list[tuple[DataFrame, str]]]:
    """The events as purchase lines, in equal batches by event id."""
    slices = fold_slices(purchase_lines(spark, root), "event_id", BATCHES)
    return [[(lines.select("value"), f"{folder}/lines")] for lines in slices]


@query(
    f"""
    WITH e AS ({_BATCHED}),
    total AS (
      SELECT batch_id, count(*) AS purchases, count(DISTINCT user_id) AS unique_users,
             round(sum(value), 2) AS revenue
      FROM e GROUP BY batch_id),
    best AS (
      SELECT batch_id, event_type, count(*) AS n FROM e GROUP BY batch_id, event_type
      QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY count(*) DESC, event_type) = 1)
    SELECT batch_id, purchases, unique_users, revenue,
           event_type AS top_product, n AS top_count
    FROM total JOIN best USING (batch_id)
    """
)
def per_batch_callback(spark: SparkSession, root: str) -> DataFrame:
    folder = new_folder(spark, "per-batch")
    replay(
        _drops(spark, root, folder),
        lambda: start_summaries(
            stream_lines(spark, f"{folder}/lines"), f"{folder}/out", f"{folder}/state", once=True
        ),
    )
    return read_batches(spark, f"{folder}/out").withColumn("revenue", F.round("revenue", 2))


@query(
    f"""
    WITH e AS (
      SELECT batch_id, cast(user_id AS varchar) || ',' || event_type || ',' || value AS "value"
      FROM ({_BATCHED}))
    SELECT batch_id, "value" FROM e
    QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY "value") <= 10
    """
)
def batch_preview(spark: SparkSession, root: str) -> DataFrame:
    folder = new_folder(spark, "preview")
    replay(
        _drops(spark, root, folder),
        lambda: start_preview(
            stream_lines(spark, f"{folder}/lines"),
            ["value"],
            f"{folder}/out",
            f"{folder}/state",
            once=True,
        ),
    )
    return read_batches(spark, f"{folder}/out")


@query(
    """
    WITH closed AS (
      SELECT max(ts) - INTERVAL 1 HOUR AS until FROM events)
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           count(*) AS purchases, count(DISTINCT user_id) AS unique_users,
           round(sum(value), 2) AS revenue, any_value(best.event_type) AS top_product,
           any_value(n) AS top_count
    FROM events JOIN (
      SELECT day, event_type, n, row_number() OVER (PARTITION BY day ORDER BY n DESC, event_type) AS p
      FROM (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)
    ) best
      ON day = date_trunc('day', ts) AND p = 1
    GROUP BY date_trunc('day', ts)
    HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT until FROM closed)
    """
)
def tumbling_append_stream(spark: SparkSession, root: str) -> DataFrame:
    """Windows of a stream of the table itself; the last ones are still open."""
    schema = spark.read.parquet(f"{root}/events.parquet").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(root)
    ).select(
        wall_to_instant("ts").alias("time"),
        F.col("user_id").alias("user"),
        F.col("event_type").alias("product"),
        F.col("value").alias("price"),
    )
    folder = new_folder(spark, "windows")
    start_window_totals(
        events, "time", "1 day", LATENESS, f"{folder}/out", f"{folder}/state", once=True
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(
        label(F.col("window_start")).alias("window_start"),
        "purchases",
        "unique_users",
        F.round("revenue", 2).alias("revenue"),
        "top_product",
        "top_count",
    )


_USER_TOTALS = """
    SELECT cast(user_id AS varchar) AS "user", count(*) AS n, round(sum(value), 2) AS revenue
    FROM events GROUP BY 1
"""


def _user_state(spark: SparkSession, root: str, mode: str) -> str:
    """Run the running totals over all batches; gives the folder of ``out`` and ``state``."""
    folder = new_folder(spark, f"totals-{mode}")

    def start():
        lines = stream_lines(spark, f"{folder}/lines")
        return start_user_totals(
            accepted(parse_purchases(lines)), f"{folder}/out", f"{folder}/state", mode, once=True
        )

    replay(_drops(spark, root, folder), start)
    return folder


@query(_USER_TOTALS)
def user_state_stream(spark: SparkSession, root: str) -> DataFrame:
    totals = latest_totals(spark, f"{_user_state(spark, root, 'update')}/state")
    return totals.withColumn("revenue", F.round("revenue", 2))


@query(
    f"""
    WITH e AS ({_BATCHED}), b AS (SELECT DISTINCT batch_id FROM e)
    SELECT b.batch_id, cast(user_id AS varchar) AS "user", count(*) AS n,
           round(sum(value), 2) AS revenue
    FROM b JOIN e ON e.batch_id <= b.batch_id GROUP BY ALL
    """
)
def user_state_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The whole state after every batch."""
    snapshots = read_batches(spark, f"{_user_state(spark, root, 'complete')}/out")
    return snapshots.withColumn("revenue", F.round("revenue", 2))


@query(
    f"""
    WITH e AS ({_BATCHED}), b AS (SELECT DISTINCT batch_id FROM e)
    SELECT b.batch_id, cast(user_id AS varchar) AS "user", count(*) AS n,
           round(sum(value), 2) AS revenue
    FROM b JOIN e ON e.batch_id <= b.batch_id GROUP BY ALL
    """
)
def user_state_read(spark: SparkSession, root: str) -> DataFrame:
    """The whole state after every batch, from a stream that files only what changed."""
    checkpoint = f"{_user_state(spark, root, 'update')}/state"
    first, last = kept_batches(spark, checkpoint)
    states = (
        latest_totals(spark, checkpoint, batch_id).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        for batch_id in range(first, last + 1)
    )
    return reduce(DataFrame.unionByName, states).withColumn("revenue", F.round("revenue", 2))


@query(
    f"""
    WITH e AS ({_BATCHED})
    SELECT batch_id, cast(user_id AS varchar) AS "user", round(sum(r) OVER so_far, 2) AS revenue,
           cast(sum(k) OVER so_far AS bigint) AS n
    FROM (SELECT batch_id, user_id, sum(value) AS r, count(*) AS k FROM e GROUP BY ALL)
    WINDOW so_far AS (PARTITION BY user_id ORDER BY batch_id)
    """
)
def user_state_changes(spark: SparkSession, root: str) -> DataFrame:
    """What each batch wrote to the state."""
    checkpoint = f"{_user_state(spark, root, 'update')}/state"
    changes = state_changes(spark, checkpoint, *kept_batches(spark, checkpoint))
    return changes.drop("change").toDF("batch_id", "user", "n", "revenue").withColumn(
        "revenue", F.round("revenue", 2)
    )


def _custom_totals(
    spark: SparkSession, batches: list[DataFrame], initial: DataFrame | None = None
) -> DataFrame:
    """The totals in a custom state after all batches of purchase lines."""
    folder = new_folder(spark, "totals-custom")

    def start():
        lines = stream_lines(spark, f"{folder}/lines")
        totals = custom_user_totals(accepted(parse_purchases(lines)), initial=initial)
        return start_each_batch(
            totals, lambda rows, i: write_batch(rows, f"{folder}/out", i), f"{folder}/state", True, "update"
        )

    with rocksdb_state(spark):
        replay([[(lines.select("value"), f"{folder}/lines")] for lines in batches], start)
    totals = latest_totals(spark, f"{folder}/state", variable="state")
    return totals.withColumn("revenue", F.round("revenue", 2))


@query(_USER_TOTALS)
def user_state_custom(spark: SparkSession, root: str) -> DataFrame:
    return _custom_totals(spark, fold_slices(purchase_lines(spark, root), "event_id", BATCHES))


@query(_USER_TOTALS)
def user_state_from_history(spark: SparkSession, root: str) -> DataFrame:
    """The first half of the events as a batch job, the other half as a stream that goes on from it."""
    events = purchase_lines(spark, root)
    slices = fold_slices(events, "event_id", 4)
    history = user_totals(accepted(parse_purchases(slices[0].unionByName(slices[1]))))
    return _custom_totals(spark, slices[2:], stored(history, "history"))


@query(
    """
    WITH ranked AS (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events)
    SELECT event_id AS pos, user_id, round(value, 2) AS rating,
           CASE WHEN r <= 10 THEN 'test' ELSE 'base' END AS role
    FROM ranked
    """
)
def user_holdout_stream(spark: SparkSession, root: str) -> DataFrame:
    """Rating lines in several batches, each told apart as it arrives."""
    folder = new_folder(spark, "holdout")
    ratings = event_ratings(spark, root)
    line = F.concat_ws("\t", "user_id", "item_id", F.col("rating").cast("string"), "pos")
    drops = [
        [(rows.select(line.alias("value")), f"{folder}/lines")]
        for rows in fold_slices(ratings, "pos", BATCHES)
    ]

    def start():
        arrived = parse_rating_lines(stream_lines(spark, f"{folder}/lines"))
        roles = holdout_stream(arrived, 1, 10)
        return start_each_batch(
            roles, lambda rows, i: write_batch(rows, f"{folder}/out", i), f"{folder}/state", True
        )

    with rocksdb_state(spark):
        replay(drops, start)
    filed = read_batches(spark, f"{folder}/out")
    return filed.select("pos", "user_id", F.round("rating", 2).alias("rating"), "role")
