"""Queries on purchases in tables."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import label
from ..operators import unique
from ..operators.combine import combined_by_key
from ..operators.lines import accepted, by_user, parse_purchases
from ..operators.state import user_totals_history
from ..operators import summary as op
from ..operators.summary import (
    products_by_popularity,
    purchase_summary,
    report_line,
    user_totals,
    with_window,
)
from ..storage import stored
from .inputs import order_purchases, purchase_lines, purchases, table
from .registry import query


def _summary_sql(events: str, key: str) -> str:
    """Summary of ``events(key, usr, product, price)`` by ``key``."""
    return f"""
    WITH e AS ({events}),
    total AS (
      SELECT {key}, count(*) AS purchases, count(DISTINCT usr) AS unique_users,
             round(sum(price), 2) AS revenue
      FROM e GROUP BY {key}),
    best AS (
      SELECT {key}, product, count(*) AS n FROM e GROUP BY {key}, product
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, product) = 1)
    SELECT {key}, purchases, unique_users, revenue,
           product AS top_product, n AS top_count
    FROM total JOIN best USING ({key})
    """


def _windows_sql(unit: str) -> str:
    return _summary_sql(
        f"""SELECT strftime(date_trunc('{unit}', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
                   cast(user_id AS varchar) AS usr, event_type AS product, value AS price
            FROM events""",
        "window_start",
    )


def _windows(spark: SparkSession, root: str, duration: str) -> DataFrame:
    summary = purchase_summary(
        with_window(purchases(spark, root), "ts", duration), ["window_start"]
    )
    return summary.withColumn("window_start", label(F.col("window_start"))).withColumn(
        "revenue", F.round("revenue", 2)
    )


@query(
    """
    SELECT event_id, cast(user_id AS varchar) AS "user", event_type AS product, value AS price
    FROM events
    """
)
def parse_events(spark: SparkSession, root: str) -> DataFrame:
    return accepted(parse_purchases(purchase_lines(spark, root)))


@query(
    """
    SELECT CASE event_type WHEN 'error' THEN 'too few fields' WHEN 'purchase' THEN 'none'
                ELSE 'bad price' END AS problem,
           event_type AS product, count(*) AS lines, count(DISTINCT user_id) AS users
    FROM events GROUP BY 1, 2
    """
)
def malformed_events(spark: SparkSession, root: str) -> DataFrame:
    """Purchases stay whole; each other type of event is broken in its own way."""
    price = F.col("price").cast("string")
    product = F.col("product")
    rest = (
        F.when(product == "error", F.lit(None))
        .when(product == "signup", "abc")
        .when(product == "view", "NaN")
        .when(product == "click", "")
        .otherwise(F.concat(price, F.lit(",extra")))
    )
    lines = purchases(spark, root).select(F.concat_ws(",", "user", "product", rest).alias("value"))
    parsed = parse_purchases(lines)
    return parsed.groupBy(F.coalesce("problem", F.lit("none")).alias("problem"), "product").agg(
        F.count("*").alias("lines"), F.count_distinct("user").alias("users")
    )


@query(
    """
    SELECT cast(user_id AS varchar) AS "user", event_type AS product, value AS price FROM events
    """
)
def events_by_user(spark: SparkSession, root: str) -> DataFrame:
    return by_user(purchases(spark, root)).select("user", "item.product", "item.price")


@query(
    """
    SELECT event_id, cast(user_id AS varchar) || ',' || event_type || ',' || value AS "value"
    FROM events ORDER BY event_id LIMIT 10
    """
)
def first_rows(spark: SparkSession, root: str) -> DataFrame:
    return op.first_rows(purchase_lines(spark, root), ["event_id"])


@query(_windows_sql("day"))
def batch_summary(spark: SparkSession, root: str) -> DataFrame:
    return _windows(spark, root, "1 day")


@query(_windows_sql("hour"))
def tumbling_summary(spark: SparkSession, root: str) -> DataFrame:
    return _windows(spark, root, "1 hour")


@query(
    """
    WITH best AS (
      SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 1)
    SELECT (SELECT count(*) FROM events) AS purchases,
           (SELECT count(DISTINCT user_id) FROM events) AS unique_users,
           (SELECT round(sum(value), 2) FROM events) AS revenue,
           event_type AS top_product, n AS top_count,
           event_type || ' leads with ' || n || ' sold' AS line
    FROM best
    """
)
def whole_summary(spark: SparkSession, root: str) -> DataFrame:
    summary = report_line(purchase_summary(purchases(spark, root)))
    return summary.withColumn("revenue", F.round("revenue", 2))


@query(
    _summary_sql(
        """SELECT strftime(o_orderdate, '%Y-%m') AS month, o_custkey AS usr,
                  l_partkey AS product, l_extendedprice AS price
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "month",
    )
)
def order_summary(spark: SparkSession, root: str) -> DataFrame:
    monthly = order_purchases(spark, root).withColumn("month", F.date_format("ts", "yyyy-MM"))
    return purchase_summary(monthly, ["month"]).withColumn("revenue", F.round("revenue", 2))


@query("SELECT l_partkey AS product, count(*) AS n FROM lineitem GROUP BY 1")
def product_popularity(spark: SparkSession, root: str) -> DataFrame:
    sold = table(spark, root, "lineitem").select(F.col("l_partkey").alias("product"))
    return products_by_popularity(sold)


@query(
    """
    SELECT o_custkey AS "user", count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    """
)
def customer_totals(spark: SparkSession, root: str) -> DataFrame:
    totals = user_totals(order_purchases(spark, root))
    return totals.withColumn("revenue", F.round("revenue", 2))


@query(
    """
    WITH e AS (
      SELECT date_diff('day', DATE '2024-01-01', cast(ts AS date)) AS batch,
             cast(user_id AS varchar) AS "user", value FROM events),
    b AS (SELECT unnest(generate_series(0, (SELECT max(batch) FROM e))) AS batch)
    SELECT cast(b.batch AS integer) AS batch, e."user", count(*) AS n,
           round(sum(e.value), 2) AS revenue
    FROM b JOIN e ON e.batch <= b.batch GROUP BY b.batch, e."user"
    """
)
def user_state_history(spark: SparkSession, root: str) -> DataFrame:
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    history = user_totals_history(purchases(spark, root).withColumn("day", day), "day")
    return history.withColumn("revenue", F.round("revenue", 2))


LONGEST = 30


@query(
    f"""
    WITH seen AS (
      SELECT DISTINCT date_diff('day', DATE '1970-01-01', cast(ts AS date)) AS day, user_id FROM events),
    days AS (SELECT unnest(range((SELECT min(day) FROM seen), (SELECT max(day) + 1 FROM seen))) AS day)
    SELECT a.day AS first, b.day AS last, count(DISTINCT user_id) AS unique_users
    FROM days a JOIN days b ON b.day BETWEEN a.day AND a.day + {LONGEST - 1}
    LEFT JOIN seen ON seen.day BETWEEN a.day AND b.day GROUP BY a.day, b.day
    """
)
def unique_users_ranges(spark: SparkSession, root: str) -> DataFrame:
    """Unique users of every range of 1 to 30 days, from one bitmap file a day."""
    events = purchases(spark, root).withColumn("day", F.unix_date(F.to_date("ts")))
    # Users are numbered half by half, as later ones would be beside those already filed.
    early = unique.number_users(events.filter(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    numbers = early.unionByName(unique.number_users(events, early))
    bitmaps = stored(unique.window_bitmaps(events, numbers, "day"), "bitmaps")
    spans = unique.window_spans(bitmaps, LONGEST)
    days = bitmaps.agg(F.min("window").alias("low"), F.max("window").alias("high"))
    ranges = days.select("high", F.explode(F.sequence("low", "high")).alias("first")).select(
        "first", F.explode(F.sequence("first", F.least(F.col("first") + LONGEST - 1, "high"))).alias("last")
    )
    return unique.unique_in_ranges(spans, ranges)


def dearest(rows: pa.Table) -> pa.Table:
    """Merge function: each user's three products with the highest price, ties by name."""
    best = rows.group_by(["user", "product"]).aggregate([("price", "max")])
    best = best.rename_columns({"price_max": "price"}).sort_by(
        [("user", "ascending"), ("price", "descending"), ("product", "ascending")]
    )
    users = best["user"].combine_chunks()
    if len(best) < 4:
        return best
    # The fourth row on after a row of the same user is none of its first three.
    same = pc.fill_null(pc.equal(users[3:], users[:-3]), False)
    null = pc.and_(pc.is_null(users[3:]), pc.is_null(users[:-3]))
    beyond = pa.concat_arrays([pa.array([False] * 3), pc.or_(same, null)])
    return best.filter(pc.invert(beyond))


@query(
    """
    WITH p AS (
      SELECT o_custkey AS "user", l_partkey AS product, max(l_extendedprice) AS price
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT "user", product, price FROM p
    QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY price DESC, product) <= 3
    """
)
def dearest_products(spark: SparkSession, root: str) -> DataFrame:
    """Three products of each customer by a merge function of its own."""
    rows = order_purchases(spark, root).select("user", "product", "price")
    return combined_by_key(rows, ["user"], dearest)
