"""Tab-separated ratings whose file order matters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.parsing import field, fields, first_word, number
from ..storage import stored


def parse_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Every line: ``value, user_id bigint, item_id bigint, rating double, pos bigint, problem``.

    The user is the first word of the line, item and rating are its second and
    third field between tabs.  ``problem`` names the first of them that is
    missing or no number, and is null for a good line.  ``pos`` counts all lines
    from 0 in (file, line) order.
    """
    part = fields(F.col("value"), "\t")
    parsed = numbered_lines(spark, path).select(
        "value",
        first_word(F.col("value")).try_cast("bigint").alias("user_id"),
        field(part, 1).try_cast("bigint").alias("item_id"),
        number(field(part, 2)).alias("rating"),
        "pos",
    )
    problem = (
        F.when(F.col("user_id").isNull(), "bad user")
        .when(F.col("item_id").isNull(), "bad item")
        .when(F.col("rating").isNull(), "bad rating")
    )
    return parsed.withColumn("problem", problem)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``user_id bigint, item_id bigint, rating double, pos bigint`` of the good lines.

    ``read_bad_ratings`` has the others.
    """
    good = parse_ratings(spark, path).filter("problem IS NULL")
    return good.select("user_id", "item_id", "rating", "pos")


def read_bad_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``pos, value, problem`` of the lines that hold no rating."""
    return parse_ratings(spark, path).filter("problem IS NOT NULL").select(
        "pos", "value", "problem"
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value string, pos bigint``: lines with their global position.

    Spark reads a file in blocks.  The line ids grow by one inside a block, so
    a line's position is the number of lines in earlier blocks plus its offset
    from the first id of its own block.  The files are read once, and the lines
    filed with block and id: counts and lines cannot disagree, whatever block
    size another scan would choose.  Only one row a block is put in order.
    """
    lines = stored(
        spark.read.text(path).select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
        ),
        "lines",
    )
    earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("file", "block")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .select(
            "file",
            "block",
            "first_id",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lines_before"),
        )
    )
    return lines.join(stored(blocks, "blocks"), ["file", "block"]).select(
        "value", (F.col("lines_before") + F.col("id") - F.col("first_id")).alias("pos")
    )
