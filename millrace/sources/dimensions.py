"""Small delimited files that describe a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import field, fields


def _nonblank(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter(F.trim("value") != "")


def read_genres(spark: SparkSession, path: str) -> DataFrame:
    """``name|id`` lines: ``genre string, genre_id int``."""
    part = fields(F.col("value"), "|")
    return _nonblank(spark, path).select(
        field(part, 0).alias("genre"), field(part, 1).try_cast("int").alias("genre_id")
    )


def read_occupations(spark: SparkSession, path: str) -> DataFrame:
    """One value a line: ``occupation string``."""
    return _nonblank(spark, path).select(F.col("value").alias("occupation"))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``count label`` lines: ``n bigint, label string``; a check for an ingest."""
    part = fields(F.col("value"), " ")
    return _nonblank(spark, path).select(
        field(part, 0).try_cast("bigint").alias("n"), field(part, 1).alias("label")
    )
