"""Text as lines, in batch and as a stream, and text as whole files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line under ``path``: ``value string``."""
    return spark.read.text(path)


def stream_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the files that arrive in a drop folder, as a stream.

    The streaming operators take any frame with a ``value`` column, so a Kafka
    source cast to string fits in the same place.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_whole_files(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """One row a file, subfolders included: ``path string, content string``.

    Text that is not UTF-8 is read as bytes and decoded with ``charset``.
    """
    if charset.upper() in ("UTF-8", "UTF8"):
        files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
        content = F.col("value")
    else:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        )
        content = F.decode(F.col("content"), charset)
    return files.select(F.col("_metadata.file_path").alias("path"), content.alias("content"))
