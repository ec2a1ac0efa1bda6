"""Image files as rows of pixel values."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


@F.arrow_udf(ArrayType(DoubleType()))
def _rgb(data: pa.Array, channels: pa.Array) -> pa.Array:
    """Stored bytes as numbers, blue-green-red turned to red-green-blue."""
    rows = []
    for raw, depth in zip(data, channels):
        pixels = np.frombuffer(raw.as_buffer(), dtype="uint8").astype("float64")
        if depth.as_py() >= 3:
            pixels = pixels.reshape(-1, depth.as_py())
            pixels = pixels[:, [2, 1, 0, *range(3, depth.as_py())]].ravel()
        rows.append(pixels)
    return pa.array(rows, type=pa.list_(pa.float64()))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """``image_id string, height int, width int, channels int, pixels array<double>``.

    Pixels are in row-major order, the channels of a pixel side by side.
    Files that are no image are left out, as Spark's image source does with
    ``dropInvalid``.
    """
    files = (
        spark.read.format("image")
        .option("dropInvalid", True)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    image = F.col("image")
    return files.select(
        image["origin"].alias("image_id"),
        image["height"].alias("height"),
        image["width"].alias("width"),
        image["nChannels"].alias("channels"),
        _rgb(image["data"], image["nChannels"]).alias("pixels"),
    )
