"""Queries on vectors seen as images: 8 x 8 gray, or 4 x 4 with four channels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import images as op
from ..sources.images import read_images
from ..storage import new_folder
from .inputs import vectors
from .registry import query

_VALUES = """
    v AS (
      SELECT vec_id AS image_id, unnest(range(64)) AS pos, unnest(cast(embedding AS double[])) AS v
      FROM embeddings)
"""


def _images(spark: SparkSession, root: str, side: int, channels: int) -> DataFrame:
    return vectors(spark, root).select(
        F.col("vec_id").alias("image_id"),
        F.lit(side).alias("height"),
        F.lit(side).alias("width"),
        F.lit(channels).alias("channels"),
        F.col("features").alias("pixels"),
    )


def _rounded(images: DataFrame) -> DataFrame:
    return op.pixel_rows(images).select("image_id", "y", "x", F.round("value", 8).alias("value"))


@query(
    f"""
    WITH {_VALUES}
    SELECT image_id, cast(pos // 16 AS integer) AS y, cast(pos % 16 // 4 AS integer) AS x,
           round(sum(v * [0.299, 0.587, 0.114, 0][pos % 4 + 1]), 8) + 0.0 AS "value"
    FROM v GROUP BY ALL
    """
)
def grayscale(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(op.grayscale(_images(spark, root, 4, 4)))


@query(
    f"""
    WITH {_VALUES}
    SELECT image_id, cast(pos // 8 // 2 AS integer) AS y, cast(pos % 8 // 2 AS integer) AS x,
           round(avg(v), 8) + 0.0 AS "value"
    FROM v GROUP BY ALL
    """
)
def block_resize(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(op.resize(_images(spark, root, 8, 1), 4, 4))


#: Sizes that do not divide 8, smaller and larger.
SIZES = [(3, 5), (11, 6)]


def _axis(target: str, source: int) -> str:
    """The share ``w`` of source pixel ``t`` in target pixel ``i`` along one side."""
    return f"""(
      SELECT s.{target} AS size, i, t,
             (least((i + 1) * {source}, (t + 1) * s.{target})
              - greatest(i * {source}, t * s.{target})) / {source} AS w
      FROM sizes s, (SELECT unnest(range(20)) AS i), (SELECT unnest(range({source})) AS t)
      WHERE i < s.{target} AND least((i + 1) * {source}, (t + 1) * s.{target})
            > greatest(i * {source}, t * s.{target}))"""


@query(
    f"""
    WITH {_VALUES},
    sizes(h, w) AS (VALUES {", ".join(f"({h}, {w})" for h, w in SIZES)}),
    down AS {_axis("h", 8)}, across AS {_axis("w", 8)}
    SELECT image_id, s.h AS height, cast(a.i AS integer) AS y, cast(b.i AS integer) AS x,
           round(sum(v * a.w * b.w), 8) + 0.0 AS "value"
    FROM sizes s JOIN down a ON a.size = s.h JOIN across b ON b.size = s.w
    JOIN v ON pos // 8 = a.t AND pos % 8 = b.t GROUP BY ALL
    """
)
def resize_weighted(spark: SparkSession, root: str) -> DataFrame:
    """8 x 8 images at sizes that do not divide theirs."""
    images = _images(spark, root, 8, 1)
    sized = (
        _rounded(op.resize_weighted(images, h, w)).withColumn("height", F.lit(h)) for h, w in SIZES
    )
    return reduce(DataFrame.unionByName, sized)


@query(
    f"""
    WITH {_VALUES}
    SELECT image_id, cast(pos AS integer) AS pos, v AS "value" FROM v
    """
)
def flatten(spark: SparkSession, root: str) -> DataFrame:
    vectors = op.flatten(op.as_matrix(_images(spark, root, 4, 4)))
    return vectors.select("image_id", F.posexplode("features").alias("pos", "value"))


#: Vectors in an image file, each a row of 64 pixels.
_ROWS = 16


def _number(value: int, size: int) -> str:
    return value.to_bytes(size, "little").decode("ascii")


def _bitmap(height: Column, pixels: Column) -> Column:
    """An uncompressed image file of 64 pixels a row, as text: all its bytes are below 128.

    ``pixels`` has blue, green and red of each pixel, the lowest row first.
    """
    # The format's two headers, of 14 and 40 bytes.  The file's size is
    # any that is large enough for 127 rows.
    before = "BM" + _number(0x7F7F, 4) + _number(0, 4) + _number(54, 4) + _number(40, 4) + _number(64, 4)
    after = _number(0, 3) + _number(1, 2) + _number(24, 2) + _number(0, 24)
    return F.concat(F.lit(before), F.chr(height), F.lit(after), pixels)


@query(
    f"""
    WITH placed AS (
      SELECT vec_id // {_ROWS} AS image_id, cast(embedding AS double[]) AS v,
             cast(row_number() OVER (PARTITION BY vec_id // {_ROWS} ORDER BY vec_id) - 1 AS integer) AS y
      FROM embeddings),
    gray AS (
      SELECT image_id, y, unnest(range(64)) AS x,
             unnest(list_transform(v, lambda e: least(126, greatest(0, floor((e + 1) * 63))))) AS g
      FROM placed)
    SELECT image_id, y, cast(x AS integer) AS x, cast(unnest(range(3)) AS integer) AS channel,
           unnest([126 - g, floor(g / 2), g])::DOUBLE AS "value"
    FROM gray
    """
)
def image_files(spark: SparkSession, root: str) -> DataFrame:
    """Sixteen vectors to an image file, written and read again as pixels."""
    gray = F.transform(
        "features",
        lambda e: F.least(F.lit(126), F.greatest(F.lit(0), F.floor((e + 1) * 63))).cast("int"),
    )
    # The file has blue first, and the last row first.
    pixel = lambda g: F.concat(F.chr(g), F.chr(F.floor(g / 2)), F.chr(126 - g))
    line = F.array_join(F.transform(gray, pixel), "")
    images = (
        vectors(spark, root)
        .select(F.expr(f"vec_id div {_ROWS}").alias("image"), "vec_id", line.alias("line"))
        .groupBy("image")
        .agg(F.sort_array(F.collect_list(F.struct("vec_id", "line")), asc=False).alias("lines"))
    )
    pixels = F.array_join(F.transform("lines", lambda row: row["line"]), "")
    path = new_folder(spark, "images")
    images.select("image", _bitmap(F.size("lines"), pixels).alias("value")).write.partitionBy(
        "image"
    ).text(path)
    number = F.regexp_extract("image_id", r"/image=(\d+)/", 1).cast("bigint")
    return op.pixel_rows(read_images(spark, path).withColumn("image_id", number))
