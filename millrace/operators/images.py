"""Grayscale, resize and flatten for images held as one row each.

An image is ``height, width, channels, pixels``, the pixels row by row with the
channels of a pixel side by side.  Each step works inside the row, so nothing
is shuffled however many images there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of red, green and blue in the gray value (ITU-R BT.601).
RED, GREEN, BLUE = 0.299, 0.587, 0.114


def grayscale(images: DataFrame) -> DataFrame:
    """One gray channel out of three or four (a fourth, opacity, is ignored)."""

    def gray(i: Column) -> Column:
        first = (i * F.col("channels")).cast("int")
        red, green, blue = (F.get("pixels", first + c) for c in range(3))
        return RED * red + GREEN * green + BLUE * blue

    count = F.col("height") * F.col("width")
    pixels = F.when(F.col("channels") == 1, F.col("pixels")).otherwise(
        F.transform(F.sequence(F.lit(0), count - 1), gray)
    )
    return images.withColumn("pixels", pixels).withColumn("channels", F.lit(1))


def resize(images: DataFrame, height: int, width: int) -> DataFrame:
    """Shrink one-channel images to ``height`` x ``width`` by the mean of blocks.

    Target row ``y`` is the mean of the source rows from ``y * h div height`` to
    before ``(y + 1) * h div height``; columns alike.  Each block holds at least
    one pixel as long as the image is not smaller than the target.
    """

    def limits(index: Column, source: str, target: int) -> tuple[Column, Column]:
        start = F.floor(index * F.col(source) / target).cast("int")
        end = F.floor((index + 1) * F.col(source) / target).cast("int")
        return start, end

    def block_mean(cell: Column) -> Column:
        top, bottom = limits(F.floor(cell / width), "height", height)
        left, right = limits(cell % width, "width", width)
        rows = F.transform(
            F.sequence(top, bottom - 1),
            lambda y: F.aggregate(
                F.slice("pixels", y * F.col("width") + left + 1, right - left),
                F.lit(0.0),
                lambda total, x: total + x,
            ),
        )
        total = F.aggregate(rows, F.lit(0.0), lambda s, x: s + x)
        return total / ((bottom - top) * (right - left))

    cells = F.sequence(F.lit(0), F.lit(height * width - 1))
    return (
        images.withColumn("pixels", F.transform(cells, block_mean))
        .withColumn("height", F.lit(height))
        .withColumn("width", F.lit(width))
    )


def resize_weighted(images: DataFrame, height: int, width: int) -> DataFrame:
    """Images at any other size, larger or smaller, by shares of area.

    A target pixel is the mean of the source area that it covers, a source pixel counting with the
    part of it that lies inside.  Along the width first, then along the height: each is a
    product with a small sparse matrix, whose weights are whole numbers over the source's size, so
    the weights of a pixel add up to 1.  Channels stay; an image without pixels has none after.
    """

    def along(pixels: Column, lines: Column, source: Column, target: int, step: Column) -> Column:
        """Shrink or stretch ``lines`` lines of ``source`` groups of ``step`` values each."""
        size = F.lit(target)

        def cell(at: Column) -> Column:
            line = F.call_function("div", at, size * step)
            place = F.call_function("div", at % (size * step), step)
            inside = at % step
            low, high = place * source, (place + 1) * source
            taps = F.sequence(
                F.call_function("div", low, size), F.call_function("div", high - 1, size)
            )

            def added(total: Column, tap: Column) -> Column:
                overlap = F.least(high, (tap + 1) * size) - F.greatest(low, tap * size)
                index = (line * source + tap) * step + inside
                return total + overlap * F.get(pixels, index.cast("int"))

            return F.aggregate(taps, F.lit(0.0), added) / source

        cells = F.sequence(F.lit(0).cast("bigint"), (lines * size * step - 1).cast("bigint"))
        return F.transform(cells, cell)

    h, w, c = (F.col(name).cast("bigint") for name in ("height", "width", "channels"))
    pixels = F.col("pixels").cast("array<double>")
    narrow = along(pixels, h, w, width, c)
    # Bound as a variable, so that the first product is computed once.
    both = F.transform(
        F.array(narrow), lambda half: along(half, F.lit(1), h, height, c * width)
    )[0]
    return (
        images.withColumn("pixels", F.when(F.col("pixels").isNotNull(), both))
        .withColumn("height", F.lit(height))
        .withColumn("width", F.lit(width))
    )


def as_matrix(images: DataFrame, column: str = "matrix") -> DataFrame:
    """Add the pixels as a matrix of rows of pixels of channel values."""

    def pixel(y: Column, x: Column) -> Column:
        first = (y * F.col("width") + x) * F.col("channels")
        return F.slice("pixels", first + 1, F.col("channels"))

    rows = F.transform(
        F.sequence(F.lit(0), F.col("height") - 1),
        lambda y: F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda x: pixel(y, x)),
    )
    return images.withColumn(column, rows)


def flatten(images: DataFrame, matrix: str = "matrix", column: str = "features") -> DataFrame:
    """Add a pixel matrix as one vector, in row-major order."""
    return images.withColumn(column, F.flatten(F.flatten(matrix)))


def pixel_rows(images: DataFrame, id: str = "image_id") -> DataFrame:
    """One row for each channel value: ``id, y, x, channel, value``."""
    row_size = F.col("width") * F.col("channels")
    return images.select(id, "width", "channels", F.posexplode("pixels").alias("at", "value")).select(
        id,
        F.floor(F.col("at") / row_size).cast("int").alias("y"),
        F.floor(F.col("at") % row_size / F.col("channels")).cast("int").alias("x"),
        (F.col("at") % F.col("channels")).alias("channel"),
        "value",
    )
