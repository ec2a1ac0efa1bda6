"""Least-squares regression by gradient steps, and its predictions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import constant, dot, matrix

#: Fixed value: the size of a gradient step unless stated otherwise.
STEP_SIZE = 0.01


def mean_gradient(points: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``j int, gradient double``: mean of ``(w.x - y) * x`` for each feature.

    Each task folds its Arrow batches into one sum a feature.
    """
    model = np.asarray(weights, dtype="float64")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(len(model))
        for batch in batches:
            x = matrix(batch.column(1), len(model))
            total += (x @ model - batch.column(0).to_numpy(zero_copy_only=False)) @ x
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(model)), pa.int32()),
                    pa.array(total),
                    pa.array(np.full(len(model), n), pa.int64()),
                ],
                names=["j", "total", "n"],
            )

    rows = points.select(F.col("label").cast("double"), F.col("features").cast("array<double>"))
    sums = rows.mapInArrow(fold, "j int, total double, n bigint")
    return sums.groupBy("j").agg((F.sum("total") / F.sum("n")).alias("gradient"))


def gradient_step(
    points: DataFrame, weights: Sequence[float], step: float = STEP_SIZE
) -> list[float]:
    """The weights after one full-batch step; unchanged when there are no points.

    One number a feature reaches the driver.
    """
    updated = [float(w) for w in weights]
    for j, gradient in mean_gradient(points, weights).collect():
        updated[j] -= step * gradient
    return updated


def predict(
    points: DataFrame, weights: Sequence[float], column: str = "prediction"
) -> DataFrame:
    """Add the prediction ``w.x``; needs ``features`` only, a label is optional."""
    return points.withColumn(column, dot(F.col("features"), constant(weights)))
