"""Covariance and principal components."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import constant, matrix


def covariance(vectors: DataFrame, features: str = "features") -> DataFrame:
    """The sample covariance in long form: ``i, j, covariance`` for ``i <= j``.

    Each task folds its Arrow batches into one d x d block and emits that, so
    the shuffle carries d * (d + 1) / 2 rows a task and never pairs of
    coordinates a vector.  Values are taken relative to one vector of the table,
    which changes no covariance and keeps the sums small.
    """
    first = vectors.select(features).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], "i int, j int, covariance double")
    origin = np.asarray(first[0], dtype="float64")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        total = np.zeros(len(origin))
        products = np.zeros((len(origin), len(origin)))
        for batch in batches:
            if batch.num_rows:
                points = matrix(batch.column(0), len(origin)) - origin
                n += len(points)
                total += points.sum(axis=0)
                products += points.T @ points
        if n:
            i, j = np.triu_indices(len(origin))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(i, pa.int32()),
                    pa.array(j, pa.int32()),
                    pa.array(np.full(len(i), n), pa.int64()),
                    pa.array(total[i]),
                    pa.array(total[j]),
                    pa.array(products[i, j]),
                ],
                names=["i", "j", "n", "sum_i", "sum_j", "sum_ij"],
            )

    schema = "i int, j int, n bigint, sum_i double, sum_j double, sum_ij double"
    sums = vectors.select(features).mapInArrow(blocks, schema).groupBy("i", "j").agg(
        *(F.sum(name).alias(name) for name in ("n", "sum_i", "sum_j", "sum_ij"))
    )
    spread = F.col("sum_ij") - F.col("sum_i") * F.col("sum_j") / F.col("n")
    return sums.select(
        "i", "j", F.when(F.col("n") > 1, spread / (F.col("n") - 1)).alias("covariance")
    )


class Components(NamedTuple):
    """A fitted projection; ``signs`` makes the direction of each one definite."""

    centring: StandardScalerModel
    pca: PCAModel
    signs: np.ndarray

    def matrix(self) -> np.ndarray:
        """d x k, one component a column; its largest entry is positive."""
        return self.pca.pc.toArray() * self.signs

    def project(self, vectors: DataFrame, features: str = "features") -> DataFrame:
        """Add ``scores``, the coordinates of the centred vector."""
        prepared = vectors.withColumn("_vector", array_to_vector(features))
        scored = self.pca.transform(self.centring.transform(prepared))
        signed = F.zip_with(
            vector_to_array("_scores"), constant(self.signs), lambda score, sign: score * sign
        )
        return scored.withColumn("scores", signed).drop("_vector", "_centred", "_scores")


def principal_components(vectors: DataFrame, k: int, features: str = "features") -> Components:
    """The first ``k`` components; only the d x d decomposition is on the driver.

    ``PCAModel.transform`` does not centre, so that is a step of its own.
    """
    prepared = vectors.select(array_to_vector(features).alias("_vector"))
    centring = StandardScaler(
        inputCol="_vector", outputCol="_centred", withMean=True, withStd=False
    ).fit(prepared)
    pca = PCA(k=k, inputCol="_centred", outputCol="_scores").fit(centring.transform(prepared))
    loadings = pca.pc.toArray()
    largest = loadings[np.abs(loadings).argmax(axis=0), np.arange(k)]
    return Components(centring, pca, np.where(largest < 0, -1.0, 1.0))
