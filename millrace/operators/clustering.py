"""K-means: assignment, one Lloyd step, cost, and the best of several runs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import matrix, nearest
from ..storage import stored

# Bounds are compared with this much room, so that rounding cannot hide a nearer centre.
_ROOM = 1e-9

INIT_MODES = ("k-means||", "random")


def assign(vectors: DataFrame, centres: np.ndarray, features: str = "features") -> DataFrame:
    """Add ``cluster`` and ``d2``, the closest centre and its squared distance.

    A map-only step: the k x d centres travel with the function and nothing is
    joined or shuffled.
    """
    return vectors.withColumn("_near", nearest(F.col(features), centres)).select(
        *vectors.columns, "_near.cluster", "_near.d2"
    )


def cluster_means(assigned: DataFrame, features: str = "features") -> DataFrame:
    """``cluster, j, value``: the mean of each coordinate in each cluster.

    Each task folds its Arrow batches into one sum a cluster and coordinate, so
    neither the rows nor the size of a cluster matter to the shuffle.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(1)
            points = matrix(vectors, len(vectors[0]))
            clusters, own = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            for k, cluster in enumerate(clusters.tolist()):
                mine = points[own == k]
                sums[cluster] = sums.get(cluster, 0.0) + mine.sum(axis=0)
                counts[cluster] = counts.get(cluster, 0) + len(mine)
        for cluster, total in sums.items():
            d = len(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(d, cluster), pa.int32()),
                    pa.array(np.arange(d), pa.int32()),
                    pa.array(total, pa.float64()),
                    pa.array(np.full(d, counts[cluster]), pa.int64()),
                ],
                names=["cluster", "j", "total", "n"],
            )

    rows = assigned.select(F.col("cluster").cast("int"), F.col(features).cast("array<double>"))
    sums = rows.mapInArrow(fold, "cluster int, j int, total double, n bigint")
    return sums.groupBy("cluster", "j").agg(
        (F.sum("total") / F.sum("n")).alias("value")
    )


def centres_from(means: DataFrame, previous: np.ndarray) -> np.ndarray:
    """Collect k x d means; a cluster that lost all its points keeps its centre."""
    centres = np.array(previous, dtype="float64")
    for cluster, j, value in means.select("cluster", "j", "value").collect():
        centres[cluster, j] = value
    return centres


def cost(assigned: DataFrame) -> DataFrame:
    """The sum of squared distances to the assigned centres: ``cost``."""
    return assigned.agg(F.sum("d2").alias("cost"))


def lloyd(
    vectors: DataFrame, centres: np.ndarray, steps: int, features: str = "features"
) -> np.ndarray:
    """The centres after ``steps`` rounds of assignment and averaging."""
    for _ in range(steps):
        means = cluster_means(assign(vectors, centres, features), features)
        centres = centres_from(means, centres)
    return centres


class BoundedRun(NamedTuple):
    """``rows`` are the vectors with ``cluster`` and ``distances``, those computed for each so far."""

    centres: np.ndarray
    rows: DataFrame


def lloyd_bounded(
    vectors: DataFrame, centres: np.ndarray, steps: int, features: str = "features"
) -> BoundedRun:
    """The centres of ``lloyd`` with far fewer distances (Hamerly, 2010).

    Each row keeps a bound above the distance to its centre and one below that to any other
    centre, filed with the row between the steps.  When centres move, the bounds move by
    as much, and while they do not meet, the row stays without a distance computed.  The
    assignments are those of ``assign``, ties included, and the centres are the same up to the order
    in which rows are added up.  ``cluster`` is that of the last assignment.

    Worth its written rows where centres are many or wide; the first step computes all distances.
    """
    centres = np.asarray(centres, dtype="float64")
    rows = vectors.withColumns(
        {
            "cluster": F.lit(-1),
            "_upper": F.lit(float("inf")),
            "_lower": F.lit(0.0),
            "distances": F.lit(0).cast("bigint"),
        }
    )
    moved = np.zeros(len(centres))
    for _ in range(steps):
        kept = _bounds(F.col(features), centres, moved)
        after = rows.withColumn("_kept", kept).select(
            *vectors.columns,
            "_kept.cluster",
            F.col("_kept.upper").alias("_upper"),
            F.col("_kept.lower").alias("_lower"),
            (F.col("distances") + F.col("_kept.computed")).alias("distances"),
        )
        rows = stored(after, "bounds")
        new = centres_from(cluster_means(rows, features), centres)
        moved, centres = np.sqrt(np.square(new - centres).sum(axis=1)), new
    return BoundedRun(centres, rows.drop("_upper", "_lower"))


def _bounds(vector: Column, centres: np.ndarray, moved: np.ndarray) -> Column:
    """``struct<cluster, upper, lower, computed>`` from the bounds at the centres before."""
    k = len(centres)
    apart = np.sqrt(np.square(centres[:, None] - centres[None]).sum(axis=2))
    apart[np.arange(k), np.arange(k)] = np.inf
    half = apart.min(axis=1) / 2
    order = np.argsort(moved)
    farthest = moved[order[-1]] if k else 0.0
    second = moved[order[-2]] if k > 1 else 0.0

    @F.arrow_udf("struct<cluster int, upper double, lower double, computed bigint>")
    def kept(vectors: pa.Array, clusters: pa.Array, uppers: pa.Array, lowers: pa.Array) -> pa.Array:
        cluster = clusters.to_numpy(zero_copy_only=False).copy()
        upper = uppers.to_numpy(zero_copy_only=False).copy()
        lower = lowers.to_numpy(zero_copy_only=False).copy()
        computed = np.zeros(len(cluster), dtype="int64")
        if len(cluster):
            points = matrix(vectors, centres.shape[1])
            upper += moved[cluster]
            lower -= np.where(cluster == order[-1], second, farthest)
            # Another centre is at least as far as this; one's own is meant where cluster is set.
            least = np.maximum(lower, np.where(cluster >= 0, half[cluster], 0.0))
            open_ = np.flatnonzero(~(upper * (1 + _ROOM) < least))
            known = open_[cluster[open_] >= 0]
            gap = points[known] - centres[cluster[known]]
            upper[known] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            computed[known] += 1
            open_ = open_[~(upper[open_] * (1 + _ROOM) < least[open_])]
            best, next_ = np.full(len(open_), np.inf), np.full(len(open_), np.inf)
            nearest_ = np.zeros(len(open_), dtype="int32")
            for index, centre in enumerate(centres):
                gap = points[open_] - centre
                d2 = np.einsum("ij,ij->i", gap, gap)
                closer = d2 < best
                next_ = np.where(closer, best, np.minimum(next_, d2))
                nearest_[closer] = index
                best[closer] = d2[closer]
            cluster[open_], upper[open_], lower[open_] = nearest_, np.sqrt(best), np.sqrt(next_)
            computed[open_] += k
        return pa.StructArray.from_arrays(
            [pa.array(cluster.astype("int32")), pa.array(upper), pa.array(lower), pa.array(computed)],
            names=["cluster", "upper", "lower", "computed"],
        )

    return kept(vector, F.col("cluster"), F.col("_upper"), F.col("_lower"))


class Run(NamedTuple):
    init_mode: str
    seed: int
    cost: float
    model: KMeansModel


def training_runs(
    vectors: DataFrame,
    k: int,
    seeds: Iterable[int],
    init_modes: Sequence[str] = INIT_MODES,
    max_iter: int = 20,
    features: str = "features",
) -> list[Run]:
    """One fitted model for each start, from best to worst.

    Runs are compared by the cost under their final centres, all of them in one
    pass.  The model's own training cost is that of the centres before the last update.
    """
    points = vectors.select(F.col(features).alias("features")).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        prepared = points.select(array_to_vector("features").alias("features"))
        starts = [(init_mode, seed) for init_mode in init_modes for seed in seeds]
        models = [
            KMeans(k=k, initMode=init_mode, seed=seed, maxIter=max_iter).fit(prepared)
            for init_mode, seed in starts
        ]
        near = [nearest(F.col("features"), np.array(model.clusterCenters())) for model in models]
        totals = points.agg(*(F.sum(one["d2"]) for one in near)).first()
    finally:
        points.unpersist()
    runs = [Run(*start, total, model) for start, total, model in zip(starts, totals, models)]
    return sorted(runs, key=lambda run: run.cost)
