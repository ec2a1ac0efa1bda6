"""Queries on dense vectors: clusters, covariance, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clustering, reduction
from ..storage import stored
from .inputs import vectors
from .registry import query

_POINTS = """
    p AS (SELECT vec_id, label, cast(embedding AS double[]) AS x FROM embeddings),
    c AS (
      SELECT label AS cluster, list(m ORDER BY j) AS centre FROM (
        SELECT label, j, avg(x[j]) AS m
        FROM p, (SELECT unnest(range(1, 65)) AS j) GROUP BY label, j) GROUP BY label),
    near AS (
      SELECT vec_id, x, cluster, d2 FROM (
        SELECT vec_id, x, cluster,
               list_sum(list_transform(range(1, 65), lambda j: (x[j] - centre[j]) ** 2)) AS d2
        FROM p, c)
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) = 1)
"""


def _label_centres(points: DataFrame) -> np.ndarray:
    """The mean vector of each label, as starting centres."""
    k = points.agg(F.max("label")).first()[0] + 1
    width = F.max(F.size("features"))
    d = points.agg(width).first()[0]
    means = clustering.cluster_means(points.withColumn("cluster", F.col("label")))
    return clustering.centres_from(means, np.zeros((k, d)))


def _assigned(spark: SparkSession, root: str) -> DataFrame:
    points = vectors(spark, root)
    return clustering.assign(points, _label_centres(points))


@query(f"WITH {_POINTS} SELECT vec_id, cluster, round(d2, 8) AS d2 FROM near")
def kmeans_assign(spark: SparkSession, root: str) -> DataFrame:
    return _assigned(spark, root).select("vec_id", "cluster", F.round("d2", 8).alias("d2"))


@query(f"WITH {_POINTS} SELECT round(sum(d2), 6) AS cost FROM near")
def kmeans_cost(spark: SparkSession, root: str) -> DataFrame:
    return clustering.cost(_assigned(spark, root)).select(F.round("cost", 6).alias("cost"))


@query(
    f"""
    WITH {_POINTS}
    SELECT cluster, cast(j - 1 AS integer) AS j, round(avg(x[j]), 8) + 0.0 AS value
    FROM near, (SELECT unnest(range(1, 65)) AS j) GROUP BY cluster, j
    """
)
def kmeans_lloyd_step(spark: SparkSession, root: str) -> DataFrame:
    means = clustering.cluster_means(_assigned(spark, root))
    return means.withColumn("value", F.round("value", 8))


@query()
def kmeans_best_of_runs(spark: SparkSession, root: str) -> DataFrame:
    """Two ways to start and three seeds each; the best run assigns the vectors."""
    points = vectors(spark, root)
    best = clustering.training_runs(points, k=10, seeds=(1, 2, 3))[0]
    centres = np.array(best.model.clusterCenters())
    return clustering.assign(points, centres).select("vec_id", "cluster", "d2")


@query(
    """
    WITH v AS (
      SELECT vec_id, unnest(range(64)) AS j, unnest(cast(embedding AS double[])) AS x
      FROM embeddings)
    SELECT cast(a.j AS integer) AS i, cast(b.j AS integer) AS j,
           round(covar_samp(a.x, b.x), 10) + 0.0 AS covariance
    FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.j <= b.j GROUP BY a.j, b.j
    """
)
def covariance(spark: SparkSession, root: str) -> DataFrame:
    return reduction.covariance(vectors(spark, root)).withColumn(
        "covariance", F.round("covariance", 10)
    )


@query(
    """
    WITH v AS (
      SELECT vec_id, unnest(range(64)) AS j, unnest(cast(embedding AS double[])) AS x
      FROM embeddings)
    SELECT vec_id, round(sum(gap * gap), 8) AS length2
    FROM (SELECT vec_id, x - avg(x) OVER (PARTITION BY j) AS gap FROM v) GROUP BY vec_id
    """
)
def pca_lengths(spark: SparkSession, root: str) -> DataFrame:
    """With all components kept, scores are as long as the centred vectors."""
    points = vectors(spark, root)
    scored = reduction.principal_components(points, 64).project(points)
    length2 = F.aggregate("scores", F.lit(0.0), lambda s, x: s + x * x)
    return scored.select("vec_id", F.round(length2, 8).alias("length2"))


@query()
def pca_scores(spark: SparkSession, root: str) -> DataFrame:
    points = vectors(spark, root)
    scored = reduction.principal_components(points, 3).project(points)
    return scored.select("vec_id", F.posexplode("scores").alias("component", "score"))


@query()
def pca_variance(spark: SparkSession, root: str) -> DataFrame:
    """The variance along each component, from the scores of all vectors."""
    points = vectors(spark, root)
    scored = reduction.principal_components(points, 3).project(points)
    return (
        scored.select(F.posexplode("scores").alias("component", "score"))
        .groupBy("component")
        .agg(F.var_samp("score").alias("variance"))
    )


@query(
    """
    SELECT m.init_mode, s.seed, true AS not_cheaper
    FROM (VALUES ('k-means||'), ('random')) m(init_mode), (VALUES (1), (2), (3)) s(seed)
    WHERE EXISTS (FROM embeddings)
    """
)
def kmeans_runs(spark: SparkSession, root: str) -> DataFrame:
    """Each run, and whether the best one's assignment is as cheap as its cost says."""
    points = vectors(spark, root)
    runs = clustering.training_runs(points, k=10, seeds=(1, 2, 3))
    centres = np.array(runs[0].model.clusterCenters())
    least = clustering.cost(clustering.assign(points, centres))
    costs = spark.createDataFrame(
        [(run.init_mode, run.seed, run.cost) for run in runs],
        "init_mode string, seed int, cost double",
    )
    cheapest = least.select(F.round("cost", 6)).scalar()
    return costs.select("init_mode", "seed", (F.round("cost", 6) >= cheapest).alias("not_cheaper"))


@query(
    """
    WITH v AS (
      SELECT unnest(range(64)) AS j, unnest(cast(embedding AS double[])) AS x FROM embeddings)
    SELECT cast(c AS integer) AS component, 0.0::double AS residual, 1.0::double AS length,
           (SELECT round(sum(s), 6) FROM (SELECT var_samp(x) AS s FROM v GROUP BY j)) AS whole
    FROM range(3) r(c)
    """
)
def pca_residuals(spark: SparkSession, root: str) -> DataFrame:
    """How far each component is from one of the covariance, relative to its variance.

    ``whole`` is the sum of the variances along all components.
    """
    points = vectors(spark, root)
    square = np.zeros((64, 64))
    for i, j, value in reduction.covariance(points).collect():  # d * (d + 1) / 2 rows
        square[i, j] = square[j, i] = value
    fitted = reduction.principal_components(points, 64)
    loadings = fitted.matrix()
    scores = stored(
        fitted.project(points).select(F.posexplode("scores").alias("component", "score")), "scores"
    )
    along = scores.groupBy("component").agg(F.var_samp("score").alias("variance"))
    variances = {row["component"]: row["variance"] for row in along.collect()}
    rows = []
    for k in range(3):
        own = loadings[:, k]
        off = np.linalg.norm(square @ own - variances[k] * own) / variances[k]
        rows.append((k, round(float(off), 6) + 0.0, round(float(own @ own), 8)))
    frame = spark.createDataFrame(rows, "component int, residual double, length double")
    return frame.withColumn("whole", along.select(F.round(F.sum("variance"), 6)).scalar())


STEPS = 14


def _lloyd_sql(steps: int) -> str:
    parts = []
    for s in range(steps):
        parts.append(
            f"""n{s} AS MATERIALIZED (
      SELECT vec_id, x, cluster FROM (
        SELECT vec_id, x, cluster,
               list_sum(list_transform(range(1, 65), lambda j: (x[j] - centre[j]) ** 2)) AS d2
        FROM p, c{s})
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d2, cluster) = 1),
    c{s + 1} AS MATERIALIZED (
      SELECT cluster, list(m ORDER BY j) AS centre FROM (
        SELECT cluster, j, avg(x[j]) AS m
        FROM n{s}, (SELECT unnest(range(1, 65)) AS j) GROUP BY cluster, j) GROUP BY cluster
      UNION ALL SELECT cluster, centre FROM c{s} WHERE cluster NOT IN (SELECT cluster FROM n{s}))"""
        )
    return ",\n    ".join(parts)


@query(
    f"""
    WITH p AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE) / 256) AS x
      FROM embeddings),
    c0 AS (
      SELECT label AS cluster, list(m ORDER BY j) AS centre FROM (
        SELECT label, j, avg(x[j]) AS m
        FROM p, (SELECT unnest(range(1, 65)) AS j) GROUP BY label, j) GROUP BY label),
    {_lloyd_sql(STEPS)}
    SELECT cluster, cast(j AS integer) AS j, centre[j + 1] AS value, true AS spared
    FROM c{STEPS}, (SELECT unnest(range(64)) AS j)
    """
)
def kmeans_bounded(spark: SparkSession, root: str) -> DataFrame:
    """The centres after some steps, and whether fewer than all distances were computed.

    Coordinates are whole 256ths, so sums are exact in any order.
    """
    points = vectors(spark, root).withColumn(
        "features", F.transform("features", lambda x: F.floor(256 * x).cast("double") / 256)
    )
    start = _label_centres(points)
    run = clustering.lloyd_bounded(points, start, STEPS)
    rows = [(c, j, float(v)) for c, own in enumerate(run.centres) for j, v in enumerate(own)]
    counted = run.rows.agg((F.sum("distances") < F.count("*") * STEPS * len(start)).alias("spared"))
    centres = spark.createDataFrame(rows, "cluster bigint, j int, value double")
    return centres.withColumn("spared", counted.scalar())
