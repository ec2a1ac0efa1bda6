"""Clusters, covariance, components and factors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import clustering, recommend, reduction
from millrace.plans.inputs import part_ratings, vectors

POINTS = [(1, [0.0, 0.0]), (2, [0.0, 2.0]), (3, [10.0, 0.0]), (4, [10.0, 2.0])]
CENTRES = np.array([[0.0, 0.0], [10.0, 0.0]])


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(POINTS, "id bigint, features array<double>").repartition(3)


def test_assign_and_cost(points):
    assigned = clustering.assign(points, CENTRES)
    found = {(r["id"], r["cluster"], r["d2"]) for r in assigned.collect()}
    assert found == {(1, 0, 0.0), (2, 0, 4.0), (3, 1, 0.0), (4, 1, 4.0)}
    assert clustering.cost(assigned).first()[0] == 8


def test_a_tie_goes_to_the_first_centre(spark):
    middle = spark.createDataFrame([(1, [5.0, 0.0])], "id bigint, features array<double>")
    assert clustering.assign(middle, CENTRES).first()["cluster"] == 0


def test_lloyd_step(points):
    centres = clustering.lloyd(points, CENTRES, 1)
    assert centres.tolist() == [[0, 1], [10, 1]]
    assert clustering.cost(clustering.assign(points, centres)).first()[0] == 4


def test_an_empty_cluster_keeps_its_centre(points):
    centres = clustering.lloyd(points, np.array([[5.0, 1.0], [500.0, 500.0]]), 2)
    assert centres.tolist() == [[5, 1], [500, 500]]


def test_cost_never_rises(spark, tables):
    data = vectors(spark, tables).cache()
    centres = np.array([r["features"] for r in data.orderBy("vec_id").limit(6).collect()])
    costs = []
    for _ in range(4):
        costs.append(clustering.cost(clustering.assign(data, centres)).first()[0])
        centres = clustering.lloyd(data, centres, 1)
    assert costs == sorted(costs, reverse=True)


def test_best_run_is_the_cheapest(spark, tables):
    data = vectors(spark, tables)
    runs = clustering.training_runs(data, k=5, seeds=(1, 2), max_iter=5)
    assert [(r.init_mode, r.seed) for r in sorted(runs)] == [
        ("k-means||", 1), ("k-means||", 2), ("random", 1), ("random", 2)
    ]
    assert runs[0].cost == min(run.cost for run in runs)
    own = clustering.assign(data, np.array(runs[0].model.clusterCenters()))
    assert clustering.cost(own).first()[0] == pytest.approx(runs[0].cost)


def covariances(frame):
    return {(r["i"], r["j"]): r["covariance"] for r in reduction.covariance(frame).collect()}


def test_covariance(points):
    assert covariances(points) == {
        (0, 0): pytest.approx(100 / 3), (0, 1): pytest.approx(0), (1, 1): pytest.approx(4 / 3)
    }


def test_covariance_far_from_the_origin(spark):
    generator = np.random.default_rng(3)
    x = generator.normal(size=(500, 4)) + 1e7
    frame = spark.createDataFrame([([float(v) for v in row],) for row in x], "features array<double>")
    expected = np.cov(x, rowvar=False)
    found = covariances(frame.repartition(7))
    assert len(found) == 10
    for (i, j), value in found.items():
        assert value == pytest.approx(expected[i, j], abs=1e-6)


def test_covariance_of_nothing_and_of_one_vector(points):
    assert covariances(points.filter("id > 9")) == {}
    assert set(covariances(points.filter("id = 1")).values()) == {None}


def test_components(spark, tables):
    data = vectors(spark, tables)
    fitted = reduction.principal_components(data, 5)
    loadings = fitted.matrix()
    assert np.allclose(loadings.T @ loadings, np.eye(5), atol=1e-9)
    assert all(column[np.abs(column).argmax()] > 0 for column in loadings.T)
    x = np.array([r["features"] for r in data.orderBy("vec_id").collect()])
    scores = np.array([r["scores"] for r in fitted.project(data).orderBy("vec_id").collect()])
    assert np.allclose(scores, (x - x.mean(axis=0)) @ loadings, atol=1e-9)
    largest = np.sort(np.linalg.eigvalsh(np.cov(x, rowvar=False)))[::-1][:5]
    assert np.allclose(scores.var(axis=0, ddof=1), largest, atol=1e-9)


def test_projection_keeps_the_other_columns(spark, points):
    scored = reduction.principal_components(points, 1).project(points)
    assert scored.columns == ["id", "features", "scores"]
    assert scored.count() == 4


def test_factors_repeat_and_rank(spark, tables):
    ratings = part_ratings(spark, tables).cache()
    model = recommend.factorise(ratings, rank=4, iterations=3, seed=7)
    top = recommend.top_items(model, 3)
    users = ratings.select("user_id").distinct()
    assert top.count() == 3 * users.count()
    rows = top.orderBy("user_id", "place").collect()
    assert [r["place"] for r in rows[:3]] == [1, 2, 3]
    assert rows[0]["score"] >= rows[1]["score"] >= rows[2]["score"]
    few = recommend.top_items(model, 3, users.filter("user_id < 20"))
    assert few.count() == 3 * users.filter("user_id < 20").count()
    again = recommend.factorise(ratings, rank=4, iterations=3, seed=7)
    error = F.abs(F.col("prediction") - F.col("rating"))
    first, second = (m.transform(ratings).agg(F.avg(error)).first()[0] for m in (model, again))
    assert first == pytest.approx(second, rel=1e-3)
    mean = ratings.agg(F.avg("rating")).first()[0]
    assert first < ratings.agg(F.avg(F.abs(F.col("rating") - mean))).first()[0]
    ratings.unpersist()


def test_uneven_vectors_are_an_error(spark):
    for bad in ([[1.0, 2.0, 3.0], [4.0]], [[1.0, 2.0], None], [[1.0, None], [1.0, 2.0]]):
        frame = spark.createDataFrame([(x,) for x in bad], "features array<double>").coalesce(1)
        with pytest.raises(Exception, match="a vector"):
            clustering.assign(frame, np.zeros((2, 2))).collect()
        with pytest.raises(Exception, match="a vector"):
            reduction.covariance(frame).collect()
