"""Components of wide sparse rows against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import wide
from millrace.operators.reduction import principal_components


def sparse(spark, matrix, parts=5):
    rows = []
    for row in matrix:
        at = np.flatnonzero(row)
        rows.append((at.tolist(), row[at].tolist()))
    return spark.createDataFrame(rows, "indices array<int>, values array<double>").repartition(parts)


def decaying(n, width, seed=3):
    rnd = np.random.default_rng(seed)
    inner = rnd.standard_normal((n, 12)) * 2.0 ** -np.arange(12)
    matrix = inner @ rnd.standard_normal((12, width)) + 0.001 * rnd.standard_normal((n, width))
    matrix[rnd.random((n, width)) < 0.02] = 0
    matrix[3] = 0  # a row without entries
    return matrix + (matrix != 0) * 0.5


@pytest.mark.parametrize("n, width", [(200, 900), (300, 7)])
def test_like_numpy(spark, n, width):
    matrix = decaying(n, width)
    found = wide.wide_components(sparse(spark, matrix), width, 4, extra=20, rounds=5)
    centred = matrix - matrix.mean(axis=0)
    _, lengths, right = np.linalg.svd(centred, full_matrices=False)
    assert found.count == n and np.allclose(found.mean, matrix.mean(axis=0))
    assert np.allclose(found.variances, lengths[:4] ** 2 / (n - 1), rtol=1e-6)
    assert np.allclose(found.loadings.T @ found.loadings, np.eye(4), atol=1e-10)
    assert np.allclose(abs(np.sum(found.loadings * right[:4].T, axis=0)), 1, atol=1e-4)
    largest = found.loadings[abs(found.loadings).argmax(axis=0), range(4)]
    assert (largest > 0).all()


def test_goes_on_until_variances_are_still(spark):
    rnd = np.random.default_rng(8)
    matrix = rnd.standard_normal((150, 120)) * 0.9 ** np.arange(120)
    found = wide.wide_components(sparse(spark, matrix), 120, 3, extra=6, rounds=1)
    lengths = np.linalg.svd(matrix - matrix.mean(axis=0), compute_uv=False)[:3]
    assert np.allclose(found.variances, lengths**2 / 149, rtol=1e-5)


def test_scores_and_layout(spark):
    matrix = decaying(200, 300)
    one, many = (
        wide.wide_components(sparse(spark, matrix, parts), 300, 3, extra=20, rounds=4)
        for parts in (1, 20)
    )
    assert np.allclose(one.loadings, many.loadings, atol=1e-5)
    scores = [row.scores for row in one.project(sparse(spark, matrix)).collect()]
    expected = (matrix - matrix.mean(axis=0)) @ one.loadings
    assert np.allclose(sorted(scores), sorted(expected.tolist()), atol=1e-9)


def test_like_the_narrow_one(spark, tables):
    points = spark.read.parquet(f"{tables}/embeddings.parquet").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features")
    )
    narrow = principal_components(points, 3)
    found = wide.wide_components(wide.dense_rows(points), 64, 3, extra=61, rounds=1)
    assert np.allclose(found.loadings, narrow.matrix(), atol=1e-6)


def test_few_directions(spark):
    matrix = np.zeros((6, 10))
    matrix[:, 2] = [1, 2, 3, 4, 5, 6]
    found = wide.wide_components(sparse(spark, matrix), 10, 4)
    assert found.loadings.shape == (10, 1) and found.loadings[2, 0] == pytest.approx(1)
    assert found.variances == pytest.approx([3.5])
    again = wide.wide_components(sparse(spark, np.ones((5, 4))), 4, 2)
    assert again.loadings.shape == (4, 0)
    none = wide.wide_components(sparse(spark, matrix).limit(0), 10, 2)
    assert none.count == 0 and none.loadings.shape == (10, 0)
    assert none.project(sparse(spark, matrix).limit(0)).collect() == []


def test_an_index_listed_twice(spark):
    rows = spark.createDataFrame(
        [([0, 0, 1], [1.0, 1.0, 0.0]), ([1], [0.0]), ([0], [4.0])],
        "indices array<int>, values array<double>",
    )
    found = wide.wide_components(rows, 2, 1)
    assert found.variances == pytest.approx([4.0]) and found.mean.tolist() == [2.0, 0.0]


@pytest.mark.parametrize(
    "row", [([9], [1.0]), ([-1], [1.0]), ([0, 1], [1.0]), ([0], [None]), ([0], [float("nan")])]
)
def test_bad_rows(spark, row):
    rows = spark.createDataFrame([row], "indices array<int>, values array<double>")
    with pytest.raises(Exception):
        wide.wide_components(rows, 5, 1)


def test_too_wide(spark):
    rows = spark.createDataFrame([([0], [1.0])], "indices array<int>, values array<double>")
    with pytest.raises(ValueError, match="more than"):
        wide.wide_components(rows, 1 << 24, 2)


def test_lengths_of_documents_are_sums_of_the_group(spark, tables, monkeypatch):
    """A fold over the row beside its entries would run once an entry."""
    from millrace.plans import text

    class Seen(Exception):
        pass

    def seen(rows, _):
        raise Seen(rows._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(text, "stored", seen)
    with pytest.raises(Seen) as plan:
        text.pca_wide(spark, tables)
    assert "transform(" in str(plan.value) and "aggregate(" not in str(plan.value)
