"""Lloyd steps with bounds against plain ones, and images at any size against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import clustering, images


@pytest.mark.parametrize("k, spread", [(1, 1), (2, 3), (12, 40)])
def test_the_centres_of_lloyd(spark, k, spread):
    """Coordinates are whole numbers, so sums are exact and centres equal bit for bit."""
    rnd = np.random.default_rng(k)
    middle = rnd.integers(-spread, spread + 1, (k, 3))
    data = middle[rnd.integers(0, k, 600)] + rnd.integers(-4, 5, (600, 3))
    points = spark.createDataFrame(
        [(i, [float(x) for x in row]) for i, row in enumerate(data)], "id int, features array<double>"
    ).repartition(4)
    start = data[:k].astype(float)  # copies among them make ties
    if k > 2:
        start[1] = start[0]
    for steps in (1, 6):
        run = clustering.lloyd_bounded(points, start, steps)
        assert np.array_equal(run.centres, clustering.lloyd(points, start, steps))
    before = clustering.lloyd(points, start, 5)
    plain = {r.id: r.cluster for r in clustering.assign(points, before).collect()}
    assert {r.id: r.cluster for r in run.rows.collect()} == plain
    computed = run.rows.agg(F.sum("distances")).first()[0]
    assert computed < 600 * k * 6 or k == 1
    if k == 12:
        assert computed < 0.6 * 600 * k * 6


def test_bounded_on_nothing(spark):
    none = spark.createDataFrame([], "features array<double>")
    run = clustering.lloyd_bounded(none, np.array([[0.0], [1.0]]), 2)
    assert run.centres.tolist() == [[0.0], [1.0]] and run.rows.collect() == []


def weights(source, target):
    """The matrix of one side: how much of each source pixel a target pixel covers."""
    found = np.zeros((target, source))
    for i in range(target):
        for t in range(source):
            low, high = max(i * source, t * target), min((i + 1) * source, (t + 1) * target)
            found[i, t] = max(high - low, 0) / source
    return found


@pytest.mark.parametrize("height, width", [(1, 1), (3, 5), (7, 4), (14, 9)])
def test_resize_to_any_size(spark, height, width):
    rnd = np.random.default_rng(height)
    sizes = [(7, 4, 1), (5, 6, 3), (1, 1, 4)]
    pictures = [rnd.random(size) for size in sizes]
    rows = [(i, *size, p.ravel().tolist()) for i, (size, p) in enumerate(zip(sizes, pictures))]
    table = spark.createDataFrame(
        rows, "image_id int, height int, width int, channels int, pixels array<double>"
    )
    for row in images.resize_weighted(table, height, width).collect():
        picture = pictures[row.image_id]
        expected = np.einsum(
            "yt,txc,zx->yzc", weights(picture.shape[0], height), picture, weights(picture.shape[1], width)
        )
        assert (row.height, row.width) == (height, width)
        assert np.allclose(row.pixels, expected.ravel(), atol=1e-12)


def test_whole_blocks_are_the_block_means(spark):
    table = spark.createDataFrame(
        [(1, 4, 6, 1, [float(i * i) for i in range(24)]), (2, 4, 6, 1, None)],
        "image_id int, height int, width int, channels int, pixels array<double>",
    )
    one, two = (
        {r.image_id: r.pixels for r in f(table, 2, 3).collect()}
        for f in (images.resize, images.resize_weighted)
    )
    assert two[1] == pytest.approx(one[1]) and two[2] is None
