"""Labelled points, gradient steps and the online model."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators.lines import accepted, parse_points, quarantined
from millrace.operators.regression import gradient_step, mean_gradient, predict
from millrace.sources.lines import stream_lines
from millrace.storage import read_batches
from millrace.streaming.model import (
    latest_weights,
    load_weights,
    predict_stream,
    start_scoring,
    start_training,
)

BATCHES = [["1.0\t1,0", "2.0\t0,2"], ["0.0\t1,1"]]
WEIGHTS = [[0.005, 0.02], [0.00475, 0.01975], [0.00475, 0.01975]]


def lines(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def points(spark, texts, width=2):
    return accepted(parse_points(lines(spark, texts), width))


def drop(spark, texts, folder):
    lines(spark, texts).coalesce(1).write.mode("append").text(folder)


@pytest.mark.parametrize(
    "line, problem",
    [
        ("1.0\t1,0", None),
        ("1.0\t 1 ,0", None),
        ("1.0", "too few fields"),
        ("", "too few fields"),
        ("x\t1,0", "bad label"),
        ("1.0\t1,0,3", "wrong length"),
        ("1.0\t1", "wrong length"),
        ("1.0\t1,", "bad feature"),
        ("1.0\t1,NaN", "bad feature"),
    ],
)
def test_parse_point(spark, line, problem):
    assert parse_points(lines(spark, [line]), 2).first()["problem"] == problem


def test_quarantined_points(spark):
    bad = quarantined(parse_points(lines(spark, ["1.0\t1,0,3", "1\t1,1"]), 2)).collect()
    assert [tuple(row) for row in bad] == [("1.0\t1,0,3", "wrong length")]


def test_steps(spark):
    weights = [0.0, 0.0]
    for texts, expected in zip([*BATCHES, []], WEIGHTS):
        weights = gradient_step(points(spark, texts), weights)
        assert weights == pytest.approx(expected, abs=1e-15)


def test_gradient_against_numpy(spark):
    generator = np.random.default_rng(5)
    x, y, w = generator.normal(size=(40, 6)), generator.normal(size=40), generator.normal(size=6)
    frame = spark.createDataFrame(
        [(float(label), [float(v) for v in row]) for label, row in zip(y, x)],
        "label double, features array<double>",
    )
    found = dict(mean_gradient(frame.repartition(5), list(w)).collect())
    expected = x.T @ (x @ w - y) / 40
    assert [found[j] for j in range(6)] == pytest.approx(list(expected))


def test_predictions_need_no_label(spark):
    frame = spark.createDataFrame([([1.0, 1.0],), ([0.0, 2.0],)], "features array<double>")
    scored = predict_stream(frame, [0.005, 0.02]).orderBy("prediction").collect()
    assert [row["prediction"] for row in scored] == pytest.approx([0.025, 0.04])
    assert predict(frame, [1.0, 0.0]).columns == ["features", "prediction"]


def _train(spark, folder, **options):
    streams = [stream_lines(spark, f"{folder}/lines")]
    if options.pop("second", False):
        streams.append(stream_lines(spark, f"{folder}/more"))
    union = streams[0] if len(streams) == 1 else streams[0].unionByName(streams[1])
    query = start_training(
        union, f"{folder}/models", f"{folder}/state", width=2, once=True, **options
    )
    query.awaitTermination()


@pytest.mark.parametrize("predict_first", [True, False])
def test_training_on_a_stream(spark, folder, predict_first):
    """Restarted before every batch; the third has no good line."""
    for texts in (*BATCHES, ["1.0\t1,2,3"]):
        drop(spark, texts, f"{folder}/lines")
        _train(
            spark,
            folder,
            predictions=f"{folder}/predictions",
            predict_first=predict_first,
            quarantine=f"{folder}/bad",
        )
    for batch_id, expected in enumerate(WEIGHTS):
        assert load_weights(spark, f"{folder}/models", batch_id) == pytest.approx(expected)
    scored = read_batches(spark, f"{folder}/predictions").orderBy("batch_id", "label").collect()
    expected = [0, 0, 0.025] if predict_first else [0.005, 0.04, 0.0245]
    assert [row["prediction"] for row in scored] == pytest.approx(expected)
    assert read_batches(spark, f"{folder}/bad").select("batch_id").collect() == [(2,)]


def test_training_on_two_streams(spark, folder):
    drop(spark, BATCHES[0][:1], f"{folder}/lines")
    drop(spark, BATCHES[0][1:], f"{folder}/more")
    _train(spark, folder, second=True)
    assert load_weights(spark, f"{folder}/models", 0) == pytest.approx(WEIGHTS[0])


def test_scoring_beside_training(spark, folder):
    assert latest_weights(spark, f"{folder}/models", 2) == [0.0, 0.0]
    for texts in BATCHES:
        drop(spark, texts, f"{folder}/lines")
        _train(spark, folder)
    assert latest_weights(spark, f"{folder}/models") == pytest.approx(WEIGHTS[1])
    drop(spark, ["5.0\t2,4", "bad"], f"{folder}/new")
    start_scoring(
        stream_lines(spark, f"{folder}/new"),
        f"{folder}/models",
        f"{folder}/scores",
        f"{folder}/score-state",
        width=2,
        once=True,
    ).awaitTermination()
    row = read_batches(spark, f"{folder}/scores").first()
    assert (row["label"], row["prediction"]) == (5.0, pytest.approx(2 * 0.00475 + 4 * 0.01975))


def test_weights_come_nearer_to_the_truth(spark):
    generator = np.random.default_rng(7)
    truth = np.array([1.0, -2.0, 0.5])
    x = generator.normal(size=(300, 3))
    frame = spark.createDataFrame(
        [(float(row @ truth), [float(v) for v in row]) for row in x],
        "label double, features array<double>",
    ).cache()
    weights, gaps = [0.0] * 3, []
    for _ in range(5):
        weights = gradient_step(frame, weights, step=0.3)
        gaps.append(float(np.linalg.norm(np.array(weights) - truth)))
    frame.unpersist()
    assert gaps == sorted(gaps, reverse=True) and gaps[-1] < 0.6
    assert frame.select(F.size("features")).first()[0] == 3
