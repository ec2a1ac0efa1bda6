"""A linear model that is trained and applied batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.lines import accepted, parse_points, quarantined
from ..operators.regression import STEP_SIZE, gradient_step, predict
from .purchases import start_each_batch
from ..storage import filed_batches, write_batch

#: Fixed value: the number of features unless stated otherwise.
WIDTH = 100


def save_weights(
    spark: SparkSession, models: str, batch_id: int, weights: Sequence[float]
) -> None:
    """File the weights a batch led to: ``weights array<double>``."""
    row = [([float(w) for w in weights],)]
    write_batch(spark.createDataFrame(row, "weights array<double>"), models, batch_id)


def load_weights(spark: SparkSession, models: str, batch_id: int) -> list[float]:
    """The weights filed for a batch."""
    return list(spark.read.parquet(f"{models}/batch_id={batch_id}").first()["weights"])


def latest_weights(spark: SparkSession, models: str, width: int = WIDTH) -> list[float]:
    """The weights of the newest batch, zeros before the first one.

    Only names of folders are listed, and one folder is read.  Training beside
    this may write a batch anew just then; the one before it is taken instead.
    """
    for batch_id in filed_batches(spark, models):
        try:
            return load_weights(spark, models, batch_id)
        except (PySparkException, Py4JJavaError, TypeError):
            continue
    return [0.0] * width


def start_training(
    lines: DataFrame,
    models: str,
    checkpoint: str,
    width: int = WIDTH,
    step: float = STEP_SIZE,
    predictions: str | None = None,
    predict_first: bool = True,
    quarantine: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Take one gradient step on every batch of labelled points, from zero weights.

    Weights are filed under the batch they come from, and a batch starts from
    those of the batch before.  A restart therefore goes on where the job
    stopped and a repeated batch gives the same weights again.  To train on
    several streams, pass their union.

    With ``predictions``, each batch is also scored: before training on it, so
    that the points are new to the model, or after with ``predict_first=False``.
    """

    def train(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = parse_points(batch, width)
        if predictions or quarantine:  # more than one pass over the batch
            parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            points = accepted(parsed)
            before = load_weights(spark, models, batch_id - 1) if batch_id else [0.0] * width
            after = gradient_step(points, before, step)
            if predictions:
                write_batch(
                    predict(points, before if predict_first else after), predictions, batch_id
                )
            if quarantine:
                write_batch(quarantined(parsed), quarantine, batch_id)
            save_weights(spark, models, batch_id, after)
        finally:
            parsed.unpersist()

    return start_each_batch(lines, train, checkpoint, once)


def start_scoring(
    lines: DataFrame,
    models: str,
    out: str,
    checkpoint: str,
    width: int = WIDTH,
    once: bool = False,
) -> StreamingQuery:
    """File the predictions for every batch of labelled points by the newest weights.

    Training may go on beside it, in a query of its own, or begin later: until
    its first batch the weights are zeros.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        weights = latest_weights(batch.sparkSession, models, width)
        write_batch(predict(accepted(parse_points(batch, width)), weights), out, batch_id)

    return start_each_batch(lines, score, checkpoint, once)


def predict_stream(points: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Score a stream of rows with ``features`` by fixed weights."""
    return predict(points, weights)
