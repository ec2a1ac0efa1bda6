"""Queries on the online regression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lines import accepted, parse_points
from ..operators.regression import mean_gradient
from ..operators.splits import fold_slices
from ..sources.lines import stream_lines
from ..storage import new_folder, read_batches
from ..streaming.model import start_scoring, start_training
from .inputs import point_lines
from .registry import query
from .replay import replay

WIDTH = 64
STEP = 0.01
BATCHES = 4


def _training_sql(select: str) -> str:
    """One pair of steps a batch: errors under the old weights, then new weights."""
    steps = [
        f"""p AS (
          SELECT vec_id, cast(label AS double) AS y, cast(embedding AS double[]) AS x,
                 (row_number() OVER (ORDER BY vec_id) - 1) * {BATCHES} // count(*) OVER () AS b
          FROM embeddings),
        w0 AS (SELECT list_transform(range({WIDTH}), lambda i: 0.0::double) AS w)"""
    ]
    for batch in range(BATCHES):
        steps.append(
            f"""e{batch} AS (
              SELECT vec_id, y, x, w, list_inner_product(x, w) AS guess
              FROM p, w{batch} WHERE b = {batch}),
            w{batch + 1} AS (
              SELECT list(v ORDER BY j) AS w FROM (
                SELECT j, any_value(w[j]) - {STEP} * avg((guess - y) * x[j]) AS v
                FROM e{batch}, (SELECT unnest(range(1, {WIDTH + 1})) AS j) GROUP BY j))"""
        )
    return f"WITH {', '.join(steps)} {select}"


_WEIGHTS_SQL = _training_sql(
    " UNION ALL ".join(
        f"""SELECT {batch}::bigint AS batch_id, cast(j - 1 AS integer) AS j,
                   round(w[j], 10) + 0.0 AS weight
            FROM w{batch + 1}, (SELECT unnest(range(1, {WIDTH + 1})) AS j)"""
        for batch in range(BATCHES)
    )
)
_PREDICTIONS_SQL = _training_sql(
    " UNION ALL ".join(
        f"""SELECT {batch}::bigint AS batch_id, y AS label, round(guess, 10) + 0.0 AS prediction
            FROM e{batch}"""
        for batch in range(BATCHES)
    )
)


@query(
    """
    SELECT vec_id, cast(label AS double) AS label, len(embedding) AS width,
           round(list_sum(cast(embedding AS double[])), 8) + 0.0 AS total
    FROM embeddings
    """
)
def parse_labelled_points(spark: SparkSession, root: str) -> DataFrame:
    points = accepted(parse_points(point_lines(spark, root), WIDTH))
    total = F.aggregate("features", F.lit(0.0), lambda s, x: s + x)
    return points.select(
        "vec_id",
        "label",
        F.size("features").cast("bigint").alias("width"),
        F.round(total, 8).alias("total"),
    )


@query(
    f"""
    SELECT cast(j - 1 AS integer) AS j,
           round({STEP} * avg(label * cast(embedding[j] AS double)), 10) + 0.0 AS weight
    FROM embeddings, (SELECT unnest(range(1, {WIDTH + 1})) AS j) GROUP BY j
    """
)
def sgd_first_step(spark: SparkSession, root: str) -> DataFrame:
    points = accepted(parse_points(point_lines(spark, root), WIDTH))
    gradient = mean_gradient(points, [0.0] * WIDTH)
    return gradient.select("j", F.round(-STEP * F.col("gradient"), 10).alias("weight"))


def _drops(
    spark: SparkSession, root: str, folder: str, streams: int
) -> list[list[tuple[DataFrame, str]]]:
    """Equal batches by vector id, each spread over the streams by the label."""
    batches = []
    for lines in fold_slices(point_lines(spark, root), "vec_id", BATCHES):
        label = F.substring_index("value", "\t", 1).cast("int")
        target = F.when(label < 5, 0).otherwise(streams - 1)
        batches.append(
            [
                (lines.filter(target == i).select("value"), f"{folder}/lines-{i}")
                for i in range(streams)
            ]
        )
    return batches


def _trained(
    spark: SparkSession,
    root: str,
    streams: int = 1,
    predictions: bool = False,
    folder: str | None = None,
) -> str:
    """Train over all batches; gives the folder of the run."""
    folder = folder or new_folder(spark, "training")

    def start():
        lines = stream_lines(spark, f"{folder}/lines-0")
        for i in range(1, streams):
            lines = lines.unionByName(stream_lines(spark, f"{folder}/lines-{i}"))
        return start_training(
            lines,
            f"{folder}/models",
            f"{folder}/state",
            WIDTH,
            STEP,
            predictions=f"{folder}/predictions" if predictions else None,
            once=True,
        )

    replay(_drops(spark, root, folder, streams), start)
    return folder


def _weights(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_batches(spark, f"{folder}/models")
        .select("batch_id", F.posexplode("weights").alias("j", "weight"))
        .withColumn("weight", F.round("weight", 10))
    )


@query(_WEIGHTS_SQL)
def sgd_stream_weights(spark: SparkSession, root: str) -> DataFrame:
    return _weights(spark, _trained(spark, root))


@query(_WEIGHTS_SQL)
def sgd_two_streams(spark: SparkSession, root: str) -> DataFrame:
    return _weights(spark, _trained(spark, root, streams=2))


@query(_PREDICTIONS_SQL)
def sgd_predictions(spark: SparkSession, root: str) -> DataFrame:
    folder = _trained(spark, root, predictions=True)
    return read_batches(spark, f"{folder}/predictions").select(
        "batch_id", "label", F.round("prediction", 10).alias("prediction")
    )


_SCORING_SQL = _training_sql(
    f"""
    SELECT 0::bigint AS batch_id, y AS label, 0.0::double AS prediction FROM p
    UNION ALL
    SELECT 1::bigint AS batch_id, y AS label,
           round(list_inner_product(x, w), 10) + 0.0 AS prediction
    FROM p, w{BATCHES}
    """
)


@query(_SCORING_SQL)
def sgd_scoring(spark: SparkSession, root: str) -> DataFrame:
    """All points scored before there is a model, and again by the last weights."""
    folder = new_folder(spark, "scoring")
    points = point_lines(spark, root).select("value")

    def start():
        return start_scoring(
            stream_lines(spark, f"{folder}/points"),
            f"{folder}/models",
            f"{folder}/scores",
            f"{folder}/score-state",
            WIDTH,
            once=True,
        )

    replay([[(points, f"{folder}/points")]], start)
    _trained(spark, root, folder=folder)
    replay([[(points, f"{folder}/points")]], start)
    return read_batches(spark, f"{folder}/scores").select(
        "batch_id", "label", F.round("prediction", 10).alias("prediction")
    )
