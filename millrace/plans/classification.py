"""Queries on text classification: the quality label from the words."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify as op
from ..operators import terms
from ..operators.splits import fold_pair
from ..storage import stored
from .inputs import labelled_documents
from .registry import query

TEST_FOLD = 4

_MODEL = f"""
    docs AS (
      SELECT doc_id, text, quality AS label,
             (row_number() OVER (ORDER BY doc_id) - 1) * 5 // count(*) OVER () = {TEST_FOLD} AS test
      FROM documents JOIN labels USING (doc_id)),
    tf AS (
      SELECT doc_id, test, label, term, count(*) AS tf FROM (
        SELECT doc_id, test, label, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS term
        FROM docs) GROUP BY ALL),
    counts AS (SELECT term, label, sum(tf) AS n FROM tf WHERE NOT test GROUP BY ALL),
    vocab AS (SELECT DISTINCT term FROM counts),
    sizes AS (SELECT label, sum(n) AS tokens FROM counts GROUP BY label),
    classes AS (
      SELECT label, tokens, ln(documents / sum(documents) OVER ()) AS prior
      FROM (SELECT label, count(*) AS documents FROM docs WHERE NOT test GROUP BY label)
      JOIN sizes USING (label)),
    chance AS (
      SELECT term, c.label, prior,
             ln((coalesce(n, 0) + 1) / (tokens + (SELECT count(*) FROM vocab))) AS l
      FROM vocab CROSS JOIN classes c LEFT JOIN counts USING (term, label)),
    gains AS (
      SELECT doc_id, chance.label, sum(tf.tf * l) AS gain
      FROM tf JOIN chance USING (term) WHERE test GROUP BY ALL),
    scores AS (
      SELECT d.doc_id, d.label, c.label AS class, prior + coalesce(gain, 0) AS score
      FROM docs d CROSS JOIN classes c
      LEFT JOIN gains g ON g.doc_id = d.doc_id AND g.label = c.label WHERE test),
    predicted AS (
      SELECT doc_id, label, class AS prediction FROM scores
      QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class) = 1)
"""


def _split(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return fold_pair(labelled_documents(spark, root), "doc_id", TEST_FOLD)


def _tf(documents: DataFrame) -> DataFrame:
    return terms.term_frequency(terms.tokens(documents))


def _model(train: DataFrame) -> op.NaiveBayes:
    return op.train_naive_bayes(_tf(train), train.select("doc_id", "label"))


def _predicted(spark: SparkSession, root: str) -> DataFrame:
    train, test = _split(spark, root)
    scores = op.naive_bayes_scores(_model(train), _tf(test), test)
    return op.best_class(scores).join(test.select("doc_id", "label"), "doc_id")


@query(
    f"""
    WITH {_MODEL}
    SELECT term, label, round(l, 8) AS log_likelihood FROM chance JOIN counts USING (term, label)
    """
)
def naive_bayes_loglik(spark: SparkSession, root: str) -> DataFrame:
    train, _ = _split(spark, root)
    model = _model(train)
    return op.term_log_likelihood(model).withColumn(
        "log_likelihood", F.round("log_likelihood", 8)
    )


@query(f"WITH {_MODEL} SELECT doc_id, class AS label, round(score, 4) AS score FROM scores")
def naive_bayes_scores(spark: SparkSession, root: str) -> DataFrame:
    train, test = _split(spark, root)
    scores = op.naive_bayes_scores(_model(train), _tf(test), test)
    return scores.withColumn("score", F.round("score", 4))


@query(f"WITH {_MODEL} SELECT doc_id, prediction FROM predicted")
def naive_bayes_predict(spark: SparkSession, root: str) -> DataFrame:
    return _predicted(spark, root).select("doc_id", "prediction")


@query(f"WITH {_MODEL} SELECT label, prediction, count(*) AS n FROM predicted GROUP BY ALL")
def confusion(spark: SparkSession, root: str) -> DataFrame:
    return op.confusion(_predicted(spark, root))


@query(
    f"""
    WITH {_MODEL},
    seen AS (SELECT label AS class FROM predicted UNION SELECT prediction FROM predicted),
    sums AS (
      SELECT class, count(*) FILTER (label = class) AS labelled,
             count(*) FILTER (prediction = class) AS predicted,
             count(*) FILTER (label = class AND prediction = class) AS correct
      FROM seen CROSS JOIN predicted GROUP BY class)
    SELECT *, round(correct / nullif(predicted, 0), 8) AS precision,
           round(correct / nullif(labelled, 0), 8) AS recall FROM sums
    """
)
def class_quality(spark: SparkSession, root: str) -> DataFrame:
    quality = op.class_quality(_predicted(spark, root))
    return quality.withColumns({c: F.round(c, 8) for c in ("precision", "recall")})


@query(
    f"WITH {_MODEL} SELECT round(avg((label = prediction)::int), 8) AS accuracy FROM predicted"
)
def naive_bayes_accuracy(spark: SparkSession, root: str) -> DataFrame:
    return op.accuracy(_predicted(spark, root)).select(F.round("accuracy", 8).alias("accuracy"))


@query(
    f"""
    WITH {_MODEL},
    margins AS (
      SELECT doc_id, label, round(max(score) FILTER (class = 1) - max(score) FILTER (class = 0), 6)
               AS margin FROM scores GROUP BY doc_id, label),
    ranked AS (
      SELECT label, rank() OVER (ORDER BY margin)
             + (count(*) OVER (PARTITION BY margin) - 1) / 2.0 AS place FROM margins)
    SELECT round((sum(place) FILTER (label = 1) - n1 * (n1 + 1) / 2) / (n1 * n0), 6)
             AS area_under_roc
    FROM ranked, (SELECT count(*) FILTER (label = 1)::DOUBLE AS n1,
                         count(*) FILTER (label = 0)::DOUBLE AS n0 FROM margins)
    GROUP BY n1, n0
    """
)
def naive_bayes_auc(spark: SparkSession, root: str) -> DataFrame:
    """Exact area under the curve of the margin between the two classes."""
    train, test = _split(spark, root)
    scores = op.naive_bayes_scores(_model(train), _tf(test), test)
    sides = {label: F.max(F.when(F.col("label") == label, F.col("score"))) for label in (0, 1)}
    margins = scores.groupBy("doc_id").agg(F.round(sides[1] - sides[0], 6).alias("rawPrediction"))
    area = op.area_under_roc(margins.join(test.select("doc_id", "label"), "doc_id"))
    return margins.limit(1).select(F.lit(round(area, 6)).alias("area_under_roc"))


#: Fitted logistic models by application and folder: the queries below share one fit.
_FITTED: dict[tuple[str, str], PipelineModel] = {}


def _logistic(spark: SparkSession, root: str) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The model, and the rows it is fitted on and tested with."""
    train, test = _split(spark, root)
    key = (spark.sparkContext.applicationId, root)
    if key not in _FITTED:
        _FITTED[key] = op.train_logistic(train)
    return _FITTED[key], train, test


@query()
def logistic_confusion(spark: SparkSession, root: str) -> DataFrame:
    """Logistic regression on the same split."""
    model, _, test = _logistic(spark, root)
    predicted = op.apply_logistic(model, test)
    return op.confusion(predicted.withColumn("prediction", F.col("prediction").cast("int")))


@query()
def logistic_auc(spark: SparkSession, root: str) -> DataFrame:
    """How well each of the two labels is told apart: share of test rows and exact area."""
    model, _, test = _logistic(spark, root)
    scored = op.apply_logistic(model, test)
    predicted = stored(scored.select("label", "rawPrediction"), "predicted")
    area = op.area_under_roc(predicted)
    return predicted.groupBy("label").agg(
        F.count("*").alias("documents"), F.max(F.lit(area)).alias("area_under_roc")
    )


@query(
    f"""
    WITH docs AS (
      SELECT quality AS label,
             (row_number() OVER (ORDER BY doc_id) - 1) * 5 // count(*) OVER () = {TEST_FOLD} AS test
      FROM documents JOIN labels USING (doc_id))
    SELECT count(*) AS documents, sum(label)::DOUBLE AS expected_ones, 0.0::DOUBLE AS steepest
    FROM docs WHERE NOT test
    """
)
def logistic_slopes(spark: SparkSession, root: str) -> DataFrame:
    """The fitted model is the minimum: chances add up to the labels, and no slope is left."""
    model, train, _ = _logistic(spark, root)
    found = op.logistic_slopes(model, train)
    return found.select(
        "documents",
        F.round("expected_ones").alias("expected_ones"),
        F.round("steepest", 2).alias("steepest"),
    )
