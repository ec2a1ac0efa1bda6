"""From raw documents to training pieces, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's documents.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact, language, minhash, mixing, pieces, quality
from millrace.llm.bits import without
from millrace.llm.queries import MIX_WEIGHTS, domain, table
from millrace.storage import stored

#: Share of the tokens left after the duplicates that the mixture takes.
SHARE = 0.8


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, calls good."""
    labels = table(spark, sf_dir, "labels").filter(~language.held_out())
    model = quality.learn(docs, labels)
    return quality.good_only(docs, model)


def once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact.exact_dedup(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return minhash.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a mixture of sources, each at most once."""
    rows = docs.select("doc_id", "text", "lang", "source").withColumn("domain", domain())
    chosen = mixing.mix(rows, ("domain", "lang", "source"), MIX_WEIGHTS, share=SHARE)
    taken = chosen.select(F.col("doc_id").alias("taken"))
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL")
    gone = ids.join(taken, F.col("doc_id") == F.col("taken"), "left_anti")
    return without(docs, stored(gone, "gone"), "doc_id")


def segmented(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns with the text's sampled ``pieces``, their number, and whether
    they give the text back."""
    return pieces.segmented_and_checked(docs, pieces.default_model(spark))


STAGES = [
    ("quality classifier", good),
    ("exact dedup", once),
    ("MinHash near-dedup", unlike),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", segmented),
]

#: A fitted classifier, hashes and sampled pieces are beyond SQL; tests compare
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
