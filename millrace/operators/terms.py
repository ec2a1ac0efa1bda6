"""Terms of documents, their frequencies and TF-IDF weights."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import words
from ..storage import stored
from .wordlists import counted as word_counts
from .wordlists import weighted


def tokens(
    documents: DataFrame, text: str = "text", id: str = "doc_id", counted: bool = False
) -> DataFrame:
    """One row for each word of each document: ``id, pos, term``.

    With ``counted``, one for each different word of a row of ``documents``: ``id, term, n,
    alone``, where ``alone`` says that no other row has the id.  The words are counted
    in place, which takes neither a shuffle nor a table of more words than a batch has.
    """
    if not counted:
        return documents.select(id, F.posexplode(words(F.col(text))).alias("pos", "term"))
    again = documents.groupBy(id).count().filter(F.col("count") > 1)
    again = stored(again.select(F.col(id).alias("_again")), "again")
    same = F.col(id).eqNullSafe(F.col("_again"))

    def part(how: str, alone: bool) -> DataFrame:
        texts = documents.select(id, text).join(again, same, how)
        # A literal, so that a filter on it leaves the other part's texts alone.
        return word_counts(texts.select(id, words(F.col(text)).alias("words"))).withColumn("alone", F.lit(alone))

    return part("left_anti", True).unionByName(part("left_semi", False))


def without_stop_words(terms: DataFrame, stop_words: Iterable[str] | DataFrame) -> DataFrame:
    """Drop the stop words.

    A list becomes a hash-set test inside the scan stage.  A frame with a
    ``term`` column becomes an anti join, and Spark broadcasts it only when its
    measured size allows.
    """
    if isinstance(stop_words, DataFrame):
        return terms.join(stop_words.select("term"), "term", "left_anti").select(*terms.columns)
    listed = list(stop_words)
    return terms.filter(~F.col("term").isin(listed)) if listed else terms


def term_frequency(terms: DataFrame, id: str = "doc_id") -> DataFrame:
    """``id, term, tf``, from words one by one or ``counted``; only ids that come again are added up."""
    if "n" not in terms.columns:
        return terms.groupBy(id, "term").agg(F.count("*").alias("tf"))
    once = terms.filter("alone").select(id, "term", F.col("n").alias("tf"))
    again = terms.filter(~F.col("alone")).groupBy(id, "term").agg(F.sum("n").alias("tf"))
    return once.unionByName(again)


def document_frequency(tf: DataFrame) -> DataFrame:
    """``term, df`` from the output of ``term_frequency``."""
    return tf.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def document_count(documents: DataFrame) -> Column:
    """The number of documents, as a scalar inside the plan."""
    return documents.select(F.count("*")).scalar()


def tfidf(
    tf: DataFrame,
    n_documents: Column | int,
    id: str = "doc_id",
    numbered: bool = False,
    listed: bool = False,
) -> DataFrame:
    """``id, term, weight`` with weight ``tf * ln((m + 1) / (df + 1))``.

    With ``numbered``, a whole number stands for each term, for results that do not show it:
    vectors of numbers are shorter than vectors of words.

    With ``listed``, one row for each id with a weight that is not 0, filed: ``id, features,
    weights, norm2``, the terms by numbers that grow with the frequency.  ``tf`` is read once.
    The shuffle has the different terms of each chunk of documents, not its entries.

    ``df`` has one row a term and is filed first: a term that is in every
    document makes only the ``tf`` side of the join large, and with a plain
    shuffle on both sides Spark splits it.  ``tf`` is read twice; pass a stored table.
    """
    m = n_documents if isinstance(n_documents, Column) else F.lit(n_documents)
    idf = F.log((m + 1) / (F.col("df") + 1))
    if listed:
        return weighted(tf, idf, id)
    frequency = document_frequency(tf)
    if numbered:
        frequency = frequency.withColumn("number", F.monotonically_increasing_id())
    return tf.join(stored(frequency, "frequencies"), "term").select(
        id, F.col("number" if numbered else "term").alias("term"), (F.col("tf") * idf).alias("weight")
    )
