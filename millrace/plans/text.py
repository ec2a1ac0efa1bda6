"""Queries on the texts of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import all_stop_words
from ..operators import terms as op
from ..operators.similarity import copies_of, pair_similarity, similar_pairs
from ..operators.wide import wide_components
from ..sources.messages import split_messages
from ..storage import discard, stored
from .inputs import document_ids, documents, table
from .registry import query

THRESHOLD = 0.8

_STOP_LIST = ", ".join(f"'{word}'" for word in all_stop_words())
_TERMS = f"""
    terms AS (
      SELECT doc_id, term FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS term FROM documents)
      WHERE term NOT IN ({_STOP_LIST})),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
    weights AS (
      SELECT doc_id, term, tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) AS weight
      FROM tf JOIN df USING (term)),
    units AS (
      SELECT doc_id, term, weight,
             weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS unit
      FROM weights WHERE weight <> 0),
    marks AS (
      SELECT doc_id, string_agg(term || ' ' || weight, ',' ORDER BY term) AS mark
      FROM units GROUP BY doc_id),
    same AS (
      SELECT doc_id, min(doc_id) OVER (PARTITION BY mark) AS same_as,
             count(*) OVER (PARTITION BY mark) AS copies FROM marks)
"""


def _tf(spark: SparkSession, root: str) -> DataFrame:
    counted = op.tokens(documents(spark, root), counted=True)
    return op.term_frequency(op.without_stop_words(counted, all_stop_words()))


def _weights(spark: SparkSession, root: str, numbered: bool = False) -> DataFrame:
    tf = stored(_tf(spark, root), "tf")
    return op.tfidf(tf, op.document_count(document_ids(spark, root)), numbered=numbered)


def _numbers(spark: SparkSession, root: str) -> DataFrame:
    """The weights, a number for each term."""
    return _weights(spark, root, True).toDF("id", "feature", "weight")


def _vectors(spark: SparkSession, root: str) -> DataFrame:
    """The weights filed as one row a document, since comparing documents reads them several times."""
    tf = stored(_tf(spark, root), "tf", tidy=True)
    lists = op.tfidf(tf, op.document_count(document_ids(spark, root)), listed=True)
    discard(tf)
    return lists.withColumnRenamed("doc_id", "id")


@query(
    """
    SELECT doc_id, source AS "from", 'in ' || lang || ' by ' || source AS subject,
           md5(text) AS body_md5, length(text) AS body_length FROM documents
    """
)
def header_body_split(spark: SparkSession, root: str) -> DataFrame:
    """Messages built from documents: a folded header, a leftover id, a repeated name."""
    head = F.concat(
        F.lit("From: "),
        F.col("source"),
        F.lit("\nSUBJECT: in "),
        F.col("lang"),
        F.lit("\n\tby "),
        F.col("source"),
        F.lit("\n <removed@id>\nfrom: someone else\n\n"),
    )
    messages = table(spark, root, "documents").select(
        "doc_id", F.concat(head, F.col("text")).alias("content")
    )
    return split_messages(messages).select(
        "doc_id",
        F.col("headers")["from"].alias("from"),
        F.col("headers")["subject"].alias("subject"),
        F.md5(F.encode("body", "UTF-8")).alias("body_md5"),
        F.length("body").cast("bigint").alias("body_length"),
    )


@query(
    """
    WITH w AS (
      SELECT doc_id, regexp_extract_all(lower(text), '\\p{L}+') AS words FROM documents)
    SELECT doc_id, cast(unnest(range(len(words))) AS integer) AS pos, unnest(words) AS term FROM w
    """
)
def tokens(spark: SparkSession, root: str) -> DataFrame:
    return op.tokens(documents(spark, root))


@query(f"WITH {_TERMS} SELECT term, count(*) AS n FROM terms GROUP BY ALL")
def clean_tokens(spark: SparkSession, root: str) -> DataFrame:
    clean = op.without_stop_words(op.tokens(documents(spark, root)), all_stop_words())
    return clean.groupBy("term").agg(F.count("*").alias("n"))


@query(f"WITH {_TERMS} SELECT * FROM tf")
def term_frequency(spark: SparkSession, root: str) -> DataFrame:
    return _tf(spark, root)


@query(f"WITH {_TERMS} SELECT * FROM df")
def document_frequency(spark: SparkSession, root: str) -> DataFrame:
    return op.document_frequency(_tf(spark, root))


@query(f"WITH {_TERMS} SELECT doc_id, term, round(weight, 8) AS weight FROM weights")
def tfidf(spark: SparkSession, root: str) -> DataFrame:
    return _weights(spark, root).withColumn("weight", F.round("weight", 8))


@query(
    f"""
    WITH {_TERMS},
    dots AS (
      SELECT a.doc_id, sum(a.unit * b.unit) AS cosine
      FROM units a JOIN units b ON b.doc_id = a.doc_id + 1 AND a.term = b.term GROUP BY a.doc_id)
    SELECT d.doc_id, round(coalesce(cosine, 0), 8) + 0.0 AS cosine
    FROM documents d JOIN documents e ON e.doc_id = d.doc_id + 1
    LEFT JOIN dots ON dots.doc_id = d.doc_id
    """
)
def neighbour_similarity(spark: SparkSession, root: str) -> DataFrame:
    """How alike each document is to the next one."""
    ids = document_ids(spark, root)
    following = ids.select((F.col("doc_id") - 1).alias("doc_id"), F.col("doc_id").alias("id_b"))
    pairs = ids.join(following, "doc_id").withColumnRenamed("doc_id", "id_a")
    return pair_similarity(_numbers(spark, root), pairs).select(
        F.col("id_a").alias("doc_id"), F.round("cosine", 8).alias("cosine")
    )


@query(
    f"""
    WITH {_TERMS},
    dots AS (
      SELECT a.doc_id, sum(a.unit * b.unit) AS cosine
      FROM units a JOIN units b ON b.doc_id = a.doc_id + 7 AND a.term = b.term GROUP BY a.doc_id)
    SELECT d.doc_id AS id_a, e.doc_id AS id_b, round(coalesce(cosine, 0), 8) + 0.0 AS cosine
    FROM documents d JOIN documents e ON e.doc_id = d.doc_id + 7
    LEFT JOIN dots ON dots.doc_id = d.doc_id
    """
)
def repeated_pair_similarity(spark: SparkSession, root: str) -> DataFrame:
    """The same for pairs seven ids apart, each of them listed twice or more."""
    ids = document_ids(spark, root)
    apart = ids.select((F.col("doc_id") - 7).alias("id_a"), F.col("doc_id").alias("id_b"))
    there = apart.join(ids.withColumnRenamed("doc_id", "id_a"), "id_a", "left_semi")
    again = there.filter(F.col("id_a") % 3 == 0)
    pairs = there.unionByName(there).unionByName(again)
    return pair_similarity(_numbers(spark, root), pairs).withColumn(
        "cosine", F.round("cosine", 8)
    )


@query(
    f"""
    WITH {_TERMS},
    u AS (SELECT doc_id, copies, term, unit FROM units JOIN same USING (doc_id)
          WHERE doc_id = same_as)
    SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, any_value(a.copies) AS copies_a,
           any_value(b.copies) AS copies_b, round(sum(a.unit * b.unit), 6) AS cosine
    FROM u a JOIN u b ON a.term = b.term AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING sum(a.unit * b.unit) >= {THRESHOLD}
    """
)
def similar_documents(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of documents that are alike, one document standing for its copies."""
    return similar_pairs(_vectors(spark, root), THRESHOLD).pairs.select(
        F.col("id_a").alias("doc_a"),
        F.col("id_b").alias("doc_b"),
        "copies_a",
        "copies_b",
        F.round("cosine", 6).alias("cosine"),
    )


@query(f"WITH {_TERMS} SELECT doc_id, same_as FROM same")
def document_copies(spark: SparkSession, root: str) -> DataFrame:
    """The document that stands for each document with the same vector."""
    return copies_of(_vectors(spark, root)).withColumnRenamed("id", "doc_id")


#: Columns that terms are hashed to: the first four hexadecimal digits of their MD5.
WIDTH = 1 << 16
COMPONENTS = 3


def _power_sql(steps: int) -> str:
    """The first components by repeated multiplication, each one kept out of the next."""
    parts = []
    for c in range(COMPONENTS):
        for k in range(steps):
            before = f"v{c}_{k - 1}" if k else "start"
            off = "".join(
                f" - c{j}.x * (SELECT sum(w.w * x) FROM w{c}_{k} w JOIN v{j}_{steps - 1} USING (f))"
                for j in range(c)
            )
            joins = "".join(f" JOIN v{j}_{steps - 1} c{j} USING (f)" for j in range(c))
            parts.append(
                f"""u{c}_{k} AS MATERIALIZED (
      SELECT doc_id, sum(a.v * x) - (SELECT sum(m * x) FROM mu JOIN {before} USING (f)) AS u
      FROM a JOIN {before} USING (f) GROUP BY doc_id),
    w{c}_{k} AS MATERIALIZED (
      SELECT f, sum(a.v * u) AS w FROM a JOIN u{c}_{k} USING (doc_id) GROUP BY f),
    v{c}_{k} AS MATERIALIZED (
      SELECT f, r / sqrt(sum(r * r) OVER ()) AS x, sqrt(sum(r * r) OVER ()) AS size
      FROM (SELECT w.f, w.w{off} AS r FROM w{c}_{k} w{joins}))"""
            )
    return ",\n    ".join(parts)


_STEPS = 45


@query(
    f"""
    WITH {_TERMS},
    h AS (SELECT doc_id, ('0x' || substr(md5(term), 1, 4))::BIGINT AS f, sum(tf) AS t
          FROM tf GROUP BY ALL),
    a AS MATERIALIZED (
      SELECT doc_id, f, t / sqrt(sum(t * t) OVER (PARTITION BY doc_id)) AS v FROM h),
    n AS (SELECT count(DISTINCT doc_id) AS n FROM a),
    mu AS MATERIALIZED (SELECT f, sum(v) / any_value(n) AS m FROM a, n GROUP BY f),
    start AS MATERIALIZED (SELECT f, (f * 7919 % 1009) / 1009 - 0.4 AS x FROM mu),
    {_power_sql(_STEPS)},
    total AS (
      SELECT sum(s - n * m * m) / any_value(n - 1) AS total
      FROM (SELECT f, sum(v * v) AS s FROM a GROUP BY f) JOIN mu USING (f), n)
    {" UNION ALL ".join(
        f"""SELECT {c} AS component, round(any_value(size) / any_value(n - 1), 6) AS variance,
           round(any_value(size) / any_value(n - 1), 6) AS of_scores, 1.0::DOUBLE AS length,
           arg_max(f, abs(x)) AS strongest, round(any_value(total), 6) AS total
    FROM v{c}_{_STEPS - 1}, n, total""" for c in range(COMPONENTS))}
    """
)
def pca_wide(spark: SparkSession, root: str) -> DataFrame:
    """Components of the documents over 65,536 hashed terms.

    ``of_scores`` is the variance of the projected documents, ``strongest`` the column with the
    largest loading, ``total`` the variance along all directions.
    """
    hashed = F.conv(F.substring(F.md5("term"), 1, 4), 16, 10).cast("int")
    counts = _tf(spark, root).groupBy("doc_id", hashed.alias("f")).agg(F.sum("tf").alias("tf"))
    # The length is a sum of the group: as a fold over the row it would run once an entry.
    listed = counts.groupBy("doc_id").agg(
        F.collect_list(F.struct("f", "tf")).alias("row"),
        F.sqrt(F.sum((F.col("tf") * F.col("tf")).cast("double"))).alias("norm"),
    )
    rows = stored(
        listed.select(
            F.col("row.f").alias("indices"),
            F.transform("row.tf", lambda tf: tf / F.col("norm")).alias("values"),
        ),
        "hashed",
    )
    found = wide_components(rows, WIDTH, COMPONENTS, extra=24, rounds=5)
    along = (
        found.project(rows)
        .select(F.posexplode("scores").alias("component", "score"))
        .groupBy("component")
        .agg(F.round(F.var_samp("score"), 6).alias("of_scores"))
    )
    # The variance of all columns: mean squares less squared means, over the rows.
    squares = rows.select(F.aggregate("values", F.lit(0.0), lambda s, v: s + v * v).alias("s"))
    off = found.count * float(found.mean @ found.mean)
    total = squares.agg(F.round((F.sum("s") - off) / (found.count - 1), 6).alias("total"))
    described = [
        (c, round(float(found.variances[c]), 6), round(float(own @ own), 9), int(abs(own).argmax()))
        for c, own in enumerate(found.loadings.T)
    ]
    schema = "component int, variance double, length double, strongest bigint"
    return (
        spark.createDataFrame(described, schema)
        .join(along, "component")
        .withColumn("total", total.scalar())
    )
