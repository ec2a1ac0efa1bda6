"""Queries on text files that Spark writes from the tables first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.dimensions import read_counts, read_genres, read_occupations
from ..sources.lines import read_whole_files
from ..sources.messages import messages_of
from ..sources.ratings import read_bad_ratings, read_ratings
from ..storage import new_folder
from .inputs import documents, event_ratings, table
from .registry import query


def _written(lines: DataFrame, name: str) -> str:
    path = new_folder(lines.sparkSession, name)
    lines.write.text(path)
    return path


@query(
    """
    SELECT user_id, event_id AS item_id, value AS rating,
           row_number() OVER (ORDER BY event_id) - 1 AS pos
    FROM events
    """
)
def rating_file(spark: SparkSession, root: str) -> DataFrame:
    """Tab-separated ratings in file order; the position comes from the files."""
    ratings = event_ratings(spark, root).orderBy("pos")
    line = F.concat_ws("\t", *(F.col(c).cast("string") for c in ("user_id", "item_id", "rating")))
    return read_ratings(spark, _written(ratings.select(line), "ratings"))


_BROKEN = """
    SELECT event_id, CASE event_id % 9
             WHEN 0 THEN concat_ws(chr(9), 'user', event_id, value)
             WHEN 1 THEN concat_ws(chr(9), user_id, 'item', value)
             WHEN 2 THEN concat_ws(chr(9), user_id, event_id)
             WHEN 3 THEN ''
             WHEN 4 THEN concat_ws(chr(9), '  ' || user_id, event_id, value, 'more')
             ELSE concat_ws(chr(9), user_id || ' x', event_id, value) END AS "value"
    FROM events"""


def _broken_lines(spark: SparkSession, root: str) -> str:
    """A file with good and bad rating lines in the order of the events."""
    user, item, rating = (F.col(c).cast("string") for c in ("user_id", "item_id", "rating"))
    kind = F.col("item_id") % 9
    line = (
        F.when(kind == 0, F.concat_ws("\t", F.lit("user"), item, rating))
        .when(kind == 1, F.concat_ws("\t", user, F.lit("item"), rating))
        .when(kind == 2, F.concat_ws("\t", user, item))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.concat_ws("\t", F.concat(F.lit("  "), user), item, rating, F.lit("more")))
        .otherwise(F.concat_ws("\t", F.concat(user, F.lit(" x")), item, rating))
    )
    ratings = event_ratings(spark, root).orderBy("pos")
    return _written(ratings.select(line), "broken-ratings")


@query(
    """
    WITH n AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events)
    SELECT user_id, event_id AS item_id, value AS rating, pos FROM n WHERE event_id % 9 > 3
    """
)
def rating_lines(spark: SparkSession, root: str) -> DataFrame:
    """The ratings of a file that also has bad lines; these keep their numbers."""
    return read_ratings(spark, _broken_lines(spark, root))


@query(
    f"""
    WITH n AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM ({_BROKEN}))
    SELECT pos, CASE event_id % 9 WHEN 0 THEN 'bad user' WHEN 1 THEN 'bad item'
                 WHEN 2 THEN 'bad rating' ELSE 'bad user' END AS problem
    FROM n WHERE event_id % 9 < 4
    """
)
def bad_rating_lines(spark: SparkSession, root: str) -> DataFrame:
    """The lines that are set aside, with what is wrong with them."""
    return read_bad_ratings(spark, _broken_lines(spark, root)).select("pos", "problem")


@query("SELECT n_name AS genre, n_nationkey AS genre_id FROM nation")
def genre_file(spark: SparkSession, root: str) -> DataFrame:
    line = F.concat_ws("|", "n_name", F.col("n_nationkey").cast("string"))
    return read_genres(spark, _written(table(spark, root, "nation").select(line), "genres"))


@query("SELECT r_name AS occupation FROM region")
def occupation_file(spark: SparkSession, root: str) -> DataFrame:
    names = table(spark, root, "region").select("r_name")
    return read_occupations(spark, _written(names, "occupations"))


@query("SELECT count(*) AS n, event_type AS label FROM events GROUP BY event_type")
def count_file(spark: SparkSession, root: str) -> DataFrame:
    counts = table(spark, root, "events").groupBy("event_type").count()
    line = F.concat_ws(" ", F.col("count").cast("string"), "event_type")
    return read_counts(spark, _written(counts.select(line), "counts"))


@query(
    """
    SELECT doc_id // 50 AS part, md5(string_agg(text || chr(10), '' ORDER BY doc_id)) AS content_md5
    FROM documents GROUP BY 1
    """
)
def whole_files(spark: SparkSession, root: str) -> DataFrame:
    """Fifty documents to a file, one line end after each, read as whole files."""
    path = new_folder(spark, "files")
    rows = documents(spark, root).withColumn("part", F.expr("doc_id div 50"))
    rows.repartition("part").sortWithinPartitions("part", "doc_id").select(
        "part", "text"
    ).write.partitionBy("part").text(path)
    files = read_whole_files(spark, path)
    return files.select(
        F.regexp_extract("path", r"/part=(\d+)/", 1).cast("bigint").alias("part"),
        F.md5(F.encode("content", "UTF-8")).alias("content_md5"),
    )


@query(
    """
    SELECT CASE doc_id // 50 % 3 WHEN 0 THEN 'test' ELSE 'train' END AS split,
           'group ' || (doc_id // 50 % 7) AS newsgroup, cast(doc_id // 50 AS varchar) AS msg_id,
           'part ' || (doc_id // 50) AS "from", 'documents (' || count(*) || ')' AS subject,
           md5(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id)) AS body_md5
    FROM documents GROUP BY doc_id // 50
    """
)
def message_tree(spark: SparkSession, root: str) -> DataFrame:
    """Fifty documents to a message, one file each; split and group are read from the folders."""
    texts = documents(spark, root).withColumn("part", F.expr("doc_id div 50"))
    number = F.col("part").cast("string")
    head = F.concat(
        F.lit("From: part "), number, F.lit("\nSubject: documents\n ("), F.col("n"), F.lit(")\n")
    )
    heads = texts.groupBy("part").agg(F.count("*").cast("string").alias("n"))
    lines = heads.select("part", F.lit(-1).cast("bigint").alias("at"), head.alias("value"))
    rows = lines.unionByName(
        texts.select("part", F.col("doc_id").alias("at"), F.coalesce("text", F.lit("")).alias("value"))
    ).select(
        F.when(F.col("part") % 3 == 0, "test").otherwise("train").alias("split"),
        F.concat(F.lit("group "), (F.col("part") % 7).cast("string")).alias("newsgroup"),
        number.alias("msg_id"),
        "at",
        "value",
    )
    path = new_folder(spark, "tree")
    folders = ["split", "newsgroup", "msg_id"]
    dealt = rows.repartition("msg_id").sortWithinPartitions(*folders, "at").drop("at")
    dealt.write.partitionBy(*folders).text(path)
    # Spark writes key=value folders around a file of its own name.
    part = F.split("path", "/")
    value = lambda at: F.url_decode(F.element_at(F.split(F.element_at(part, at), "="), 2))
    files = read_whole_files(spark, path).select(
        F.concat_ws("/", value(-4), value(-3), value(-2)).alias("path"), "content"
    )
    return messages_of(files).select(
        "split",
        "newsgroup",
        "msg_id",
        F.col("headers")["from"].alias("from"),
        F.col("headers")["subject"].alias("subject"),
        F.md5(F.encode("body", "UTF-8")).alias("body_md5"),
    )
