"""Copies of a text, found by length, then by prefix, then by the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .bits import bit_table, marked

#: Characters of the normalised text that the second step compares.
PREFIX = 64


def normalised(text: Column) -> Column:
    """Text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """For each row its id, ``keep_id``, ``group_size bigint`` and ``kept boolean``.

    Texts are equal when their normalised forms are; of equal texts the smallest
    id stays.  The steps refine each other:

    1. how many texts have a length: a length of its own ends the search,
    2. how many of the rest share length and hash of the first ``PREFIX``
       characters; 1 and 2 come from one scan that combines in the map tasks,
    3. only texts that pass both are hashed whole (SHA-256) in a second scan.
       What passes is a bit table of fixed size, so texts are never shuffled; a
       false bit costs one hash and changes no result.

    A null text is an empty one, and all empty texts are equal.  Rows that
    repeat an id with the same text count in ``group_size`` and share its
    verdict.  A null id is larger than any other: it stays only where no row of
    its group has an id.  An empty table gives no rows.  Other columns are not
    read.  ``carried`` adds columns over the rows of ``documents``, each under
    its name, computed in the second scan.
    """
    carried = carried or {}
    found = _grouped(documents, id_column, text_column, carried)
    return found.select(id_column, "keep_id", "group_size", "kept", *carried)


def _grouped(
    documents: DataFrame, id_column: str, text_column: str, carried: dict[str, Column]
) -> DataFrame:
    """The same with the text's hash as ``_same``, null where no other text can be equal."""
    text = normalised(F.col(text_column))
    sized = documents.select(
        F.col(id_column).alias("id"),
        text.alias("normal"),
        *(column.alias(f"carried_{name}") for name, column in carried.items()),
    ).withColumns(
        {
            "length": F.length("normal"),
            "prefix": F.xxhash64(F.substring("normal", 1, PREFIX)),
        }
    )
    heads = stored(sized.groupBy("length", "prefix").agg(F.count("*").alias("n")), "heads")
    lengths = heads.groupBy("length").agg(F.sum("n").alias("of_length")).filter("of_length > 1")
    shared = heads.filter("n > 1").join(stored(lengths, "lengths"), "length", "left_semi")
    bits = stored(bit_table(shared.select("length", "prefix")), "bits")

    hashed = stored(
        marked(sized, bits, ["length", "prefix"], "open").select(
            "id",
            F.when(F.col("open"), F.sha2("normal", 256)).alias("full"),
            *(f"carried_{name}" for name in carried),
        ),
        "hashed",
    )
    groups = (
        hashed.filter("full IS NOT NULL")
        .groupBy("full")
        .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )
    # A filed table on the small side leaves a plain shuffle on both sides of
    # the join, which Spark can split where many rows share one text.
    copies = hashed.filter("full IS NOT NULL").join(stored(groups, "groups"), "full", "left")
    single = hashed.filter("full IS NULL").withColumns(
        {"keep_id": F.col("id"), "group_size": F.lit(1).cast("long")}
    )
    kept = copies.withColumns(
        {
            "keep_id": F.when(F.col("group_size").isNull(), F.col("id")).otherwise(
                F.col("keep_id")
            ),
            "group_size": F.coalesce("group_size", F.lit(1).cast("long")),
        }
    ).unionByName(single)
    return kept.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("full").alias("_same"),
        *(F.col(f"carried_{name}").alias(name) for name in carried),
    )


def exact_dedup(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows that stay, with all their columns (see ``exact_groups``).

    Of rows that repeat an id with the same text one stays, of any of them.
    A row goes by its id and the hash of its text, so that another text under
    the same id stays.  Rows without an id stay: nothing can name them.  Only
    rows with an id that goes or repeats are shuffled.
    """
    found = stored(_grouped(documents, id_column, text_column, {}), "exact")
    named = found.filter(F.col(id_column).isNotNull())
    gone = stored(named.filter("NOT kept").select(id_column, "_same").distinct(), "gone")
    twice = named.filter("kept").groupBy(id_column).agg(F.count("*").alias("n")).filter("n > 1")
    bits = stored(bit_table(gone.select(id_column).unionByName(twice.select(id_column))), "bits")
    split = marked(documents, bits, [id_column], "_bit_hit")
    unsure = split.filter("_bit_hit").filter(F.col(id_column).isNotNull())
    same = F.sha2(normalised(F.col(text_column)), 256)
    once = (
        unsure.withColumn("_same", same)
        .join(gone, [id_column, "_same"], "left_anti")
        .dropDuplicates([id_column, "_same"])
    )
    sure = split.filter(~F.col("_bit_hit") | F.col(id_column).isNull())
    return sure.select(documents.columns).unionByName(once.select(documents.columns))
