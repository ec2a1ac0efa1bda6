"""Mail-style messages in a labelled directory tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import read_whole_files

# The message layout.
_HEADER = r"(?m)^([^\s:]+):[ \t]*(.*)$"
_LEFTOVER_ID = r"\n[ \t]+<[^\n]*"
_FOLD = r"\n[ \t]+"
_HEAD = r"(?s)^.*?(\r?\n\r?\n|$)"


def read_messages(spark: SparkSession, root: str, charset: str = "UTF-8") -> DataFrame:
    """Messages stored as ``<root>/<split>/<newsgroup>/<msg_id>``.

    The three path parts together are the key: ids repeat between newsgroups.
    """
    return messages_of(read_whole_files(spark, root, charset))


def messages_of(files: DataFrame) -> DataFrame:
    """Messages of ``path, content`` rows by the last three parts of the path."""
    part = F.split("path", "/")
    return split_messages(
        files.select(
            F.element_at(part, -3).alias("split"),
            F.element_at(part, -2).alias("newsgroup"),
            F.element_at(part, -1).alias("msg_id"),
            "content",
        )
    )


def split_messages(messages: DataFrame, content: str = "content") -> DataFrame:
    """Replace ``content`` by ``headers map<string,string>`` and ``body string``.

    The first blank line ends the headers; the body stays as it is.  Header names are lower-cased and
    the first of a repeated name is kept.  An indented line continues the
    header above, except one that starts with ``<``: that is what is left of a
    removed header of message ids.
    """
    rest = [name for name in messages.columns if name != content]
    cut = messages.withColumn("_head", F.regexp_extract(content, _HEAD, 0))
    body = F.substring(F.col(content), F.length("_head") + 1, F.length(content))
    parted = cut.select(
        *rest, _unfolded(F.col("_head")).alias("_head"), body.alias("body")
    )
    # In steps: an expression inside of another's function would run once a header.
    named = parted.withColumns(
        {
            "_names": F.transform(
                F.regexp_extract_all("_head", F.lit(_HEADER), F.lit(1)), F.lower
            ),
            "_values": F.regexp_extract_all("_head", F.lit(_HEADER), F.lit(2)),
        }
    )
    return named.select(*rest, _first_named("_names", "_values").alias("headers"), "body")


def _unfolded(head: Column) -> Column:
    text = F.regexp_replace(head, "\r\n", "\n")
    return F.regexp_replace(F.regexp_replace(text, _LEFTOVER_ID, ""), _FOLD, " ")


def _first_named(names: str, values: str) -> Column:
    """A map of names to values, the first of a repeated name."""
    pairs = F.arrays_zip(F.col(names).alias("name"), F.col(values).alias("value"))
    first = F.filter(pairs, lambda p, i: F.array_position(F.col(names), p["name"]) == i + 1)
    return F.map_from_entries(first)
