"""Weighted terms as one row a document, with a number for each term.

The entries of a document never leave its row.  What is dealt out by term are the different terms
of a chunk of documents, which are far fewer than its entries, and what comes back to the chunk is
the number and the weight of each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ..storage import discard, stored
from .given import small_batches, trim
from .meeting import placed

#: Entries of a chunk, and different terms in one row of its list.
CHUNK, TERMS = 1 << 20, 1 << 14
#: Bytes that a task sends to Python at once.
_BATCH = 1 << 22


def counted(texts: DataFrame) -> DataFrame:
    """``id, term, n`` of rows ``id, words``: each different word of a row, once."""
    small_batches(texts.sparkSession, _BATCH)
    out = StructType([texts.schema[0], StructField("term", StringType()), StructField("n", LongType())])
    names = [field.name for field in out]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = rows = words = key = n = columns = None
        for batch in batches:
            rows, words = _flat(batch.column(1))
            words = words.dictionary_encode()
            each = max(len(words.dictionary), 1)
            key = rows * each + words.indices.to_numpy(zero_copy_only=False)
            key, n = np.unique(key, return_counts=True)
            columns = [batch.column(0).take(pa.array(key // each)), words.dictionary.take(pa.array(key % each))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n)], names=names)
        del batch, rows, words, key, n, columns
        trim()

    return texts.mapInArrow(work, out)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """The row of each item, and the items; a null list has none."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())


def coded(tf: DataFrame, id: str) -> DataFrame:
    """``chunk, id, codes, counts`` and ``chunk, first, terms, dfs`` of ``id, term, tf``, in one table.

    The rows of a task are cut into chunks of some ``CHUNK`` entries, at the end of an id's rows.  In a
    chunk a term's code is its place in the chunk's list of terms, whose rows begin at ``first``.
    """
    small_batches(tf.sparkSession, _BATCH)
    whole = ArrayType(LongType())
    out = StructType(
        [
            StructField("chunk", LongType()),
            StructField("id", tf.schema[id].dataType),
            StructField("codes", whole),
            StructField("counts", whole),
            StructField("first", LongType()),
            StructField("terms", ArrayType(StringType())),
            StructField("dfs", whole),
        ]
    )
    schema = to_arrow_schema(out)

    def rows(n: int, **given: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [given[f.name].cast(f.type) if f.name in given else pa.nulls(n, f.type) for f in schema], schema=schema
        )

    def chunk_rows(table: pa.Table, chunk: int) -> Iterator[pa.RecordBatch]:
        ids = _encoded(table, 0)
        terms = _encoded(table, 1)
        tfs = table.column(2).combine_chunks().to_numpy(zero_copy_only=False)
        row = ids.indices.to_numpy(zero_copy_only=False)
        code = terms.indices.to_numpy(zero_copy_only=False)
        n = len(ids.dictionary)
        order = np.lexsort((code, row))
        offsets = _offsets(np.bincount(row, minlength=n))
        yield rows(
            n,
            chunk=pa.array(np.full(n, chunk)),
            id=ids.dictionary,
            codes=pa.ListArray.from_arrays(offsets, pa.array(code[order].astype(np.int64))),
            counts=pa.ListArray.from_arrays(offsets, pa.array(tfs[order])),
        )
        listed = terms.dictionary
        dfs = np.bincount(code[tfs > 0], minlength=len(listed))
        first = np.arange(0, len(listed), TERMS)
        offsets = _offsets(np.diff(np.append(first, len(listed))))
        yield rows(
            len(first),
            chunk=pa.array(np.full(len(first), chunk)),
            first=pa.array(first),
            terms=pa.ListArray.from_arrays(offsets, listed),
            dfs=pa.ListArray.from_arrays(offsets, pa.array(dfs)),
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < CHUNK:
                continue
            table = pa.Table.from_batches(held)
            row = _encoded(table, 0).indices.to_numpy(zero_copy_only=False)
            others = np.flatnonzero(row != row[-1])
            if len(others):
                cut = int(others[-1]) + 1
                yield from chunk_rows(table.slice(0, cut), chunk)
                chunk += 1
                table = table.slice(cut)
            held, size = table.combine_chunks().to_batches(), table.num_rows
            del table
            trim()
        if size:
            yield from chunk_rows(pa.Table.from_batches(held), chunk)
        held.clear()
        trim()

    entries = tf.filter(F.col("term").isNotNull()).select(F.col(id).alias("id"), "term", F.col("tf").cast("bigint"))
    return entries.mapInArrow(work, out)


def _encoded(table: pa.Table, column: int) -> pa.DictionaryArray:
    return table.column(column).combine_chunks().dictionary_encode(null_encoding="encode")


def weighted(tf: DataFrame, idf: Column, id: str) -> DataFrame:
    """``id, features, weights, norm2``, filed: one row for each id with a weight that is not 0.

    ``idf`` is what a count is multiplied by, from the column ``df``.  ``features`` are the numbers of the
    terms, ascending in each row and, over all terms, from rare to frequent ones.
    """
    pieces = stored(coded(tf, id), "coded", tidy=True)
    term = F.posexplode(F.arrays_zip("terms", "dfs")).alias("at", "word")
    terms = pieces.filter(F.col("terms").isNotNull()).select("chunk", "first", term)
    terms = terms.select("chunk", (F.col("first") + F.col("at")).alias("code"), "word.*")
    # Dealt out first: lists of one place each would be larger than the rows.
    by_term = terms.repartition("terms").groupBy("terms")
    places = F.collect_list(F.struct("chunk", "code")).alias("places")
    frequency = by_term.agg(F.sum("dfs").alias("df"), places)
    # Filed, as a sort reads its input twice.
    frequency = stored(frequency.select("df", idf.alias("idf"), "places"), "frequencies", tidy=True)
    numbers = placed(frequency.orderBy("df", F.get("places", F.lit(0))), "numbers")
    discard(frequency)
    back = numbers.select(F.col("place").alias("number"), "idf", F.explode("places").alias("at"))
    lists = stored(_joined(pieces, back.select("at.chunk", "at.code", "number", "idf")), "lists", tidy=True)
    discard(numbers)
    discard(pieces)
    again = lists.groupBy("id").count().filter(F.col("count") > 1).select(F.col("id").alias("_again"))
    if again.isEmpty():
        return lists.withColumnRenamed("id", id)
    again = stored(again, "again")
    same = F.col("id").eqNullSafe(F.col("_again"))
    entry = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("features", "weights"))))
    merged = lists.join(again, same, "left_semi").groupBy("id").agg(entry.alias("row"), F.sum("norm2").alias("norm2"))
    once = lists.join(again, same, "left_anti")
    merged = merged.select("id", F.col("row.features").alias("features"), F.col("row.weights").alias("weights"), "norm2")
    whole = stored(once.unionByName(merged), "whole", tidy=True)
    discard(lists)
    return whole.withColumnRenamed("id", id)


def _joined(pieces: DataFrame, numbers: DataFrame) -> DataFrame:
    """The rows of documents, with the numbers and weights of their terms."""
    documents = pieces.filter(F.col("codes").isNotNull()).select("chunk", "id", "codes", "counts")
    out = StructType(
        [
            documents.schema["id"],
            StructField("features", ArrayType(numbers.schema["number"].dataType)),
            StructField("weights", ArrayType(DoubleType())),
            StructField("norm2", DoubleType()),
        ]
    )
    schema = to_arrow_schema(out)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        trim()
        at = right["code"].to_numpy()
        number, idf = np.zeros(len(at), dtype=np.int64), np.zeros(len(at))
        number[at], idf[at] = right["number"].to_numpy(), right["idf"].to_numpy()
        rows, codes = _flat(left["codes"].combine_chunks())
        codes = codes.to_numpy(zero_copy_only=False)
        weights = left["counts"].combine_chunks().flatten().to_numpy(zero_copy_only=False) * idf[codes]
        there = np.flatnonzero(weights != 0)
        rows, features, weights = rows[there], number[codes[there]], weights[there]
        order = np.lexsort((features, rows))
        features, weights = features[order], weights[order]
        sizes = np.bincount(rows, minlength=left.num_rows)
        norm2 = np.bincount(rows, weights=weights * weights, minlength=left.num_rows)
        kept = np.flatnonzero(sizes)
        offsets = _offsets(sizes[kept])
        values = pa.array(features).cast(schema.field("features").type.value_type)
        columns = [
            left["id"].combine_chunks().take(pa.array(kept)),
            pa.ListArray.from_arrays(offsets, values),
            pa.ListArray.from_arrays(offsets, pa.array(weights)),
            pa.array(norm2[kept], pa.float64()),
        ]
        return pa.table(columns, names=schema.names)

    return documents.groupBy("chunk").cogroup(numbers.groupBy("chunk")).applyInArrow(work, out)
