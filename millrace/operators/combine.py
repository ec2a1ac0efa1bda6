"""Rows of a key brought together by a merge function of the caller's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored

#: Takes rows of any keys and gives fewer rows of the same columns, each key's merged. It must
#: not matter in which order and in how many steps rows are merged.
Merge = Callable[[pa.Table], pa.Table]

#: Parts of a key that one step of the tree merges.
FAN = 16
#: Rows that a task gathers before it merges again.
_GATHERED = 1 << 16
_TASK = "_task"


def combined_by_key(rows: DataFrame, keys: list[str], merge: Merge) -> DataFrame:
    """All rows of each key merged into what ``merge`` makes of them; columns stay.

    The function is called on Arrow batches in the map tasks, then in a tree on the parts that
    the tasks have left of a key, ``FAN`` of them at a time.  So a key with a third of all rows
    never has its rows in one call, only parts already merged.  A task holds one part
    of each of its keys, and sends parts on once they are many.
    """
    columns = rows.columns
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema)

    def labelled(table: pa.Table) -> Iterator[pa.RecordBatch]:
        task = pa.array([TaskContext.get().partitionId()] * table.num_rows, pa.int32())
        yield from table.select(columns).append_column(_TASK, task).to_batches()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, merge):
            yield from labelled(table)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = (batch.drop_columns([_TASK]) for batch in batches)
        for table in _gathered(own, merge, keys):
            yield from labelled(table)

    schema = f"{ddl}, {_TASK} int"
    parts = stored(rows.mapInArrow(first, schema), "parts")
    labels = (parts.agg(F.max(_TASK)).first()[0] or 0) + 1
    while True:
        # Parts of a key meet by their task's number, so many of them do not meet in one task.
        label = F.call_function("div", F.col(_TASK) % labels, F.lit(FAN)).cast("int")
        dealt = parts.withColumn(_TASK, label).repartition(*keys, _TASK)
        parts = dealt.sortWithinPartitions(*keys).mapInArrow(again, schema)
        labels = -(-labels // FAN)
        if labels == 1:
            return parts.select(columns)


def _gathered(
    batches: Iterator[pa.RecordBatch], merge: Merge, sorted_by: list[str] | None = None
) -> Iterator[pa.Table]:
    """Merged tables of the batches: with rows sorted by key, each key in one of them only."""
    held, n, left = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        n += batch.num_rows
        if n - left < _GATHERED:
            continue
        merged, rest = merge(pa.concat_tables(held)), None
        if merged.num_rows >= _GATHERED:  # many keys: what stands is sent on
            if sorted_by is not None:  # but for the key that may go on
                last = _same_key(merged, batch, sorted_by)
                merged, rest = merged.filter(pc.invert(last)), merged.filter(last)
            yield merged
            held = [rest] if rest is not None else []
        else:
            held = [merged]
        n = left = sum(table.num_rows for table in held)
    if held:
        yield merge(pa.concat_tables(held))


def _same_key(table: pa.Table, batch: pa.RecordBatch, keys: list[str]) -> pa.ChunkedArray:
    """Which rows have the key of the batch's last row; null is a key."""
    same = []
    for key in keys:
        value = batch[key][-1]
        own = table[key]
        same.append(
            pc.fill_null(pc.equal(own, value), False) if value.is_valid else pc.is_null(own)
        )
    return reduce(pc.and_, same)
