"""Keyed state with an update function of the caller's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Takes the new rows of a key, in chunks, and its state; gives the new state,
#: or None to forget the key.
Update = Callable[[Iterator[pd.DataFrame], "tuple[Any, ...] | None"], "tuple[Any, ...] | None"]


class KeyedUpdate(StatefulProcessor):
    """Calls the update function for each key that has new rows in a batch."""

    def __init__(self, update: Update, key: str, state_schema: StructType, ttl_ms: int | None):
        self._update = update
        self._key = key
        self._schema = state_schema
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("state", self._schema, self._ttl_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        (before,) = initialState[self._schema.names].itertuples(index=False)
        self._state.update(tuple(before))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = tuple(self._state.get()) if self._state.exists() else None
        after = self._update(rows, before)
        if after is None:
            self._state.clear()
            return
        self._state.update(tuple(after))
        columns = {self._key: [key[0]]}
        columns.update({f.name: [value] for f, value in zip(self._schema, after)})
        yield pd.DataFrame(columns)

    def close(self) -> None:
        pass


def update_state_by_key(
    stream: DataFrame,
    key: str,
    update: Update,
    state_schema: str,
    ttl_ms: int | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """The new state of every key with new rows: the key and the state's columns.

    ``initial`` has one row for each key that starts with a state: the key and the state's columns.
    It is taken up in the stream's first batch and ignored after that, also after a
    restart; such a key is in the state even if it never has a row.

    A key's rows arrive in chunks and are never held together.  Keys stay for
    good unless the function drops them or ``ttl_ms`` is set.  The session must
    use the RocksDB state store, see ``rocksdb_state``.
    """
    schema = StructType.fromDDL(state_schema)
    output = StructType([stream.schema[key], *schema.fields])
    if initial is not None:
        initial = initial.select(key, *schema.names).groupBy(key)
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=KeyedUpdate(update, key, schema, ttl_ms),
        outputStructType=output,
        outputMode="Update",
        timeMode="ProcessingTime" if ttl_ms else "None",
        initialState=initial,
    )


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Use the RocksDB state store for queries started inside, then restore."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def combined_by_user(purchases: DataFrame) -> DataFrame:
    """Purchases added up by user inside each task: ``user, n, revenue``.

    A stream cannot aggregate before a custom state, so each task adds up its
    own Arrow batches first.  A user with a third of all rows then sends a row a
    batch to the task that keeps its state, and not all its purchases.
    """

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = (
                pa.Table.from_batches([batch])
                .group_by("user")
                .aggregate([("price", "count"), ("price", "sum")])
                .select(["user", "price_count", "price_sum"])
                .rename_columns(["user", "n", "revenue"])
            )
            yield from sums.to_batches()

    user = purchases.schema["user"].dataType.simpleString()
    return purchases.select("user", "price").mapInArrow(
        combine, f"user {user}, n bigint, revenue double"
    )


def add_totals(rows: Iterator[pd.DataFrame], state: tuple[int, float] | None) -> tuple[int, float]:
    """Update function: add up ``n`` and ``revenue``."""
    n, revenue = state or (0, 0.0)
    for chunk in rows:
        n += int(chunk["n"].sum())
        revenue += float(chunk["revenue"].sum())
    return n, revenue


def custom_user_totals(
    purchases: DataFrame, ttl_ms: int | None = None, initial: DataFrame | None = None
) -> DataFrame:
    """The same totals as ``user_totals`` on a stream, by a custom update function.

    ``initial`` (``user, n, revenue``, such as ``user_totals`` of a finished table) is where they start.
    """
    schema = "n bigint, revenue double"
    return update_state_by_key(
        combined_by_user(purchases), "user", add_totals, schema, ttl_ms, initial
    )
