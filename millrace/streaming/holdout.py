"""Base and test ratings told apart while the ratings arrive."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegralType, LongType, StringType, StructField, StructType

from ..functions.parsing import field, fields, number
from ..operators.splits import BASE, TEST

_FIRST = "_first"
_PART, _AT = "_part", "_at"
_SEEN = StructType([StructField("n", LongType())])

#: Users share so many parts; the state is called once for a part of a batch, not for a user.  The
#: state is filed by part, so a stream that goes on from a checkpoint must not change it.
PARTS = 1 << 11
#: The part of null users.
_NO_USER = -1


class _Numbered(StatefulProcessor):
    """Numbers the ratings of the users of a part; holds no more than ``stop`` of a user's at a time."""

    def __init__(self, start: int, stop: int, user: StructField, order: str, columns: list[str]):
        self._start, self._stop = start, stop
        self._user, self._order, self._columns = user, order, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        key = StructType([StructField(self._user.name, self._user.dataType)])
        self._seen = handle.getMapState("seen", key, _SEEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known: dict[Any, int] = {}
        seen, new = [], np.zeros(0, dtype=np.int64)
        first = None
        for chunk in rows:
            at = self._places(chunk, key[0] == _NO_USER, known, seen)
            new = np.bincount(at, minlength=len(seen)) + np.pad(new, (0, len(seen) - len(new)))
            chunk = chunk.assign(**{_AT: at})
            both = chunk if first is None else pd.concat([first, chunk])
            both, rank = self._ranked(both)
            room = rank < np.maximum(self._stop - np.array(seen), 0)[both[_AT]]
            first = both[room]
            yield from self._emitted(both[~room], False)
        if first is not None and len(first):
            first, rank = self._ranked(first)
            number = np.array(seen)[first[_AT]] + 1 + rank
            yield from self._emitted(first, number >= self._start)
        for user, place in known.items():
            # Beyond ``stop`` the exact number decides nothing.
            n = min(seen[place] + int(new[place]), self._stop)
            if n != seen[place]:
                self._seen.updateValue((user,), (n,))

    def _places(self, chunk: pd.DataFrame, no_user: bool, known: dict, seen: list[int]) -> np.ndarray:
        """The place of each row's user in ``known``; what the state has goes to ``seen``."""
        codes, users = pd.factorize(chunk[self._user.name], use_na_sentinel=False)
        places = np.zeros(len(users), dtype=np.int64)
        for code, user in enumerate(users):
            user = None if no_user else self._plain(user)
            if user not in known:
                known[user] = len(seen)
                before = self._seen.getValue((user,))
                seen.append(int(before[0]) if before is not None else 0)
            places[code] = known[user]
        return places[codes]

    def _plain(self, user: Any) -> Any:
        if isinstance(self._user.dataType, IntegralType):
            return int(user)
        return user.item() if isinstance(user, np.generic) else user

    def _ranked(self, rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        """The rows user by user and by ``order``, and their ranks from 0."""
        rows = rows.iloc[np.lexsort((rows[self._order], rows[_AT]))]
        own, place = rows[_AT].to_numpy(), np.arange(len(rows))
        begins = np.concatenate(([True], own[1:] != own[:-1]))[: len(own)]
        return rows, place - np.maximum.accumulate(np.where(begins, place, 0))

    def _emitted(self, rows: pd.DataFrame, test) -> Iterator[pd.DataFrame]:
        if len(rows):
            yield rows[self._columns].assign(role=np.where(test, TEST, BASE))

    def close(self) -> None:
        pass


def _first_of_task(rows: DataFrame, user: str, order: str, stop: int) -> DataFrame:
    """Mark the rows that may be among the first ``stop`` of their user in this batch."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            users = table[user].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
            by = np.lexsort((table[order].to_numpy(), users))
            own = users[by]
            begins = np.concatenate(([True], own[1:] != own[:-1]))[: len(own)]
            rank = np.arange(len(own)) - np.maximum.accumulate(np.where(begins, np.arange(len(own)), 0))
            first = np.zeros(len(own), dtype=bool)
            first[by] = rank < stop
            yield from table.append_column(_FIRST, pa.array(first)).to_batches()

    schema = StructType([*rows.schema.fields, StructField(_FIRST, BooleanType())])
    return rows.mapInArrow(mark, schema)


def holdout_stream(
    ratings: DataFrame, start: int, stop: int, user: str = "user_id", order: str = "pos"
) -> DataFrame:
    """Every rating of a stream with ``role``: ``test`` for ratings ``start`` to ``stop`` of its user.

    Ratings of a user are counted from 1 as they arrive: batch after batch, and by ``order``, a
    number without nulls, within a batch.  The result does not change afterwards, so the
    output appends.  If batches follow ``order`` it equals ``splits.user_holdout``.  A
    null user is a user of its own.

    The state is one number a user, in maps of users that ``PARTS`` parts share: a batch calls the
    state once for each part, and reads and writes the numbers of the users that came.  Of a
    user's rows, each task sends only the first ``stop`` of every Arrow batch to the state; the others
    are base whatever comes, and stay where they are.  A user with a third of all rows so sends a
    few rows a batch.  The session must use the RocksDB state store, see
    ``custom_state.rocksdb_state``.
    """
    marked = _first_of_task(ratings, user, order, stop)
    output = StructType([*ratings.schema.fields, StructField("role", StringType())])
    part = F.when(F.col(user).isNull(), _NO_USER).otherwise(F.pmod(F.xxhash64(user), F.lit(PARTS)))
    numbered = (
        marked.filter(_FIRST)
        .drop(_FIRST)
        .withColumn(_PART, part.cast("int"))
        .groupBy(_PART)
        .transformWithStateInPandas(
            statefulProcessor=_Numbered(start, stop, ratings.schema[user], order, ratings.columns),
            outputStructType=output,
            outputMode="Append",
            timeMode="None",
        )
    )
    rest = marked.filter(~F.col(_FIRST)).drop(_FIRST).withColumn("role", F.lit(BASE))
    return numbered.unionByName(rest)


def parse_rating_lines(lines: DataFrame) -> DataFrame:
    """``user_id, item_id, rating, pos`` of lines with four fields between tabs.

    A line with a field that is missing or no number is left out.
    """
    part = fields(F.col("value"), "\t")
    parsed = lines.select(
        field(part, 0).try_cast("bigint").alias("user_id"),
        field(part, 1).try_cast("bigint").alias("item_id"),
        number(field(part, 2)).alias("rating"),
        field(part, 3).try_cast("bigint").alias("pos"),
    )
    return parsed.dropna()
