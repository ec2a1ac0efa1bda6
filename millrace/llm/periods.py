"""Periodic runs in the words of whole texts: seeds on diagonals, extended once.

A run of period q matches itself q words further on.  Lags are taken in bands: for all
lags of a band a run matches itself over k words at least, and no lag of the band
exceeds k.  Words i and i + q then start the same k-gram, and no other place between
them does, or the run would have a smaller period.  So it is enough to look at neighbouring
occurrences of a k-gram, which are fewer than the words however often one repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

#: A run has at least so many words, and so many times its period.
LEAST, TIMES = 6, 4

_RUN = "struct<start:bigint,length:bigint,period:bigint>"
_SPACE = r"[\x20\x09-\x0D]+"


def _renamed(names: np.ndarray, others: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers: equal pairs, equal numbers."""
    pairs = names * (int(others.max(initial=0)) + 1) + others
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def _grams(names: np.ndarray, size: int, wanted: int) -> np.ndarray:
    """Numbers of the ``wanted``-grams from those of the ``size``-grams."""
    while size < wanted:
        step = min(size, wanted - size)
        if len(names) <= step:
            return names[:0]
        names = _renamed(names[:-step], names[step:])
        size += step
    return names


def _neighbours(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of grams that occur again, and how far on the next occurrence is."""
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    first = order[:-1][same]
    return first, order[1:][same] - first


def _reach(values: np.ndarray, at: int, lag: int, way: int) -> int:
    """How many places from ``at`` on, going ``way``, match the places ``lag`` further on."""
    room = len(values) - lag - at if way > 0 else at + 1
    done, step = 0, 32
    while done < room:
        take = min(step, room - done)
        if way > 0:
            a = values[at + done : at + done + take]
            b = values[at + lag + done : at + lag + done + take]
        else:
            end = at + 1 - done
            a, b = values[end - take : end][::-1], values[end - take + lag : end + lag][::-1]
        unlike = np.flatnonzero(a != b)
        if len(unlike):
            return done + int(unlike[0])
        done += take
        step *= 2
    return room


def _extended(values: np.ndarray, places: np.ndarray, lags: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs ``start, length, period`` that seeds at these places and lags lie in."""
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    # A seed right behind another on its diagonal is covered by it.
    fresh = np.ones(len(places), dtype=bool)
    fresh[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
    covered: dict[int, int] = {}
    runs = []
    for at, lag in zip(places[fresh].tolist(), lags[fresh].tolist(), strict=True):
        if at < covered.get(lag, 0):
            continue
        end = at + _reach(values, at, lag, 1)
        start = at + 1 - _reach(values, at, lag, -1)
        covered[lag] = end
        if end + lag - start >= max(LEAST, TIMES * lag):
            runs.append((start, end + lag - start, lag))
    return runs


def _overlap(lag: int) -> int:
    """The least number of places at which a run of this period or more matches itself."""
    return min(max(LEAST, TIMES * q) - q for q in range(lag, max(lag, LEAST) + 1))


def runs_in(values: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``start, length, period`` of several sequences behind one another.

    ``values`` are numbers from 0; at ``firsts``, before each sequence, stands a number that
    occurs once, so that nothing matches beyond a sequence.
    """
    found = []
    lag, size, grams = 1, 1, values.astype(np.int64)
    origin = np.arange(len(values))
    while True:
        # Longer lags need longer sequences, and in them a gram that occurs twice.
        lengths = np.diff(np.append(firsts, len(values)))
        stays = lengths > max(LEAST, TIMES * lag)
        if lag > 1:
            again = np.zeros(len(firsts), dtype=bool)
            again[np.searchsorted(firsts, _neighbours(grams)[0], side="right") - 1] = True
            stays &= again
        if not stays.any():
            return found
        keep = np.repeat(stays, lengths)
        grams, values, origin = grams[keep[: len(grams)]], values[keep], origin[keep]
        firsts = np.concatenate(([0], np.cumsum(lengths[stays])[:-1]))

        k = _overlap(lag)
        grams, size = _grams(grams, size, k), k
        places, lags = _neighbours(grams)
        inside = (lags >= lag) & (lags <= k)
        for start, length, period in _extended(values, places[inside], lags[inside]):
            found.append((int(origin[start]), length, period))
        lag = k + 1


def _runs_and_rest(texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of words, runs and the words kept, of each text."""
    data, offsets = W.text_bytes(texts)
    starts, stops = W.word_places(data, offsets)
    counts = np.diff(np.searchsorted(starts, offsets))
    begins = np.concatenate(([0], np.cumsum(counts)))
    numbers = W.word_numbers(data, starts, stops)
    codes = numbers.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lone = len(numbers.dictionary) + np.arange(len(counts))
    values = np.insert(codes, begins[:-1], lone)
    firsts = begins[:-1] + np.arange(len(counts))

    runs = np.array(runs_in(values, firsts), dtype=np.int64).reshape(-1, 3)
    text = np.searchsorted(firsts, runs[:, 0], side="right") - 1
    starts = runs[:, 0] - firsts[text] - 1  # word number within its text
    order = np.lexsort((runs[:, 2], starts, text))
    text, starts, lengths, periods = text[order], starts[order], *runs[order, 1:].T
    listed = pa.StructArray.from_arrays(
        [pa.array(column) for column in (starts, lengths, periods)], ["start", "length", "period"]
    )
    edges = np.searchsorted(text, np.arange(len(counts) + 1)).astype(np.int32)

    dropped = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(dropped, begins[text] + starts + periods, 1)
    np.add.at(dropped, begins[text] + starts + lengths, -1)
    keep = np.cumsum(dropped[:-1]) == 0
    left = np.concatenate(([0], np.cumsum(keep)))[begins]
    kept = numbers.dictionary.take(pa.array(codes[keep]))
    rest = pa.LargeListArray.from_arrays(pa.array(left), kept)
    joined = pc.binary_join(rest, pa.scalar(b" ", pa.large_binary())).cast(pa.string())
    return counts, pa.ListArray.from_arrays(pa.array(edges), listed), joined


def periodic_runs(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """For each row its id, ``n_words long``, ``runs`` and ``collapsed string``.

    Words are ``[^\\x20\\x09-\\x0D]+`` as written, numbered from 0.  ``runs`` (an array of
    ``start, length, period``, by start and period) holds every longest stretch with
    smallest period q of ``max(6, 4 q)`` words or more.  ``collapsed`` is the text with one
    period of each run: a word goes if any run contains it after its first q words, the
    others are joined by one space.

    A null, empty or blank text has no words, no runs and the empty ``collapsed``.  Rows that
    repeat, and rows without an id, are each worked on alone; an empty table gives no rows.
    Other columns are not read.  Nothing is shuffled, and texts are taken apart some
    megabytes at a time, a longer text alone.
    """
    rows = documents.select(F.col(id_column), F.col(text_column).alias("_text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for begin, end in W.ranges(texts):
                part = texts.slice(begin, end - begin)
                counts, runs, collapsed = _runs_and_rest(part)
                columns = [batch.column(0).slice(begin, end - begin), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, runs, collapsed], [id_column, "n_words", "runs", "collapsed"]
                )

    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_words bigint, runs array<{_RUN}>, collapsed string"
    return W.small_batches(rows).mapInArrow(work, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; of equal ones the first. Null without runs."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(_RUN), better)


def planted(text: Column, id_column: Column) -> Column:
    """Texts of which a tenth, chosen by id, repeats a stretch of its words to the end.

    With ``h`` the unsigned CRC of the decimal id and ``g = h div 10``: where 10 divides h and the
    text has n > 0 words, word ``i >= a`` becomes word ``a + (i - a) % p``, where
    ``a = g % n`` and ``p = 1 + (n - a) div (3 + g % 8)``; the words are joined by one space.
    """
    h = F.crc32(id_column.cast("string"))
    g = F.call_function("div", h, F.lit(10))
    found = F.filter(F.split(text, _SPACE), lambda word: word != "")

    def rebuilt(own: Column) -> Column:
        n = F.size(own).cast("long")
        a = F.pmod(g, n)
        p = F.call_function("div", n - a, 3 + g % 8) + 1

        def word(i: Column) -> Column:
            return own[F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")]

        every = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), word)
        return F.when(n > 0, F.array_join(every, " ")).otherwise("")

    # Bound once by the outer function, so the text is taken apart once.
    return F.when(h % 10 == 0, F.transform(F.array(found), rebuilt)[0]).otherwise(text)
