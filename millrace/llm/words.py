"""Words of whole texts as 64-bit hashes, computed for a batch of texts at once."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes hashed at a time; a longer word is taken whole.
PIECE = 1 << 20
#: Bytes of texts taken apart together, which bounds a task's memory; a longer
#: text is taken alone.
TOGETHER = 1 << 20

#: Bytes of a batch that Spark hands to Python, and the setting for it.
BATCH, _SETTING = 1 << 22, "spark.sql.execution.arrow.maxBytesPerBatch"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Every bit of a 64-bit value spread over the whole value."""
    x = values + np.uint64((salt * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def small_batches(rows: DataFrame) -> DataFrame:
    """The rows themselves; the session's Arrow batches hold ``BATCH`` bytes at most from now on.

    Batches stand in the memory of JVM and Python several times over, and Spark
    fills them with up to eight times as much by default.  A smaller limit that
    the session has, in plain bytes, stays.
    """
    conf = rows.sparkSession.conf
    limit = conf.get(_SETTING, str(2 * BATCH))
    if not limit.isdigit() or int(limit) > BATCH:
        conf.set(_SETTING, str(BATCH))
    return rows


def give_back() -> None:
    """Return freed memory to the system.

    Python workers live on after a task, and what their allocators keep would
    stand beside the memory of the stages that follow.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def one_thread() -> None:
    """Let numpy's matrix products stay on the task's own core.

    Threads that wait for one another on small products take CPU time and give
    no result; other cores have tasks of their own.
    """
    for path in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        with suppress(OSError, AttributeError):  # another library of matrix products
            ctypes.CDLL(str(path)).scipy_openblas_set_num_threads64_(1)


def ranges(texts: pa.Array, size: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes of text, whatever the length of a text."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(ends):
        full = (ends[begin - 1] if begin else 0) + size
        end = max(begin + 1, int(np.searchsorted(ends, full, side="right")))
        yield begin, end
        begin = end
    give_back()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts behind one another, and where each begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    plain = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(plain.buffers()[1], dtype=np.int64)
    offsets = offsets[plain.offset : plain.offset + len(plain) + 1]
    if plain.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(plain) + 1, dtype=np.int64)
    data = np.frombuffer(plain.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _powers(factor: int, n: int) -> np.ndarray:
    steps = np.full(n, factor % (1 << 64), dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > PIECE + 1:  # one very long word: not worth keeping
        return _powers(_FACTOR, n), _powers(_INVERSE, n)
    if PIECE not in _POWERS:
        _POWERS[PIECE] = _powers(_FACTOR, PIECE + 1), _powers(_INVERSE, PIECE + 1)
    return _POWERS[PIECE]


def _pieces(breaks: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE`` bytes that end where no word goes on."""
    begin = 0
    while begin < size:
        end = begin + PIECE
        if end < size:
            at = np.searchsorted(breaks, end, side="right") - 1
            if at < 0 or breaks[at] <= begin:
                at = np.searchsorted(breaks, begin, side="right")
            end = int(breaks[at]) if at < len(breaks) else size
        yield begin, min(end, size)
        begin = end


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of all texts begin and end; a word never goes on in the next text."""
    return _places(_SPACE[data], offsets)


def word_numbers(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.DictionaryArray:
    """The words themselves as they are written; equal words have one number."""
    offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int64)
    plain = np.ascontiguousarray(data[~_SPACE[data]])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(plain)]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers)
    return found.dictionary_encode()


def _places(space: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, last = ~space, ~space
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    filled = offsets[1:] > offsets[:-1]
    for edge, places in ((first, offsets[:-1][filled]), (last, offsets[1:][filled] - 1)):
        edge[places] = ~space[places]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashes(
    data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, stops: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.empty(len(starts), dtype=np.uint64)
    for begin, end in _pieces(starts, len(data)):
        a, b = np.searchsorted(starts, (begin, end))
        if a == b:
            continue
        up, down = power_tables(end - begin + 1)
        sums = np.zeros(end - begin + 1, dtype=np.uint64)
        values = _LOWER[data[begin:end]]
        values += np.uint64(1)
        values *= up[: end - begin]
        np.cumsum(values, out=sums[1:])
        head, tail = starts[a:b] - begin, stops[a:b] - begin
        hashes[a:b] = (sums[tail] - sums[head]) * down[head]
    return mixed(hashes), np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (ASCII lower case), and how many words each text has."""
    return _hashes(data, offsets, *word_places(data, offsets))


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of the lines that are not empty."""
    return _hashes(data, offsets, *_places(data == 0x0A, offsets))


def shingle_hashes(
    hashes: np.ndarray, counts: np.ndarray, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``words`` words, and how many runs each text has.

    A text with fewer words, but at least one, has its whole sequence as its one run.
    """
    counts = counts.astype(np.int64)
    runs = np.maximum(counts - words + 1, np.minimum(counts, 1))
    starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    firsts = np.repeat(starts - np.concatenate(([0], np.cumsum(runs)))[:-1], runs)
    firsts += np.arange(len(firsts))
    length = np.repeat(np.minimum(counts, words), runs)
    total = mixed(length.astype(np.uint64), words)
    for k in range(words):
        inside = k < length
        at = np.where(inside, firsts + k, 0)
        step = mixed(total * np.uint64(_FACTOR) + (hashes[at] if len(hashes) else 0), k)
        total = np.where(inside, step, total)
    return total, runs


def distinct_sets(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted and once each, and how many there are."""
    out, sizes = [], np.zeros(len(counts), dtype=np.int64)
    end = 0
    for i, n in enumerate(counts):
        begin, end = end, end + n
        if n:
            own = np.sort(values[begin:end])
            if n > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            out.append(own)
            sizes[i] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)), sizes
