"""Language of a text: known words first, then ever shorter character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored
from . import words as W

#: Longest n-gram, cost of a word or n-gram that a language has not, training
#: texts of a language at most (about), and entries kept of each language for
#: words and for each length of n-gram.
LONGEST, PENALTY, TEXTS, ENTRIES = 5, 7.0, 2000, 20_000

#: Characters taken apart at a time.
_PIECE = 1 << 19

_LETTER: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0][codes]


class Model(NamedTuple):
    """Costs (minus log10 of the relative frequency) of known words and n-grams."""

    languages: list[str]
    keys: np.ndarray  # hashes in order
    costs: np.ndarray  # one row for each key, one column for each language


class Words(NamedTuple):
    """Words of some texts: where their letters are, their hashes and their texts."""

    codes: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    hashes: np.ndarray
    owners: np.ndarray


def _span_hashes(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray, kind: int) -> np.ndarray:
    up, down = W.power_tables(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    values = codes.astype(np.uint64)
    values += np.uint64(1)
    values *= up[: len(codes)]
    np.cumsum(values, out=sums[1:])
    return W.mixed((sums[stops] - sums[starts]) * down[starts], 100 + kind)


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces that end between words, unless a word is longer than a piece."""
    begin = 0
    while len(text) - begin > _PIECE:
        end = begin + _PIECE
        cut = max(text.rfind(" ", begin, end), text.rfind("\n", begin, end)) + 1
        end = cut if cut > begin else end
        yield text[begin:end]
        begin = end
    yield text[begin:]


def _groups(texts: list[str | None]) -> Iterator[tuple[list[str], list[int]]]:
    """Lower-case pieces of texts with their owners, some ``_PIECE`` characters at a time."""
    parts, owners, size = [], [], 0
    for owner, text in enumerate(texts):
        for piece in _pieces((text or "").lower()):
            parts.append(piece)
            owners.append(owner)
            size += len(piece)
            if size >= _PIECE:
                yield parts, owners
                parts, owners, size = [], [], 0
    if parts:
        yield parts, owners


def _words(parts: list[str], owners: list[int]) -> Words:
    """Runs of letters."""
    codes = np.frombuffer("\n".join([*parts, ""]).encode("utf-32-le"), dtype=np.uint32)
    letter = np.concatenate(([False], _is_letter(codes), [False]))
    starts = np.flatnonzero(letter[1:-1] & ~letter[:-2])
    stops = np.flatnonzero(letter[1:-1] & ~letter[2:]) + 1
    ends = np.cumsum([len(part) + 1 for part in parts])
    owner = np.asarray(owners)[np.searchsorted(ends, starts, side="right")]
    return Words(codes, starts, stops, _span_hashes(codes, starts, stops, 0), owner)


def _padded(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chosen words with a space on both sides, one after another."""
    sizes = words.stops[chosen] - words.starts[chosen]
    begins = np.concatenate(([0], np.cumsum(sizes + 2)))[:-1]
    codes = np.full(int((sizes + 2).sum()), 32, dtype=np.uint32)
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    codes[np.repeat(begins + 1, sizes) + inner] = words.codes[
        np.repeat(words.starts[chosen], sizes) + inner
    ]
    return codes, begins, begins + sizes + 2


def _grams(
    codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of padded words, and the word of each; no lone spaces."""
    if n == 1:
        begins, ends = begins + 1, ends - 1
    counts = np.maximum(ends - begins - n + 1, 0)
    owner = np.repeat(np.arange(len(begins)), counts)
    at = np.repeat(begins, counts) + np.arange(len(owner))
    at -= np.repeat(np.cumsum(counts) - counts, counts)
    return _span_hashes(codes, at, at + n, n), owner


def counted(texts: DataFrame) -> DataFrame:
    """For rows ``lang, text``: ``lang, kind, key, n``, how often words (kind 0) and
    n-grams (kind n) occur, added up for each batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(batch.column(1).to_pylist(), langs, strict=True) if x == lang]
                for parts, owners in _groups(own):
                    words = _words(parts, owners)
                    keys, times = np.unique(words.hashes, return_counts=True)
                    found = [(0, keys, times)]
                    _, first, times = np.unique(
                        words.hashes, return_index=True, return_counts=True
                    )
                    padded = _padded(words, first)
                    for n in range(1, LONGEST + 1):
                        grams, owner = _grams(*padded, n)
                        keys, place = np.unique(grams, return_inverse=True)
                        sums = np.bincount(place, times[owner], len(keys)).astype(np.int64)
                        found.append((n, keys, sums))
                    for kind, keys, sums in found:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * len(keys), pa.string()),
                                pa.array(np.full(len(keys), kind, dtype=np.int32)),
                                pa.array(keys.view(np.int64)),
                                pa.array(sums),
                            ],
                            names=["lang", "kind", "key", "n"],
                        )

    return W.small_batches(texts).select("lang", "text").mapInArrow(
        count, "lang string, kind int, key bigint, n bigint"
    )


def learn(documents: DataFrame, text_column: str = "text", lang_column: str = "lang") -> Model:
    """Fit on rows with a text and a language.

    Of each language about ``TEXTS`` different texts are taken, by a hash of the
    text, and all of them where there are fewer; copies of a text count once.  Of
    what they hold the ``ENTRIES`` most frequent words and n-grams of each
    length are kept; words must occur twice, so that the n-grams also see the rare ones
    as what they are.  The model is thus bounded by the number of languages.
    """
    rows = documents.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.withColumn("at", F.xxhash64("text"))
    different = rows.groupBy("lang").agg(F.count_distinct("at").alias("texts"))
    sizes = different.collect()  # one row for each language
    step = F.lit(1)
    for row in sizes:
        step = F.when(F.col("lang") == row["lang"], max(1, row["texts"] // TEXTS)).otherwise(step)
    chosen = rows.filter(F.pmod("at", step) == 0).groupBy("lang", "at").agg(F.min("text").alias("text"))
    sums = stored(
        counted(chosen).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "grams"
    )
    totals = {(r["lang"], r["kind"]): r["n"] for r in sums.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    top = (
        sums.filter("kind > 0 OR n > 1")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= ENTRIES)
        .select("lang", "kind", "key", "n")
        .toArrow()  # ENTRIES rows for each language and length
    )
    languages = sorted(row["lang"] for row in sizes)
    keys = top.column("key").to_numpy().view(np.uint64)
    known, place = np.unique(keys, return_inverse=True)
    costs = np.full((len(known), len(languages)), PENALTY)
    langs = np.array([languages.index(x) for x in top.column("lang").to_pylist()], dtype=np.int64)
    all_of = np.array(
        [
            totals[lang, kind]
            for lang, kind in zip(
                top.column("lang").to_pylist(), top.column("kind").to_pylist(), strict=True
            )
        ],
        dtype=np.float64,
    )
    if len(known):
        costs[place, langs] = -np.log10(top.column("n").to_numpy() / all_of)
    return Model(languages, known, costs)


def _found(model: Model, hashes: np.ndarray) -> np.ndarray:
    """Row of each hash in the model, -1 for an unknown one."""
    at = np.searchsorted(model.keys, hashes)
    at[at == len(model.keys)] = 0
    return np.where(model.keys[at] == hashes, at, -1)


def word_costs(model: Model, words: Words) -> np.ndarray:
    """The cost of each word in each language.

    A word that any language knows has its own costs.  Another has the mean of
    its longest n-grams if one of them is known, else of the next shorter ones;
    a word without any known character costs the same everywhere.
    """
    rows = _found(model, words.hashes)
    costs = model.costs[rows]
    new = np.flatnonzero(rows < 0)
    if not len(new):
        return costs
    _, first, back = np.unique(words.hashes[new], return_index=True, return_inverse=True)
    own = np.full((len(first), len(model.languages)), PENALTY)
    left = np.arange(len(first))
    for n in range(LONGEST, 0, -1):
        if not len(left):
            break
        grams, owner = _grams(*_padded(words, new[first[left]]), n)
        at = _found(model, grams)
        owner, at = owner[at >= 0], at[at >= 0]
        hits = np.bincount(owner, minlength=len(left))
        done = hits > 0
        for j in range(own.shape[1]):
            sums = np.bincount(owner, model.costs[at, j], len(left))
            own[left[done], j] = sums[done] / hits[done]
        left = left[~done]
    costs[new] = own[back]
    return costs


def _predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    n, width = len(texts), len(model.languages)
    sums, counts = np.zeros((n, width)), np.zeros(n)
    for parts, owners in _groups(texts):
        words = _words(parts, owners)
        if len(words.hashes) and len(model.keys):
            costs = word_costs(model, words)
            for j in range(width):
                sums[:, j] += np.bincount(words.owners, costs[:, j], n)
        counts += np.bincount(words.owners, minlength=n)
    if not width:
        return ["und"] * n, np.zeros(n)
    best = sums.argmin(axis=1)
    gap = (sums - sums.min(axis=1, keepdims=True)) * np.log(10)
    score = 1 / np.exp(-np.minimum(gap, 700)).sum(axis=1)
    names = [model.languages[b] if c else "und" for b, c in zip(best, counts, strict=True)]
    return names, np.where(counts > 0, np.round(score, 6), 0.0)


def predicted(
    documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """For each row its id, ``lang_pred string`` and ``score double``.

    A word is a run of letters in lower case.  The language with the smallest
    sum of word costs over the whole text is predicted, of equal ones the first
    by name; ``score`` is its share of the likelihood (0 to 1).  A null text or
    one without a letter is ``und`` with score 0, and so is every text if no
    language was learned.  Every row gives one row, repeated and null ids too;
    an empty table gives none.  Only id and text are read, nothing is shuffled.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in W.ranges(batch.column(1)):
                part = batch.slice(begin, end - begin)
                names, scores = _predict(model, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores)],
                    names=["id", "lang_pred", "score"],
                )

    rows = W.small_batches(documents).select(id_column, text_column)
    kind = rows.schema[0].dataType.simpleString()
    found = rows.mapInArrow(predict, f"id {kind}, lang_pred string, score double")
    return found.withColumnRenamed("id", id_column)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept from learning: a quarter, by the checksum of its id."""
    checksum = F.crc32(F.col(id_column).cast("string"))
    return F.coalesce(checksum % 4 == 2, F.lit(False))
