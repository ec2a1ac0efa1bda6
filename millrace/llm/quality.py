"""Quality of a text by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W

#: Labelled rows the model is fitted on at most (about), and score from which a text is good.
SAMPLE, GOOD = 20_000, 0.7
#: Bins of a feature, rounds over all features and over all pairs, pairs kept,
#: step size, leaves of a tree, and weight that pulls leaves to 0.
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, STEP, LEAVES, PULL = 32, 120, 60, 6, 0.1, 4, 1.0

FEATURES = (
    "bytes words word_length letters digits symbols upper spaces distinct top_word odd_words "
    "short_words ends line_length repeated_lines shouted longest_word repeated_pairs wide"
).split()

_KIND = np.zeros(256, dtype=np.uint8)  # 0 other, 1 space, 2 digit, 3 upper, 4 lower, 5 wide
_KIND[[0x20, *range(0x09, 0x0E)]] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[ord("A") : ord("Z") + 1] = 3
_KIND[ord("a") : ord("z") + 1] = 4
_KIND[128:] = 5
_PLAIN = np.zeros(256, dtype=bool)  # signs that belong to ordinary prose
_PLAIN[[ord(c) for c in ".,;:?'\"()-"]] = True
_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".?!"]] = True


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[offsets[1:]] - total[offsets[:-1]]).astype("float64")


def _repeats(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text how many different values there are, and how often the commonest occurs."""
    different, most = np.zeros(len(counts)), np.zeros(len(counts))
    end = 0
    for i, n in enumerate(counts):
        begin, end = end, end + n
        if n:
            own = np.sort(hashes[begin:end])
            edges = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
            different[i], most[i] = len(edges) - 1, np.diff(edges).max()
    return different, most


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text, over its whole length; zeros for an empty one."""
    data, offsets = W.text_bytes(texts)
    size = np.diff(offsets).astype("float64")
    kind = _KIND[data]
    hashes, counts = W.word_hashes(data, offsets)
    starts, stops = W.word_places(data, offsets)
    length = stops - starts
    words = counts.astype("float64")
    at = np.concatenate(([0], np.cumsum(counts)))
    inside = np.concatenate(([0], np.cumsum(kind == 0, dtype=np.int64)))
    plain = np.concatenate(([0], np.cumsum(_PLAIN[data], dtype=np.int64)))
    lower = np.concatenate(([0], np.cumsum(kind == 4, dtype=np.int64)))
    upper = np.concatenate(([0], np.cumsum(kind == 3, dtype=np.int64)))
    strange = (inside[stops] - inside[starts]) > (plain[stops] - plain[starts])
    shouted = ((upper[stops] - upper[starts]) > 1) & (lower[stops] == lower[starts])

    different, most = _repeats(hashes, counts)
    pairs, runs = W.shingle_hashes(hashes, counts, 2)
    other_pairs, _ = _repeats(pairs, runs)
    line_hashes, lines = W.line_hashes(data, offsets)
    other_lines, _ = _repeats(line_hashes, lines)

    letters = _sums(kind >= 3, offsets)
    some = lambda part, whole: part / np.maximum(whole, 1)
    longest = np.zeros(len(size))
    full = np.flatnonzero(counts)
    if len(full):
        longest[full] = np.maximum.reduceat(length, at[full])
    columns = {
        "bytes": np.log1p(size),
        "words": np.log1p(words),
        "word_length": some(_sums(kind != 1, offsets), words),
        "letters": some(letters, size),
        "digits": some(_sums(kind == 2, offsets), size),
        "symbols": some(_sums((kind == 0) & ~_PLAIN[data], offsets), size),
        "upper": some(_sums(kind == 3, offsets), letters),
        "spaces": some(_sums(kind == 1, offsets), size),
        "distinct": some(different, np.sqrt(words)),
        "top_word": some(most, words),
        "odd_words": some(_sums(strange, at), words),
        "short_words": some(_sums(length <= 3, at), words),
        "ends": some(_sums(_END[data], offsets), words),
        "line_length": np.log1p(some(size, lines)),
        "repeated_lines": 1 - some(other_lines, lines),
        "shouted": some(_sums(shouted, at), words),
        "longest_word": np.log1p(longest),
        "repeated_pairs": 1 - some(other_pairs, runs),
        "wide": some(_sums(kind == 5, offsets), size),
    }
    return np.stack([columns[name] for name in FEATURES], axis=1)


class Model(NamedTuple):
    """Lookup tables: one for each feature, and one for each pair of features."""

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, rows: np.ndarray) -> list[np.ndarray]:
        columns = enumerate(self.edges)
        return [np.searchsorted(edges, rows[:, j], side="right") for j, edges in columns]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Chance of a good text: the sum of the tables' entries, as a logistic value."""
        bins = self.bins(rows)
        total = np.full(len(rows), self.start)
        for table, own in zip(self.tables, bins, strict=True):
            total += table[own]
        for table, (i, j) in zip(self.pair_tables, self.pairs, strict=True):
            total += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + PULL)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step for each bin: a tree of ``LEAVES`` leaves, split where it helps most."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(leaves):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h)
            at = int(gains.argmax())
            if (gain := gains[at] - _gain(all_g, all_h)) > best[0]:
                best = (gain, k, a + at + 1)
        if best[1] is None:
            break
        a, b = leaves.pop(best[1])
        leaves += [(a, best[2]), (best[2], b)]
    step = np.zeros(len(g))
    for a, b in leaves:
        step[a:b] = STEP * g[a:b].sum() / (h[a:b].sum() + PULL)
    return step


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step of the best tree with one cut on either feature of a pair."""
    sum_g, sum_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def parts(s: np.ndarray) -> list[np.ndarray]:
        corner, row, column, all_ = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1], s[-1, -1]
        return [corner, row - corner, column - corner, all_ - row - column + corner]

    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    gains = sum(_gain(a, b) for a, b in zip(parts(sum_g), parts(sum_h), strict=True))
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    step = np.zeros(g.shape)
    for rows in (slice(None, i + 1), slice(i + 1, None)):
        for columns in (slice(None, j + 1), slice(j + 1, None)):
            own = g[rows, columns].sum() / (h[rows, columns].sum() + PULL)
            step[rows, columns] = STEP * own
    return float(gains[i, j] - _gain(sum_g[-1, -1], sum_h[-1, -1])), step


def fitted(rows: np.ndarray, good: np.ndarray) -> Model:
    """Cyclic boosting: each round takes every feature in turn, then pairs likewise."""
    width = rows.shape[1]
    edges = []
    for j in range(width):
        cuts = np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1]) if len(rows) else []
        edges.append(np.unique(np.asarray(cuts, dtype="float64")))
    rate = float(np.clip(good.mean() if len(good) else 0.5, 0.001, 0.999))
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(float(np.log(rate / (1 - rate))), edges, tables, [], [])
    if not len(good) or good.min() == good.max():
        return model
    bins = model.bins(rows)
    total = np.full(len(good), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return good - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = slopes()
            n = len(tables[j])
            step = _tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            tables[j] += step
            total += step[bins[j]]

    def pair_step(i: int, j: int) -> tuple[float, np.ndarray]:
        g, h = slopes()
        shape = (len(tables[i]), len(tables[j]))
        cell = bins[i] * shape[1] + bins[j]
        n = shape[0] * shape[1]
        return _quarters(
            np.bincount(cell, g, n).reshape(shape), np.bincount(cell, h, n).reshape(shape)
        )

    gains = sorted(
        ((pair_step(i, j)[0], i, j) for i in range(width) for j in range(i)), reverse=True
    )
    for _, i, j in gains[:PAIRS]:
        model.pairs.append((i, j))
        model.pair_tables.append(np.zeros((len(tables[i]), len(tables[j]))))
    for _ in range(PAIR_ROUNDS):
        for table, (i, j) in zip(model.pair_tables, model.pairs, strict=True):
            _, step = pair_step(i, j)
            table += step
            total += step[bins[i], bins[j]]
    return model


def _featured(rows: DataFrame) -> DataFrame:
    """Rows ``label, text`` as ``label, x``."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in W.ranges(batch.column(1)):
                part = batch.slice(begin, end - begin)
                x = features(part.column(1))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), len(FEATURES))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists.cast(pa.list_(pa.float64()))], names=["label", "x"]
                )

    return W.small_batches(rows).select("label", "text").mapInArrow(take, "label double, x array<double>")


def learn(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> Model:
    """Fit on labelled documents, about ``SAMPLE`` of them by a hash of the id.

    Rows without an id or a label are left out.  The labels taken are at most a
    few megabytes and go to the documents, which are not shuffled.
    """
    known = labels.select(
        F.col(id_column).alias("id"), F.col(label_column).cast("double").alias("label")
    ).filter("id IS NOT NULL AND label IS NOT NULL")
    step = -(-max(1, known.count()) // SAMPLE)
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(step)) == 0)
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    taken = _featured(rows.join(F.broadcast(chosen), "id")).toArrow()
    x = np.array(taken.column("x").to_pylist(), dtype="float64").reshape(-1, len(FEATURES))
    good = (taken.column("label").to_numpy() >= 0.5).astype("float64")
    order = np.lexsort((*x.T, good))  # the same model in whatever order the rows come
    return fitted(x[order], good[order])


def chance(text: Column, model: Model) -> Column:
    """Chance (0 to 1) that a text is good; a null text is an empty one."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [
            model.score(features(texts.slice(begin, end - begin)))
            for begin, end in W.ranges(texts)
        ]
        return pa.array(np.round(np.concatenate([np.zeros(0), *parts]), 6))

    return score(text)


def scored(
    documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """For each row its id, ``score double`` (0 to 1) and ``predicted int`` (score >= ``GOOD``).

    Features are counts over the bytes, words and lines of the whole text; the
    model adds one table entry for each feature and pair.  A null text is an
    empty one.  Without labelled rows, or with one kind of label only, every
    score is the share of good labels, or 0.5.  Every row gives one row,
    repeated and null ids too; an empty table gives none.  Only id and text are
    read, nothing is shuffled.
    """
    score = chance(F.col(text_column), model)
    good = (F.col("score") >= GOOD).cast("int")
    rows = W.small_batches(documents)
    return rows.select(id_column, score.alias("score")).withColumn("predicted", good)


def good_only(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows with a good text, with all their columns (see ``scored``); nothing is shuffled."""
    return W.small_batches(documents).filter(chance(F.col(text_column), model) >= GOOD)
