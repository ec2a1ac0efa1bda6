"""Pseudo-likelihood of texts: every word predicted from the words on both sides."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from . import words as W

#: Tokens: words with a number of their own, and classes of all other words.
KNOWN, RARE = 768, 256
TOKENS = KNOWN + RARE
#: A token is a group of ``MEMBERS`` and a place in it, predicted one after the other.
MEMBERS = 32
GROUPS = TOKENS // MEMBERS
#: Words seen on each side, numbers of a word, numbers of the hidden layer.
SIDE, WIDTH, HIDDEN = 2, 16, 32
#: Rounds of training, windows of a step, and the step's size.  Each round takes
#: its own share of the places of every text, so training predicts each place once.
ROUNDS, STEP_ROWS, STEP = 2, 1024, 0.1
#: Tokens of a shard of the corpus that is trained on in one go (about), tasks
#: that they are dealt to at most, and words whose counts go to the tasks.
SHARD, TASKS, FREQUENT = 1 << 21, 1 << 14, 1 << 16

#: Tokens taken apart at a time, tokens scored at a time, and the token of a
#: place outside of the text.
_CHUNK, _SCORED, _OUTSIDE = 1 << 16, 1 << 13, TOKENS

#: Sums of weights are added up as whole numbers, so that their order is all one.
_UNIT = 1 << 24


class Vocabulary(NamedTuple):
    """Known words by hash with their tokens, and the tokens of the other classes."""

    hashes: np.ndarray
    tokens: np.ndarray
    rare: np.ndarray
    counts: np.ndarray  # of each token
    frequent: np.ndarray  # hashes of the most frequent words that are not known, in order
    chances: np.ndarray  # of each of them within its class, in units of 1 / _UNIT

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The token of each word, and whether the word is one of a class."""
        out = self.rare[(hashes >> np.uint64(32)) % np.uint64(RARE)]
        rare = np.ones(len(hashes), dtype=bool)
        if len(self.hashes):
            at = np.searchsorted(self.hashes, hashes)
            at[at == len(self.hashes)] = 0
            rare = self.hashes[at] != hashes
            out = np.where(rare, out, self.tokens[at])
        return out, rare

    def inner(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chance of each word within its class, and whether it is a frequent one; else 0."""
        if not len(self.frequent):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.searchsorted(self.frequent, hashes)
        at[at == len(self.frequent)] = 0
        found = self.frequent[at] == hashes
        return np.where(found, self.chances[at], 0), found


class Network(NamedTuple):
    """Weights: words, window to hidden layer, hidden layer to groups and to members."""

    words: np.ndarray
    window: np.ndarray
    window_bias: np.ndarray
    groups: np.ndarray
    groups_bias: np.ndarray
    members: np.ndarray
    members_bias: np.ndarray

    @classmethod
    def begin(cls, counts: np.ndarray) -> Network:
        """Small random weights; the biases alone give each token its share of all words."""
        random = np.random.default_rng(4)
        table = (counts + 1.0).reshape(GROUPS, MEMBERS)
        whole = table.sum(axis=1)
        parts = (
            random.normal(0, 0.3, (TOKENS + 1, WIDTH)),
            random.normal(0, 0.1, (2 * SIDE * WIDTH, HIDDEN)),
            np.zeros(HIDDEN),
            np.zeros((HIDDEN, GROUPS)),
            np.log(whole / whole.sum()),
            np.zeros((GROUPS, HIDDEN, MEMBERS)),
            np.log(table / whole[:, None]),
        )
        return cls(*(part.astype("float32") for part in parts))

    def flat(self) -> np.ndarray:
        return np.concatenate([part.reshape(-1) for part in self])

    def like(self, values: np.ndarray) -> Network:
        """A network of these weights; ``float32`` ones are not copied."""
        out, at = [], 0
        for part in self:
            own = values[at : at + part.size].reshape(part.shape)
            out.append(own.astype("float32", copy=False))
            at += part.size
        return Network(*out)


def _softmax(logits: np.ndarray) -> np.ndarray:
    if logits.size and (logits.max() > 60 or logits.min() < -60):  # near what float32 holds
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(logits.shape[1], dtype=logits.dtype))[:, None]
    return logits


def _by_group(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of the targets by group, and where each group that occurs stands in it."""
    order = np.argsort(targets.astype(np.int16), kind="stable")
    edges = np.searchsorted(targets[order] // MEMBERS, np.arange(GROUPS + 1)).tolist()
    spans = [(g, slice(edges[g], edges[g + 1])) for g in range(GROUPS)]
    return order, [(g, own) for g, own in spans if own.start < own.stop]


def _forward(
    net: Network, windows: np.ndarray, group: np.ndarray, spans: list[tuple[int, slice]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words seen, hidden layer, and chances of groups and of the members of each row's group."""
    seen = net.words.take(windows.reshape(-1), axis=0).reshape(len(windows), -1)
    hidden = seen @ net.window
    hidden += net.window_bias
    np.tanh(hidden, out=hidden)
    groups = hidden @ net.groups
    groups += net.groups_bias
    members = net.members_bias[group]
    for g, own in spans:
        members[own] += hidden[own] @ net.members[g]
    return seen, hidden, _softmax(groups), _softmax(members)


def log_chances(net: Network, windows: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Logarithm of the chance of each target between its neighbours."""
    order, spans = _by_group(targets)
    rows, targets = np.arange(len(targets)), targets[order]
    group = targets // MEMBERS
    _, _, groups, members = _forward(net, windows[order], group, spans)
    chance = groups[rows, group] * members[rows, targets % MEMBERS]
    out = np.empty_like(chance)
    out[order] = np.log(np.maximum(chance, 1e-30))
    return out


def _slopes(net: Network, windows: np.ndarray, targets: np.ndarray) -> Network:
    """How the mean logarithm grows with each weight."""
    n = len(targets)
    order, spans = _by_group(targets)
    rows, windows, targets = np.arange(n), windows[order], targets[order]
    group = targets // MEMBERS
    seen, hidden, off, miss = _forward(net, windows, group, spans)
    np.negative(off, out=off)
    off[rows, group] += 1
    np.negative(miss, out=miss)
    miss[rows, targets % MEMBERS] += 1
    back = off @ net.groups.T
    members, members_bias = np.zeros_like(net.members), np.zeros_like(net.members_bias)
    for g, own in spans:
        np.matmul(hidden[own].T, miss[own], out=members[g])
        back[own] += miss[own] @ net.members[g].T
    filled = [g for g, _ in spans]
    members_bias[filled] = np.add.reduceat(miss, [own.start for _, own in spans], axis=0)
    back *= 1 - hidden * hidden
    flat = windows.reshape(-1).astype(np.int16)
    by_word = np.argsort(flat, kind="stable")
    flat = flat[by_word]
    begins = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    deep = (back @ net.window.T).reshape(-1, WIDTH).take(by_word, axis=0)
    words = np.zeros_like(net.words)
    words[flat[begins]] = np.add.reduceat(deep, begins, axis=0)
    parts = (
        words,
        seen.T @ back,
        back.sum(axis=0),
        hidden.T @ off,
        off.sum(axis=0),
        members,
        members_bias,
    )
    return Network(*((part / n).astype("float32") for part in parts))


class _Trainer:
    """Steps scaled by the squares of the slopes so far (Adagrad), on one shard's windows.

    Every step but the last takes ``STEP_ROWS`` windows, however they come in.
    """

    def __init__(self, net: Network) -> None:
        self._weights = net.flat()
        self._squares = np.full_like(self._weights, 1e-3)
        self.net = net.like(self._weights)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._rows = 0
        self.seen = 0

    def add(self, windows: np.ndarray, targets: np.ndarray) -> None:
        self._waiting.append((windows, targets))
        self._rows += len(targets)
        if self._rows >= STEP_ROWS:
            self._steps(self._rows - self._rows % STEP_ROWS)

    def finish(self) -> None:
        if self._rows:
            self._steps(self._rows)

    def _steps(self, rows: int) -> None:
        windows, targets = (np.concatenate(x) for x in zip(*self._waiting, strict=True))
        for begin in range(0, rows, STEP_ROWS):
            part = slice(begin, min(begin + STEP_ROWS, rows))
            slopes = _slopes(self.net, windows[part], targets[part])
            slope = slopes.flat()
            self._squares += slope * slope
            slope *= STEP
            slope /= np.sqrt(self._squares)
            self._weights += slope
        self.seen += rows
        self._waiting, self._rows = [(windows[rows:], targets[rows:])], len(targets) - rows


def windows_of(tokens: np.ndarray, counts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The neighbours of each place; beyond the text's ends there is the outside."""
    ends = np.cumsum(counts)
    text = np.searchsorted(ends, places, side="right")
    begin, end = (ends - counts)[text], ends[text]
    out = np.empty((len(places), 2 * SIDE), dtype=np.int32)
    for column, k in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        at = places + k
        inside = (at >= begin) & (at < end)
        out[:, column] = np.where(inside, tokens[np.where(inside, at, 0)], _OUTSIDE)
    return out


def word_counts(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """``word, n``: how often each word (its hash) occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in W.ranges(batch.column(0), 4 * W.TOGETHER):
                texts = batch.column(0).slice(begin, end - begin)
                hashes, _ = W.word_hashes(*W.text_bytes(texts))
                words, n = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["word", "n"],
                )

    rows = W.small_batches(documents).select(text_column).mapInArrow(count, "word bigint, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _kind() -> Column:
    """Number of the class that a word would have."""
    return F.pmod(F.shiftrightunsigned("word", 32), F.lit(RARE)).cast("int")


def vocabulary(documents: DataFrame, text_column: str = "text") -> Vocabulary:
    """The most frequent words of all texts, and classes of the others by hash.

    Every word of every text is counted; ``KNOWN`` words, ``FREQUENT`` more at
    most and sums by class come to the driver.  Tokens are numbered by their counts.
    """
    return _chosen(stored(word_counts(documents, text_column), "words"))


def _chosen(counts: DataFrame) -> Vocabulary:
    # Words by class and by how often they occur, in eighths of doublings: some
    # hundred steps a class, whatever the corpus.
    step = F.floor(F.log2("n") * 8)
    sums = (
        counts.groupBy(_kind().alias("kind"), step.alias("step"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("words"))
        .toArrow()
    )
    kinds, steps, n, words = (sums.column(name).to_numpy() for name in sums.column_names)
    classes = np.zeros(RARE, dtype=np.int64)
    np.add.at(classes, kinds, n)
    sizes = dict.fromkeys(sorted(set(steps.tolist()), reverse=True), 0)
    for at, size in zip(steps.tolist(), words.tolist(), strict=True):
        sizes[at] += size
    above = np.cumsum(list(sizes.values()))
    all_steps = list(sizes)
    far = int(np.searchsorted(above, KNOWN))  # the step at which there are KNOWN words
    least = all_steps[min(far, len(all_steps) - 1)] if all_steps else 0
    top = counts.filter(step >= least).orderBy(F.desc("n"), "word").limit(KNOWN).toArrow()
    own = top.column("word").to_numpy().view(np.uint64)
    own_n = top.column("n").to_numpy()
    places = ((own >> np.uint64(32)) % np.uint64(RARE)).astype(np.int64)
    np.subtract.at(classes, places, own_n)
    every = np.concatenate((own_n, np.zeros(KNOWN - len(own_n), dtype=np.int64), classes))
    order = np.argsort(-every, kind="stable")
    token = np.empty(TOKENS, dtype=np.int32)
    token[order] = np.arange(TOKENS)
    by_hash = np.argsort(own)
    # All words of the steps that hold FREQUENT words together at most.
    near = int(np.searchsorted(above, KNOWN + FREQUENT, side="right"))
    frequent, chances = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    if near:
        more = counts.filter(step >= all_steps[near - 1]).toArrow()
        frequent = more.column("word").to_numpy().view(np.uint64)
        n = more.column("n").to_numpy()
        rest = ~np.isin(frequent, own)
        frequent, n = frequent[rest], n[rest]
        whole = classes[((frequent >> np.uint64(32)) % np.uint64(RARE)).astype(np.int64)]
        chances = np.round((np.log(n) - np.log(whole)) * _UNIT).astype(np.int64)
        in_order = np.argsort(frequent)
        frequent, chances = frequent[in_order], chances[in_order]
    return Vocabulary(
        own[by_hash], token[: len(own)][by_hash], token[KNOWN:], every[order], frequent, chances
    )


def _distinct(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each owner's words once each, their owners in order, and how often each occurs."""
    order = np.lexsort((words, owner))
    words, owner = words[order], owner[order]
    begins = np.concatenate(([True], (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])))
    at = np.flatnonzero(begins[: len(words)])
    return words[at], owner[at], np.diff(np.append(at, len(words)))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def token_rows(
    documents: DataFrame, words: Vocabulary, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, tokens array<smallint>, found bigint, rare array<bigint>, times array<int>``
    of every text.

    ``found`` adds up the chances, within their classes, of the text's frequent
    words; ``rare`` holds its words that are neither known nor frequent, once
    each, and ``times`` how often each of them occurs in it.
    """

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in W.ranges(batch.column(1)):
                part = batch.slice(begin, end - begin)
                hashes, counts = W.word_hashes(*W.text_bytes(part.column(1)))
                tokens, rare = words.of(hashes)
                owner = np.repeat(np.arange(len(counts)), counts)[rare]
                hashes = hashes[rare]
                chances, frequent = words.inner(hashes)
                found = np.zeros(len(counts), dtype=np.int64)
                np.add.at(found, owner, chances)
                rare, owner, times = _distinct(hashes[~frequent].view(np.int64), owner[~frequent])
                each = np.bincount(owner, minlength=len(counts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        _lists(tokens.astype(np.int16), counts),
                        pa.array(found),
                        _lists(rare, each),
                        _lists(times.astype(np.int32), each),
                    ],
                    names=["id", "tokens", "found", "rare", "times"],
                )

    rows = W.small_batches(documents).select(id_column, text_column)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(
        take,
        f"id {kind}, tokens array<smallint>, found bigint, rare array<bigint>, times array<int>",
    )


def _inner(rows: DataFrame, counts: DataFrame, words: Vocabulary) -> DataFrame:
    """``row, inner bigint``: sum over a row's rare words of the logarithm of their chance
    within their class, in units of ``1 / _UNIT``.

    A word's chance is its share of all occurrences of its class.  Every word
    that is scored has been counted, so the chances of a class add up to 1 and
    need no smoothing.  Words meet their counts by hash; the most frequent
    words are not among them, so no key of the join is a hot one.
    """
    sums = [float(n) for n in words.counts[words.rare]]
    share = F.log("n") - F.log(F.get(F.lit(sums), _kind()))
    chances = counts.select("word", F.round(share * _UNIT).cast("bigint").alias("chance"))
    each = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("own")).select(
        "row", F.col("own.rare").alias("word"), F.col("own.times").alias("times")
    )
    found = each.join(chances, "word").withColumn("part", F.col("chance") * F.col("times"))
    return found.groupBy("row").agg(F.sum("part").alias("inner"))


def _tokens(lists: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows with their tokens and counts, some ``_CHUNK`` tokens at a time."""
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        full = (ends[begin - 1] if begin else 0) + _CHUNK
        end = max(begin + 1, int(np.searchsorted(ends, full, side="right")))
        part = lists.slice(begin, end - begin)
        yield begin, end, part.flatten().to_numpy().astype(np.int32), sizes[begin:end]
        begin = end


def _dealt(rows: DataFrame, shards: int) -> DataFrame:
    """``tokens, shard``: each shard in one task, in the order of a hash of the tokens.

    What a shard holds, and in which order, depends on the rows alone, not on
    files or tasks: rows of one hash have the same tokens.  The shard also goes
    by the id, so that the copies of a text are in all of them.
    """
    shard = F.pmod(F.xxhash64("tokens", "id"), F.lit(shards)).cast("int")
    dealt = rows.select("tokens", shard.alias("shard"), F.xxhash64("tokens").alias("at"))
    tasks = min(shards, TASKS)
    dealt = dealt.repartitionById(tasks, F.col("shard") % tasks)
    return dealt.sortWithinPartitions("shard", "at").select("tokens", "shard")


def _trained(rows: DataFrame, net: Network, turn: int, shards: int = 1) -> DataFrame:
    """``seen, weights`` after the steps over each shard."""

    def row(trainer: _Trainer) -> pa.RecordBatch:
        trainer.finish()
        weights = trainer.net.flat().astype(np.float64)
        seen = [trainer.seen] if trainer.seen else []
        return pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array([weights][: len(seen)], pa.list_(pa.float64()))],
            names=["seen", "weights"],
        )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W.one_thread()
        trainer, shard = _Trainer(net), None
        for batch in batches:
            own_shard = batch.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(own_shard)) + 1
            for begin, end in zip([0, *edges], [*edges, len(own_shard)], strict=True):
                if begin == end:
                    continue
                if own_shard[begin] != shard:
                    if shard is not None:
                        yield row(trainer)
                    trainer, shard = _Trainer(net), own_shard[begin]
                for _, _, tokens, sizes in _tokens(batch.column(0).slice(begin, end - begin)):
                    place = np.arange(len(tokens), dtype=np.uint64)
                    inner = place - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.uint64)
                    mark = W.mixed(inner * np.uint64(TOKENS) + tokens.astype(np.uint64), 40)
                    places = np.flatnonzero(mark % np.uint64(ROUNDS) == turn)
                    for at in range(0, len(places), _CHUNK):
                        own = places[at : at + _CHUNK]
                        trainer.add(windows_of(tokens, sizes, own), tokens[own])
        yield row(trainer)

    return _dealt(rows, shards).mapInArrow(train, "seen bigint, weights array<double>")


def fitted(rows: DataFrame, words: Vocabulary) -> Network:
    """Train on the tokens of all texts.

    The rows are dealt into shards of some ``SHARD`` tokens (see ``_dealt``).  In
    each of ``ROUNDS`` rounds every shard starts from the same weights and takes
    its steps in order; the round ends with the mean of the shards' weights,
    each by the windows it saw.  The steps of a shard do not depend on the
    input's size, nor on how it is cut into files; what a shard hands over is the
    size of the network.
    """
    net = Network.begin(words.counts)
    shards = max(1, -(-int(words.counts.sum()) // SHARD))
    for turn in range(ROUNDS):
        trained = stored(_trained(rows, net, turn, shards), "trained")
        seen = trained.agg(F.sum("seen")).first()[0]
        if not seen:
            return net
        each = trained.select("seen", F.posexplode("weights").alias("place", "weight"))
        amount = F.round(F.col("weight") * F.col("seen") / seen * _UNIT).cast("bigint")
        sums = each.groupBy("place").agg(F.sum(amount).alias("sum")).toArrow()
        weights = np.zeros(net.flat().size)
        weights[sums.column("place").to_numpy()] = sums.column("sum").to_numpy() / _UNIT
        net = net.like(weights)
    return net


def _scores(net: Network, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts))
    owner = np.repeat(np.arange(len(counts)), counts)
    for begin in range(0, len(tokens), _SCORED):
        places = np.arange(begin, min(begin + _SCORED, len(tokens)))
        logs = log_chances(net, windows_of(tokens, counts, places), tokens[places])
        out += np.bincount(owner[places], logs, len(counts))
    return out


def _summed(rows: DataFrame, net: Network, keys: tuple[str, ...]) -> DataFrame:
    """The keys, ``n_tokens bigint, sum double``: logarithms of the tokens' chances added up."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W.one_thread()
        for batch in batches:
            sums, lists = [np.zeros(0)], batch.column(len(keys))
            for _, _, tokens, counts in _tokens(lists):
                sums.append(_scores(net, tokens, counts))
            n = lists.value_lengths().to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], pa.array(n), pa.array(np.concatenate(sums))],
                names=[*keys, "n_tokens", "sum"],
            )

    kinds = "".join(f"{key} {rows.schema[key].dataType.simpleString()}, " for key in keys)
    return rows.select(*keys, "tokens").mapInArrow(score, f"{kinds}n_tokens bigint, sum double")


def _finished(sums: DataFrame) -> DataFrame:
    rounded = sums.select("id", "n_tokens", F.round("sum", 3).alias("log_likelihood"))
    mean = F.when(F.col("n_tokens") > 0, F.round(F.col("log_likelihood") / F.col("n_tokens"), 6))
    return rounded.withColumn("per_token", mean)


def scored(rows: DataFrame, net: Network) -> DataFrame:
    """``id, n_tokens bigint, log_likelihood double, per_token double`` of token rows.

    This is the network's part: a word that is not known counts as its class.
    """
    return _finished(_summed(rows, net, ("id",)))


def pseudo_likelihood(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """For each row its id, ``n_tokens``, ``log_likelihood`` and ``per_token``.

    Words (see ``words.py``) are counted over all texts; the network learns from
    every place of all texts; then every word of every text is predicted from
    ``SIDE`` words on either side.  ``log_likelihood`` is the sum of the logarithms
    of the words' chances.  A word that is not one of the ``KNOWN`` has the
    predicted chance of its class times its own share of the class in all texts
    (see ``_inner``), so all words of the corpus have a chance of their own.
    Scores do not depend on files and tasks, but for the last digit: the network
    scores in 32-bit numbers, some thousand words at a time.

    A null, empty or blank text has no tokens, sum 0 and no mean.  Every row
    gives one row, repeated and null ids too; an empty table gives none.  Other
    columns are not read.
    """
    counts = stored(word_counts(documents, text_column), "words")
    words = _chosen(counts)
    tokens = token_rows(documents, words, id_column, text_column)
    rows = stored(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    inner = stored(_inner(rows, counts, words), "inner")
    sums = _summed(rows, fitted(rows, words), ("row", "id", "found"))
    whole = F.col("sum") + (F.col("found") + F.coalesce(F.col("inner"), F.lit(0))) / _UNIT
    result = _finished(sums.join(inner, "row", "left").withColumn("sum", whole))
    return result.withColumnRenamed("id", id_column)
