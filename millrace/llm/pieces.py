"""SentencePiece segmentations, sampled from the lattice of pieces, and back to text."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W

#: Characters taken apart at a time, and longest unit that is handled together with others.
_PIECE, _LONG = 1 << 19, 40
#: Fixed values of SentencePiece: the sign for a space.
_SPACE = 0x2581


class Pieces(NamedTuple):
    """The pieces of a model with their weights."""

    keys: np.ndarray  # hashes in order
    ids: np.ndarray  # piece of each hash
    weights: np.ndarray  # share of each piece, by id
    singles: np.ndarray  # characters that are pieces, in order
    bytes_of: np.ndarray  # piece of each byte
    longest: int
    texts: np.ndarray  # UTF-8 of all pieces, one after another
    ends: np.ndarray
    table: dict[str, int]


def _hash(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which the hash of any stretch of a row follows, and their factors."""
    up, down = W.power_tables(codes.shape[-1] + 1)
    sums = np.zeros((*codes.shape[:-1], codes.shape[-1] + 1), dtype=np.uint64)
    values = (codes.astype(np.uint64) + np.uint64(1)) * up[: codes.shape[-1]]
    np.cumsum(values, axis=-1, out=sums[..., 1:])
    return sums, down


def load(path: str, sharpness: float = 1.0) -> Pieces:
    """Pieces of a model file that has byte pieces.

    A piece weighs ``1 / rank ** sharpness`` as a share of all, by its rank in
    the order of the model's scores: the scores of a model trained by merges are
    ranks, not probabilities.  Every piece more costs a factor, so that short
    segmentations are likelier.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    byte_ids = [i for i in range(size) if model.is_byte(i)]
    plain = [i for i in range(size) if not special[i] and not model.is_byte(i)]
    ranked = sorted(plain, key=lambda i: (-model.get_score(i), i))
    share = 1.0 / np.arange(1, len(ranked) + 1) ** sharpness
    weights = np.zeros(size)
    weights[ranked] = share / share.sum()
    names = [model.id_to_piece(i) for i in range(size)]
    keys = np.empty(len(plain), dtype=np.uint64)
    for k, i in enumerate(plain):
        codes = np.frombuffer(names[i].encode("utf-32-le"), dtype=np.uint32)
        sums, _ = _hash(codes)
        keys[k] = W.mixed(sums[-1:], len(codes))[0]
    order = np.argsort(keys)
    if len(np.unique(keys)) < len(keys) or len(byte_ids) != 256:
        raise ValueError(f"{path} has no piece for each byte or pieces that hash alike")
    raw = [
        b"" if special[i] else names[i].replace(chr(_SPACE), " ").encode() for i in range(size)
    ]
    for value, i in enumerate(byte_ids):
        raw[i] = bytes([value])
    return Pieces(
        keys[order],
        np.array(plain, dtype=np.int32)[order],
        weights,
        np.array(sorted(ord(names[i]) for i in plain if len(names[i]) == 1), dtype=np.uint32),
        np.array(byte_ids, dtype=np.int32),
        max(len(names[i]) for i in plain),
        np.frombuffer(b"".join(raw), dtype=np.uint8),
        np.cumsum([len(x) for x in raw]),
        {names[i]: i for i in plain},
    )


_KNOWN: dict[int, np.ndarray] = {}


def _known(pieces: Pieces) -> np.ndarray:
    """Whether a character is a piece; the sign for a space is not, as a text's own character."""
    key = hash(pieces.singles.tobytes())
    if key not in _KNOWN:
        table = np.zeros(0x110000, dtype=bool)
        table[pieces.singles] = True
        table[_SPACE] = False
        table[0x20] = True
        _KNOWN[key] = table
    return _KNOWN[key]


#: Bytes of the table of steps that a worker builds for a model.
_STEP_BYTES = 32 << 20


class _Trie:
    """The beginnings of all pieces: numbers from 1, those that go on before those that end.

    ``steps`` leads from a beginning to the next one by the character's column, as many of the
    commonest characters as fit; ``rare`` lists the other steps in order.
    """

    def __init__(self, pieces: Pieces):
        starts = {piece[:k] for piece in pieces.table for k in range(1, len(piece) + 1)}
        inner = {start[:-1] for start in starts if len(start) > 1}
        numbers = {start: k + 1 for k, start in enumerate(sorted(starts, key=lambda s: s not in inner))}
        self.inner = len(inner)
        self.first = np.zeros(0x110000, dtype=np.int32)
        self.piece = np.full(len(numbers) + 1, -1, dtype=np.int32)
        for start, number in numbers.items():
            self.piece[number] = pieces.table.get(start, -1)
            if len(start) == 1:
                self.first[ord(start)] = number
        edges = [(numbers[s[:-1]], ord(s[-1]), k) for s, k in numbers.items() if len(s) > 1]
        before, codes, after = (np.array(c, dtype=np.int64) for c in zip(*edges or [(0, 0, 0)], strict=True))
        common = np.bincount(codes).argsort(kind="stable")[::-1]
        columns = max(2, min(256, _STEP_BYTES // (4 * (self.inner + 1))))
        self.column = np.zeros(0x110000, dtype=np.int16)
        self.column[common[: columns - 1]] = np.arange(1, min(columns - 1, len(common)) + 1)
        self.steps = np.zeros((self.inner + 1, columns), dtype=np.int32)
        in_table = self.column[codes] > 0
        self.steps[before[in_table], self.column[codes[in_table]]] = after[in_table]
        rare = before[~in_table] << 21 | codes[~in_table]
        order = np.argsort(rare)
        # The last entry is above every key, so that a search always ends at one.
        self.rare = np.append(rare[order], np.iinfo(np.int64).max)
        self.rare_after = np.append(after[~in_table][order], 0).astype(np.int32)

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The beginnings that are one character longer, 0 where there is none."""
        column = self.column[codes]
        after = self.steps[nodes, column]
        other = np.flatnonzero(column == 0)
        if len(other):
            keys = nodes[other].astype(np.int64) << 21 | codes[other]
            at = np.searchsorted(self.rare, keys)
            after[other] = np.where(self.rare[at] == keys, self.rare_after[at], 0)
        return after


_TRIES: dict[int, _Trie] = {}


def _trie(pieces: Pieces) -> _Trie:
    """Built once in a worker; another model takes its place."""
    key = hash((pieces.keys.tobytes(), pieces.ids.tobytes()))
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = _Trie(pieces)
    return _TRIES[key]


def _lattice(pieces: Pieces, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward filtering for units of one length, one in each row of ``codes``.

    Gives, for each unit, end and length of the last piece there: the chance
    that the last piece is so long or shorter, and its id.  From each place on, only units in which
    a piece may still go on are looked at.
    """
    n, size = codes.shape
    reach = min(size, pieces.longest)
    trie = _trie(pieces)
    columns = np.ascontiguousarray(codes.T).astype(np.int64)
    chance = np.zeros((n, size, reach), dtype=np.float64)
    found = np.zeros((n, size, reach), dtype=np.int32)
    every = np.arange(n)
    for begin in range(size):
        # All pieces that end here began before.
        forward = chance[:, begin - 1].sum(axis=1) if begin else np.ones(n)
        rows, nodes = every, trie.first[columns[begin]]
        for length in range(1, min(size - begin, reach) + 1):
            if length > 1:
                nodes = trie.step(nodes, columns[begin + length - 1, rows])
            met = nodes > 0
            if not met.all():
                rows, nodes = rows[met], nodes[met]
            ids = trie.piece[nodes]
            whole = ids >= 0
            at, ids = (rows, ids) if whole.all() else (rows[whole], ids[whole])
            end = begin + length - 1
            found[at, end, length - 1] = ids
            chance[at, end, length - 1] = forward[at] * pieces.weights[ids]
            more = nodes <= trie.inner
            if not more.all():
                rows, nodes = rows[more], nodes[more]
            if not len(rows):
                break
    np.cumsum(chance, axis=2, out=chance)
    chance /= chance[:, :, -1:]
    return chance, found


def _draws(seeds: np.ndarray, step: int) -> np.ndarray:
    return (W.mixed(seeds, step) >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def _sampled(
    chance: np.ndarray, found: np.ndarray, rows: np.ndarray, seeds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Backward sampling for occurrences of units: occurrence, step from the end, piece."""
    here = np.arange(len(rows))
    end = np.full(len(rows), chance.shape[1])
    out, step = [], 0
    while len(here):
        steps = chance[rows[here], end[here] - 1]
        length = (steps <= _draws(seeds[here], step)[:, None]).sum(axis=1)
        length = np.minimum(length, chance.shape[2] - 1)
        out.append((here, np.full(len(here), step), found[rows[here], end[here] - 1, length]))
        end[here] -= length + 1
        here = here[end[here] > 0]
        step += 1
    return tuple(np.concatenate(parts) for parts in zip(*out, strict=True))


def _long_unit(pieces: Pieces, text: str, seed: np.uint64) -> list[int]:
    """The same for one unit of any length; sums are scaled so that they never vanish."""
    forward = [1.0]
    ways: list[tuple[list[float], list[int], list[int]]] = []
    for end in range(1, len(text) + 1):
        total, sums, ids, lengths = 0.0, [], [], []
        for length in range(1, min(end, pieces.longest) + 1):
            piece = pieces.table.get(text[end - length : end])
            if piece is not None:
                total += forward[-length] * float(pieces.weights[piece])
                sums.append(total)
                ids.append(piece)
                lengths.append(length)
        ways.append((sums, ids, lengths))
        forward.append(total)
        forward = forward[-pieces.longest :]
        if total < 1e-200:
            forward = [x * 1e200 for x in forward]
    out, end, step = [], len(text), 0
    while end > 0:
        sums, ids, lengths = ways[end - 1]
        u = float(_draws(np.array([seed]), step)[0]) * sums[-1]
        k = next((k for k, s in enumerate(sums) if s > u), len(sums) - 1)
        out.append(ids[k])
        end -= lengths[k]
        step += 1
    return out[::-1]


def _encode(pieces: Pieces, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts one after another, and how many each has."""
    marked = [f" {text}" if text else "" for text in texts]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32).copy()
    ends = np.cumsum([len(text) for text in marked])
    if not len(codes):
        return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
    foreign = ~_known(pieces)[codes]
    space = codes == 0x20
    codes[space] = _SPACE
    # No piece goes on after a character that is in none, nor from a letter to a space.
    begin = foreign.copy()
    begin[1:] |= foreign[:-1] | (space[1:] & ~space[:-1])
    begin[ends[:-1][ends[:-1] < len(codes)]] = True
    begin[0] = True
    starts = np.flatnonzero(begin)
    sizes = np.diff(np.append(starts, len(codes)))
    owners = np.searchsorted(ends, starts, side="right")
    first = np.searchsorted(owners, np.arange(len(texts)))
    ordinal = (np.arange(len(starts)) - first[owners]).astype(np.uint64)
    own_seeds = W.mixed(seeds[owners] + ordinal * np.uint64(0x9E3779B97F4A7C15), 31)

    counts = np.zeros(len(starts), dtype=np.int64)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # unit, place from the end, piece
    alone = np.flatnonzero(foreign[starts])
    for unit in np.unique(codes[starts[alone]]):
        raw = pieces.bytes_of[np.frombuffer(chr(int(unit)).encode(), dtype=np.uint8)]
        at = alone[codes[starts[alone]] == unit]
        counts[at] = len(raw)
        for k, piece in enumerate(raw[::-1]):
            parts.append((at, np.full(len(at), k), np.full(len(at), piece)))
    usual = np.flatnonzero(~foreign[starts])
    by_size = usual[np.argsort(sizes[usual], kind="stable")]
    edges = np.searchsorted(sizes[by_size], np.arange(1, _LONG + 2))
    for size in range(1, _LONG + 1):
        at = by_size[edges[size - 1] : edges[size]]
        if not len(at):
            continue
        windows = codes[starts[at][:, None] + np.arange(size)]
        sums, _ = _hash(windows)
        _, one, back = np.unique(sums[:, -1], return_index=True, return_inverse=True)
        chance, found = _lattice(pieces, windows[one])
        here, place, ids = _sampled(chance, found, back, own_seeds[at])
        counts[at] = np.bincount(here, minlength=len(at))
        parts.append((at[here], place, ids))
    for unit in by_size[edges[_LONG] :]:
        text = codes[starts[unit] : starts[unit] + sizes[unit]].tobytes().decode("utf-32-le")
        ids = _long_unit(pieces, text, own_seeds[unit])
        counts[unit] = len(ids)
        parts.append((np.full(len(ids), unit), np.arange(len(ids))[::-1], np.array(ids)))
    total = np.cumsum(counts)
    out = np.empty(int(total[-1]), dtype=np.int32)
    for unit, place, ids in parts:
        out[total[unit] - 1 - place] = ids
    return out, np.bincount(owners, counts, len(texts)).astype(np.int64)


def _decode(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of the pieces; the space before each text is taken away again."""
    begins = np.concatenate(([0], pieces.ends[:-1]))
    sizes = (pieces.ends - begins)[ids]
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    raw = pieces.texts[np.repeat(begins[ids], sizes) + inner].tobytes()
    edges = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own = raw[a:b]
        out.append((own[1:] if own[:1] == b" " else own).decode("utf-8", "replace"))
    return out


def _seeds(keys: list, seed: int) -> np.ndarray:
    """A number for each row's key, the same wherever and with whatever rows it is read."""
    data, offsets = W.text_bytes(pa.array([f"{seed}|{key}" for key in keys], pa.string()))
    sums, down = _hash(data)
    starts, stops = offsets[:-1], offsets[1:]
    return W.mixed((sums[stops] - sums[starts]) * down[starts], 17)


def _runs(lengths: list[int]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, length in enumerate(lengths):
        size += length
        if size >= _PIECE:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(lengths):
        yield begin, len(lengths)


def _lists(values: np.ndarray, counts: np.ndarray, missing: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    mask = pa.array(missing) if missing.any() else None
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()), mask=mask)


def _encoded(pieces: Pieces, keys: pa.Array, texts: pa.Array, seed: int) -> pa.Array:
    rows = texts.to_pylist()
    numbers = _seeds(keys.to_pylist(), seed)
    values, counts = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
    for begin, end in _runs([len(row or "") for row in rows]):
        ids, sizes = _encode(pieces, [row or "" for row in rows[begin:end]], numbers[begin:end])
        values.append(ids)
        counts.append(sizes)
    W.give_back()
    missing = np.array([row is None for row in rows], dtype=bool)
    return _lists(np.concatenate(values), np.concatenate(counts), missing)


def _decoded(pieces: Pieces, lists: pa.Array) -> pa.Array:
    out: list[str] = []
    for begin in range(0, len(lists), 256):
        part = lists.slice(begin, 256)
        counts = part.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        values = part.flatten().fill_null(0).to_numpy(zero_copy_only=False)
        out += _decode(pieces, values, counts)
    return pa.array(out, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))


def encoded(key: Column, text: Column, pieces: Pieces, seed: int = 1) -> Column:
    """The text's pieces as ``array<int>``, one segmentation drawn from all there are.

    The lattice has an edge for each piece found in the text, with its weight;
    forward sums are filtered over it and a path is sampled backward, so each
    segmentation comes with its share of the weights.  The draw depends on
    ``seed``, the row's key and the place in the text alone.

    A space is written before the text and as the model's sign; a character
    that is no piece, and that sign itself, is written as its bytes.  So
    ``decoded`` gives the text back as it was.  A null text gives null, an empty
    one no pieces.  Whole texts are read, of any length; a null key is a key.
    """

    @F.arrow_udf("array<int>")
    def encode(keys: pa.Array, texts: pa.Array) -> pa.Array:
        return _encoded(pieces, keys, texts, seed)

    # Not deterministic to Spark only: else a column made from the pieces would
    # draw them again.
    return encode.asNondeterministic()(key, text)


def checked(key: Column, text: Column, pieces: Pieces, seed: int = 1) -> Column:
    """``struct<pieces array<int>, lossless boolean>``: ``encoded``, and whether
    ``decoded`` gives the text back.  One pass, so that pieces stay in the task."""

    @F.arrow_udf("struct<pieces array<int>, lossless boolean>")
    def check(keys: pa.Array, texts: pa.Array) -> pa.Array:
        lists = _encoded(pieces, keys, texts, seed)
        same = pa.compute.equal(_decoded(pieces, lists), texts)
        both = pa.compute.and_(lists.is_null(), texts.is_null())
        lossless = pa.compute.coalesce(same, both)
        return pa.StructArray.from_arrays([lists, lossless], names=["pieces", "lossless"])

    return check.asNondeterministic()(key, text)


def decoded(ids: Column, pieces: Pieces) -> Column:
    """The text of a row's pieces; null for null.

    Control pieces and null elements have no text, bytes that are no UTF-8 become U+FFFD.
    """

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        return _decoded(pieces, lists)

    return decode(ids)


def segmented(
    documents: DataFrame,
    path: str,
    seed: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    output_column: str = "pieces",
) -> DataFrame:
    """All rows and columns, with the pieces of the text (see ``encoded``).

    Every row gives one row; rows that repeat key and text get the same pieces.
    A column that has the output's name is replaced.  The model file is read on
    the driver and its pieces travel with the job.
    """
    pieces = encoded(F.col(id_column), F.col(text_column), load(path), seed)
    return W.small_batches(documents).withColumn(output_column, pieces)


def segmented_and_checked(
    documents: DataFrame,
    path: str,
    seed: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All rows and columns, with ``pieces``, ``n_pieces bigint`` and ``lossless boolean``.

    See ``checked``.  Columns of these names are replaced.
    """
    both = checked(F.col(id_column), F.col(text_column), load(path), seed)
    rest = [n for n in documents.columns if n not in ("pieces", "n_pieces", "lossless")]
    rows = W.small_batches(documents).select(*rest, both.alias("_checked"))
    return rows.select(
        *rest,
        "_checked.pieces",
        F.size("_checked.pieces").cast("long").alias("n_pieces"),
        "_checked.lossless",
    )


def joined(
    documents: DataFrame, path: str, ids_column: str = "pieces", output_column: str = "text"
) -> DataFrame:
    """All rows and columns, with the text of the pieces (see ``decoded``)."""
    return W.small_batches(documents).withColumn(output_column, decoded(F.col(ids_column), load(path)))


def default_model(spark: SparkSession) -> str:
    """The model file the queries use, as the setting ``millrace.pieces`` names it."""
    return spark.conf.get("millrace.pieces", "/opt/tokenizers/piece_bpe_32k.model")
