"""Secrets in texts: three fixed patterns, and strings that look drawn at random."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in their order, pattern, and what a match must fulfil.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

#: Characters of a string that may be random; any other character ends it.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_STRING = "[A-Za-z0-9+/_=-]"
#: Shortest string judged, log-likelihood ratio for each pair of characters that
#: calls it random, and documents that the two models are trained on at most
#: (about: each is taken by a hash of its id).
SHORTEST, RATIO, SAMPLE = 20, 1.0, 2000
#: Weight of a character's own share beside its counts after another one.
PRIOR = 4.0
#: Items of an array whose results are gathered together.
CHUNK = 128

_SPAN = "struct<start:int,kind:int,end:int,found:string>"

_MARK, _OTHER = "\x01", "\x02"


def _unmarked(text: Column) -> Column:
    """Text of the same length without the mark, which no pattern contains."""
    return F.translate(F.coalesce(text, F.lit("")), _MARK, _OTHER)


def _parts(text: Column, pattern: str) -> Column:
    """The text cut around its matches, which are every second part; null without a match."""
    cut = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK)
    return F.when(F.regexp_like(text, F.lit(pattern)), cut)


def _folded(
    items: Column,
    start: Column,
    advance: Callable[[Column, Column], Column],
    found: Callable[[Column, Column, Column], Column],
) -> Column:
    """The spans that ``found(state, item, place)`` has for the items, one after another.

    ``advance(state, item)`` is the state, a number, for the next item.  An
    aggregate copies all it has gathered for every item; so states are gathered
    by ``CHUNK`` items first, then spans within each chunk.  A null array has none.
    """
    none = F.lit([]).cast(f"array<{_SPAN}>")

    def whole(every: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / CHUNK).cast("int"))

        def places(number: Column) -> Column:
            first = number * CHUNK
            return F.sequence(first, F.least(first + CHUNK, F.size(every)) - 1)

        def state_after(states: Column, number: Column) -> Column:
            step = lambda state, at: advance(state, F.get(every, at))
            return F.concat(
                states, F.array(F.aggregate(places(number), F.element_at(states, -1), step))
            )

        def spans(states: Column) -> Column:
            def step(state: Column, at: Column) -> Column:
                item = F.get(every, at)
                return F.struct(
                    advance(state["own"], item).alias("own"),
                    F.concat(state["found"], found(state["own"], item, at)).alias("found"),
                )

            def chunk(number: Column) -> Column:
                begin = F.struct(F.get(states, number).alias("own"), none.alias("found"))
                return F.aggregate(places(number), begin, step, lambda state: state["found"])

            return F.flatten(F.transform(chunks, chunk))

        states = F.aggregate(chunks, F.array(start), state_after)
        return F.when(F.size(every) > 0, _once(states, spans)).otherwise(none)

    return F.coalesce(_once(items, whole), none)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, not for each item of what uses it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _if(condition: Column, span: Column) -> Column:
    return F.when(condition, F.array(span)).otherwise(F.lit([]).cast(f"array<{_SPAN}>"))


def _spans(parts: Column, kind: int) -> Column:
    """``start, kind, end, found`` of each match, in code points."""

    def found(start: Column, part: Column, place: Column) -> Column:
        span = F.struct(
            start.alias("start"),
            F.lit(kind).alias("kind"),
            (start + F.length(part)).alias("end"),
            part.alias("found"),
        )
        return _if(place % 2 == 1, span)

    return _folded(parts, F.lit(0), lambda start, part: start + F.length(part), found)


def _apart(spans: Column) -> Column:
    """The spans of the last kind that overlap none of the others, in their order.

    One pass compares each with the ends of those before it, one with the
    starts of those after it.
    """
    base = lambda s: s["kind"] < len(KINDS) - 1
    left = _folded(
        F.sort_array(spans),
        F.lit(0),
        lambda end, s: F.when(base(s), F.greatest(end, s["end"])).otherwise(end),
        lambda end, s, _: _if(base(s) | (end <= s["start"]), s),
    )
    right = _folded(
        F.reverse(left),
        F.lit((1 << 31) - 1),
        lambda start, s: F.when(base(s), s["start"]).otherwise(start),
        lambda start, s, _: _if(~base(s) & (start >= s["end"]), s),
    )
    return F.reverse(right)


def _place(character: Column) -> Column:
    """Number of a character in the alphabet, from 0."""
    places = [ALPHABET.find(chr(code)) for code in range(128)]
    return F.get(F.lit(places), F.ascii(character))


def _pair_counts(strings: DataFrame) -> np.ndarray:
    """How often each pair of characters follows in the column ``found``."""
    size = len(ALPHABET)
    chars = strings.filter(F.length("found") > 1).select(F.split("found", "").alias("chars"))
    rest = F.size("chars") - 1
    pairs = chars.select(
        F.explode(
            F.zip_with(
                F.slice("chars", 1, rest),
                F.slice("chars", 2, rest),
                lambda a, b: _place(a) * size + _place(b),
            )
        ).alias("pair")
    )
    counts = np.zeros(size * size)
    for row in pairs.groupBy("pair").count().collect():  # size * size rows at most
        counts[row["pair"]] = row["count"]
    return counts.reshape(size, size)


def base_spans(text: Column) -> list[Column]:
    """Three columns of spans, by the fixed patterns."""
    assign = _spans(_parts(text, ASSIGN), 0)
    value = lambda span: F.regexp_extract(span["found"], ASSIGN, 2)
    long_enough = F.filter(assign, lambda span: F.length(value(span)) >= 8)
    return [long_enough, _spans(_parts(text, ACCESS), 1), _spans(_parts(text, HEX), 2)]


def pair_ratios(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> list[float]:
    """Log-likelihood ratio of each pair of characters: random string against ordinary one.

    Two first-order Markov models, trained on ``SAMPLE`` documents or so.
    Labelled random are the keys and hexadecimal strings that the fixed patterns
    find there and one digest for each sampled document, written in the whole
    alphabet; labelled ordinary are the other strings of these documents that
    are too short to be judged, so that what is judged is not learned from.
    """
    step = max(1, documents.count() // SAMPLE)
    chosen = F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(step)) == 0
    sample = documents.filter(chosen).select(
        F.col(id_column).cast("string").alias("id"), _unmarked(F.col(text_column)).alias("text")
    )
    digest = F.base64(F.unhex(F.sha2(F.concat(F.lit("digest "), F.coalesce("id", F.lit(""))), 256)))
    random = F.concat(
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
        F.array(F.translate(digest, "=", "")),
    )
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    short = rf"(?<!{_STRING}){_STRING}{{2,{SHORTEST - 1}}}(?!{_STRING})"
    plain = F.regexp_extract_all(rest, F.lit(short), F.lit(0))
    random_counts, plain_counts = (
        _pair_counts(sample.select(F.explode(strings).alias("found"))) for strings in (random, plain)
    )
    return (_log_chances(random_counts) - _log_chances(plain_counts)).reshape(-1).tolist()


def _log_chances(counts: np.ndarray) -> np.ndarray:
    """Chance of each character after each other one; a rare one's is near that of the character."""
    alone = counts.sum(axis=0) + 0.5
    alone /= alone.sum()
    chances = (counts + PRIOR * alone) / (counts.sum(axis=1, keepdims=True) + PRIOR)
    return np.log(chances)


def _random(parts: Column, ratios: Sequence[float]) -> Column:
    """Spans whose pairs of characters are likelier in random strings."""
    table = F.lit(np.asarray(ratios))

    def add(state: Column, character: Column) -> Column:
        at = _place(character)
        ratio = F.get(table, state["last"] * len(ALPHABET) + at)
        return F.struct(
            at.alias("last"), (state["sum"] + F.coalesce(ratio, F.lit(0.0))).alias("sum")
        )

    def score(text: Column) -> Column:
        none = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0.0).alias("sum"))
        return F.aggregate(F.split(text, ""), none, add, lambda state: state["sum"])

    enough = lambda s: score(s["found"]) >= RATIO * (F.length(s["found"]) - 1)
    return F.filter(_spans(parts, 3), enough)


def _digest(spans: Column) -> Column:
    """``kind:start:end`` of spans by start and kind, joined by commas."""
    kinds = F.lit(list(KINDS))
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]),
        ),
        ",",
    )


def secrets(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """For each row its id and ``assign, access, hex, markov``: spans of each kind.

    A span has ``start, kind, end, found``: code points from 0, end exclusive,
    and the text there.  The first three kinds are the leftmost non-overlapping
    matches of fixed patterns that are long enough.  The last are whole strings
    over ``ALPHABET`` of ``SHORTEST`` characters or more that two Markov models
    call random and that overlap no other span.

    Whole texts are searched where they are read; nothing is shuffled.  A null
    text is empty.  Every row gives one row, repeated rows and null ids too; an
    empty table gives none.  Other columns are not read.  The work on one text
    grows with its length and with the spans in it.
    """
    ratios = pair_ratios(documents, id_column, text_column)
    long_string = rf"(?<!{_STRING}){_STRING}{{{SHORTEST},}}"
    text = F.col("text")
    found = documents.select(F.col(id_column), _unmarked(F.col(text_column)).alias("text"))
    found = found.withColumns(
        dict(zip(KINDS, [*base_spans(text), _random(_parts(text, long_string), ratios)], strict=True))
    )
    apart = _apart(F.concat("assign", "access", "hex", "markov"))
    kept = F.when(F.size("markov") > 0, apart).otherwise(F.col("markov"))
    return found.withColumn("markov", kept).drop("text")


def span_digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts of each fixed kind, the digest of their spans, and all spans in words."""
    base = F.concat("assign", "access", "hex")
    return found.select(
        id_column,
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(_digest(base), 256).alias("base_sha256"),
        _digest(F.concat(base, "markov")).alias("spans"),
    )
