"""Near copies by one-permutation MinHash, banded buckets and star-shaped candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import stored
from . import words as W
from .bits import WORDS, bit_table, marked
from .components import components, joined

#: Rows of a band and number of bands.  Two sets of similarity 0.8 miss every
#: bucket with a chance of 3 in a million, of 0.9 with one of 1e-13.
ROWS, BANDS = 5, 32
#: Shingles in a block of sets (about), and columns of its table compared at a time.
VALUES, COLUMNS = 1 << 18, 2048

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _probes(bins: int, tries: int) -> np.ndarray:
    """For each try, the bin that an empty bin looks at."""
    cells = np.arange(tries * bins, dtype=np.uint64)
    return (W.mixed(cells, 77) % np.uint64(bins)).astype(np.int64).reshape(tries, bins)


def signatures(sets: np.ndarray, sizes: np.ndarray, bins: int) -> np.ndarray:
    """The smallest hash in each of ``bins`` ranges of the hash space, for each set.

    An empty bin takes the value of the first filled bin on its own seeded
    sequence of bins (optimal densification).  Sets must be sorted; an empty
    set's row stays empty.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    span = (sets >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
    cell = owner * bins + span.astype(np.int64)
    first = np.ones(len(cell), dtype=bool)
    first[1:] = cell[1:] != cell[:-1]
    table = np.full(len(sizes) * bins, _EMPTY)
    table[cell[first]] = sets[first]
    filled = np.zeros(len(table), dtype=bool)
    filled[cell[first]] = True
    left = np.flatnonzero(~filled & np.repeat(sizes > 0, bins))
    tries = 64
    probes = _probes(bins, tries)
    step = 0
    while len(left):
        if step == len(probes):
            probes = _probes(bins, 2 * len(probes))
        look = left - left % bins + probes[step, left % bins]
        hit = filled[look]
        table[left[hit]] = table[look[hit]]
        left = left[~hit]
        step += 1
    return table.reshape(len(sizes), bins)


def band_keys(table: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = table.reshape(len(table), bands, rows)
    keys = np.broadcast_to(W.mixed(np.arange(bands, dtype=np.uint64), 5), parts.shape[:2])
    for r in range(rows):
        keys = W.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r], r)
    return keys


def _sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = W.word_hashes(*W.text_bytes(texts))
    return W.distinct_sets(*W.shingle_hashes(hashes, counts, words))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)))
    ends = np.cumsum(sizes)
    return (total[ends] - total[ends - sizes]).view(np.int64)


def sketches(documents: DataFrame, words: int, smallest: int) -> DataFrame:
    """``id, n, f1, f2, bands``: set size, a 128-bit print of the set, bucket keys.

    A set of fewer than ``smallest`` shingles can be like no other set and gets no keys.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, end in W.ranges(whole.column(1)):
                batch = whole.slice(begin, end - begin)
                sets, sizes = _sets(batch.column(1), words)
                large = sizes >= smallest
                table = signatures(
                    sets[np.repeat(large, sizes)], sizes[large], ROWS * BANDS
                )
                keys = band_keys(table, ROWS, BANDS).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes),
                        pa.array(_sums(W.mixed(sets, 1), sizes)),
                        pa.array(_sums(W.mixed(sets, 2), sizes)),
                        _lists(keys, np.where(large, BANDS, 0)),
                    ],
                    names=["id", "n", "f1", "f2", "bands"],
                )

    kind = documents.schema[0].dataType.simpleString()
    return W.small_batches(documents).mapInArrow(
        sketch, f"id {kind}, n bigint, f1 bigint, f2 bigint, bands array<bigint>"
    )


def shingle_sets(documents: DataFrame, words: int) -> DataFrame:
    """``id, shingles array<bigint>``, each shingle's hash once."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, end in W.ranges(whole.column(1)):
                batch = whole.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), _lists(*_sets(batch.column(1), words))],
                    names=["id", "shingles"],
                )

    kind = documents.schema[0].dataType.simpleString()
    return W.small_batches(documents).mapInArrow(collect, f"id {kind}, shingles array<bigint>")


def _buckets(classes: DataFrame, count: int) -> DataFrame:
    """``key, rep, n, degree``: members of buckets that two classes or more share.

    There are ``count`` classes at most.

    ``degree`` is the size of all the buckets of a class.  In a family of near
    copies the text that the others were made from shares most buckets.
    """
    members = classes.select("rep", "n", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    inside = stored(
        members.join(stored(shared, "b", BANDS * count), "key"), "members", BANDS * count
    )
    degrees = inside.groupBy("rep").agg(F.sum("size").alias("degree"))
    rows = inside.join(stored(degrees, "degrees", count), "rep")
    return stored(rows.select("key", "rep", "n", "degree"), "buckets", BANDS * count)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are alike enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def _stars(members: DataFrame, most: int) -> DataFrame:
    """Each bucket's members beside its centre ``a``, the member of the highest degree."""
    centre = F.max_by(F.struct("rep", "n", "degree", "component"), F.struct("degree", "rep"))
    centres = members.groupBy("key").agg(centre.alias("c"))
    named = centres.select(
        "key",
        F.col("c.rep").alias("a"),
        F.col("c.n").alias("a_n"),
        F.col("c.degree").alias("a_degree"),
        F.col("c.component").alias("a_component"),
    )
    return members.join(stored(named, "centres", most), "key")


def _star_pairs(stars: DataFrame, percent: int) -> DataFrame:
    """Pairs of a centre and another member that can be alike and are not yet connected."""
    return (
        stars.filter("rep <> a AND component <> a_component")
        .filter(100 * F.least("n", "a_n") >= percent * F.greatest("n", "a_n"))
        .select("a", F.col("rep").alias("b"))
        .distinct()
    )


def _forest(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect what all the given links connect, as few as can be."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        if (x := top(a)) != (y := top(b)):
            above[max(x, y)] = min(x, y)
            yield a, b


def _overlaps(
    left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray, right_sizes: np.ndarray
) -> np.ndarray:
    """Sizes of the intersections of every left set with every right one."""
    shared = np.intersect1d(left, right)
    common = np.zeros((len(left_sizes), len(right_sizes)), dtype=np.float32)
    places = []
    for values, sizes in ((left, left_sizes), (right, right_sizes)):
        at = np.searchsorted(shared, values)
        at[at == len(shared)] = 0
        hit = (shared[at] == values) if len(shared) else np.zeros(len(values), dtype=bool)
        places.append((np.repeat(np.arange(len(sizes)), sizes)[hit], at[hit]))
    for begin in range(0, len(shared), COLUMNS):
        blocks = []
        for (rows, at), sizes in zip(places, (left_sizes, right_sizes), strict=True):
            own = (at >= begin) & (at < begin + COLUMNS)
            block = np.zeros((len(sizes), COLUMNS), dtype=np.float32)
            block[rows[own], at[own] - begin] = 1
            blocks.append(block)
        common += blocks[0] @ blocks[1].T
    return common


def _compared(pairs: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between the components of two blocks of sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name, i=i: batch.column(name)[i].values.to_numpy()
                sizes = [get("l_sizes"), get("r_sizes")]
                common = _overlaps(get("l_sets"), sizes[0], get("r_sets"), sizes[1])
                union = sizes[0][:, None] + sizes[1][None, :] - common
                found = 100 * common >= percent * union
                names = [get("l_components"), get("r_components")]
                found &= names[0][:, None] != names[1][None, :]
                x, y = np.nonzero(found)
                links = list(_forest(names[0][x], names[1][y]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a for a, _ in links], pa.int64()),
                        pa.array([b for _, b in links], pa.int64()),
                    ],
                    names=["a", "b"],
                )

    return pairs.mapInArrow(compare, "a bigint, b bigint")


def _blocks(members: DataFrame, sizes: DataFrame, sets: DataFrame, side: str) -> DataFrame:
    """The sets of each ``team`` packed into blocks of about ``VALUES`` shingles.

    ``sizes`` has the teams to be taken and the shingles of their members, ``{side}_n``.
    """
    most = sizes.agg(F.sum(f"{side}_n")).first()[0]
    parts = sizes.select("team", F.ceil(F.col(f"{side}_n") / VALUES).alias("parts"))
    part = F.pmod(F.xxhash64("rep"), F.col("parts"))
    rows = members.join(parts, "team").withColumn("part", part)
    one = F.struct("component", "shingles")
    packed = (
        rows.join(sets.withColumnRenamed("id", "rep"), "rep")
        .groupBy("team", "part")
        .agg(F.collect_list(one).alias("rows"))
    )
    return stored(
        packed.select(
            "team",
            F.col("rows.component").alias(f"{side}_components"),
            F.transform("rows", lambda row: F.size(row["shingles"]).cast("bigint")).alias(
                f"{side}_sizes"
            ),
            F.flatten("rows.shingles").alias(f"{side}_sets"),
        ),
        "blocks",
        most,
    )


def _team_joined(
    labels: DataFrame, teams: DataFrame, sets: DataFrame, percent: int, most: int
) -> DataFrame:
    """The labels with the links in each team, for ``team, rep, n, component, reference``.

    Classes outside of the team's ``reference`` component are compared with all
    the team, a block of sets against a block.  No task holds more than two
    blocks, and a pair of blocks gives less than one link for each class.
    There are ``most`` teams at most.
    """
    loose = F.expr("component <> reference")
    sizes = teams.groupBy("team").agg(
        F.sum(F.when(loose, F.col("n"))).alias("l_n"), F.sum("n").alias("r_n")
    )
    sizes = stored(sizes.filter("l_n IS NOT NULL"), "teams", most)
    if sizes.isEmpty():
        return labels
    left = _blocks(teams.filter(loose), sizes, sets, "l")
    right = _blocks(teams, sizes, sets, "r")
    links = _compared(left.join(right, "team").drop("team"), percent)
    return joined(labels, stored(links, "links"))


def _linked(
    documents: DataFrame, buckets: DataFrame, words: int, percent: int, count: int, shingles: int
) -> DataFrame:
    """``id, component`` of the classes that have a link.

    There are ``count`` classes at most, with ``shingles`` in all.

    1. Every bucket compares its centre with its other members, a star.
    2. Each class joins the team of the centre with which it shares most buckets;
       what is not yet connected with the centre is compared within the team.
    3. A bucket that still has members of two teams and two components compares
       them like a team.

    So every pair that shares a bucket is compared or known to be connected.
    """
    bits = stored(bit_table(buckets.select("rep")), "bits", WORDS)
    near = marked(documents, bits, [documents.columns[0]], "open").filter("open").drop("open")
    sets = stored(shingle_sets(near, words), "sets")

    most = BANDS * count
    stars = stored(_stars(buckets.withColumn("component", F.col("rep")), most), "stars", most)
    links = _confirmed(_star_pairs(stars, percent), sets, percent)
    links = stored(links, "links", max(most, shingles))
    labels = components(links)

    shares = stars.groupBy("rep", "a").agg(
        F.count("*").alias("shared"), F.first("a_degree").alias("degree"), F.first("n").alias("n")
    )
    main = shares.groupBy("rep").agg(
        F.max_by("a", F.struct("shared", "degree", "a")).alias("team"), F.first("n").alias("n")
    )
    lead = labels.select(F.col("id").alias("team"), F.col("component").alias("reference"))
    teams = stored(
        _labelled(main, labels)
        .join(lead, "team", "left")
        .withColumn("reference", F.coalesce("reference", "team")),
        "teams",
        count,
    )
    labels = _team_joined(labels, teams, sets, percent, count)

    own = teams.select("rep", F.col("team").alias("own"))
    rows = stored(_labelled(buckets.join(own, "rep"), labels), "members", most)
    unequal = (
        rows.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.min("own").alias("first"),
            F.max("own").alias("last"),
            F.max_by("component", F.struct("degree", "rep")).alias("reference"),
        )
        .filter("low <> high AND first <> last")
    )
    keys = stored(unequal.select("key", "reference"), "keys", most)
    left = rows.join(keys, "key").select(
        F.col("key").alias("team"), "rep", "n", "component", "reference"
    )
    return _team_joined(labels, stored(left, "open", most), sets, percent, most)


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their present ``component``."""
    named = members.drop("component").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    return named.withColumn("component", F.coalesce("component", "rep"))


def near_copies(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """For each row its id, ``n_shingles bigint``, ``component_id`` and ``kept boolean``.

    A text's set has its distinct runs of ``words`` words (see ``words.py``; a
    shorter text is one run), with 64-bit hashes in place of the runs.  Two
    texts are linked when the intersection of their sets has at least
    ``percent`` hundredths of the union; a component is named by its smallest
    id, and that document is kept.

    Equal sets are one class, so any number of copies costs one signature
    comparison.  Classes meet in buckets of equal bands; buckets are compared
    as stars, and every link is confirmed on the full sets (see ``_linked``).

    Ids are whole numbers.  Null, empty and blank texts have no shingles and are
    linked with nothing.
    A row without an id is linked with nothing, has no component and is kept.
    Repeated rows of one id count as copies.  An empty table gives no rows.
    Other columns are not read.
    """
    found = _verdicts(documents, id_column, text_column, words, percent)
    return found.drop("f1", "f2")


def _verdicts(
    documents: DataFrame, id_column: str, text_column: str, words: int, percent: int
) -> DataFrame:
    """The same with the print ``f1, f2`` of each row's set."""
    smallest = -(-percent // max(1, 100 - percent))
    texts = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    marks = stored(sketches(texts, words, smallest), "sketches")
    count, shingles = marks.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    alone = "n = 0 OR id IS NULL"
    classes = stored(
        marks.filter(f"NOT ({alone})")
        .groupBy("n", "f1", "f2")
        .agg(F.min("id").alias("rep"), F.first("bands").alias("bands")),
        "classes",
        BANDS * count,
    )
    buckets = _buckets(classes, count)
    named = texts.filter("id IS NOT NULL")
    labels = _linked(named, buckets, words, percent, count, shingles)
    named = stored(
        classes.select("n", "f1", "f2", "rep")
        .join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        .select("n", "f1", "f2", F.coalesce("component", "rep").alias("component_id")),
        "named",
        count,
    )
    copies = marks.filter(f"NOT ({alone})").select("id", "n", "f1", "f2")
    joined = copies.join(named, ["n", "f1", "f2"]).select("id", "n", "f1", "f2", "component_id")
    single = marks.filter(alone).select("id", "n", "f1", "f2", F.col("id").alias("component_id"))
    return joined.unionByName(single).select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        "f1",
        "f2",
    )


def _printed(rows: DataFrame, words: int) -> DataFrame:
    """The rows with ``_n, _f1, _f2`` of the set of their last column, a text, in its place."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, end in W.ranges(whole.column(whole.num_columns - 1)):
                batch = whole.slice(begin, end - begin)
                sets, sizes = _sets(batch.columns[-1], words)
                prints = [pa.array(_sums(W.mixed(sets, salt), sizes)) for salt in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(sizes), *prints], names=names
                )

    schema = T.StructType(rows.schema.fields[:-1])
    for name in ("_n", "_f1", "_f2"):
        schema = schema.add(name, T.LongType())
    names = schema.names
    return W.small_batches(rows).mapInArrow(add, schema)


def near_dedup(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The rows that stay, one document of each component, with all their columns.

    See ``near_copies``; only rows with an id that goes are shuffled.  Where an
    id has several texts of which some go, a row goes by the print of its set.
    """
    found = _verdicts(documents, id_column, text_column, words, percent)
    named = found.withColumnsRenamed({"n_shingles": "_n", "f1": "_f1", "f2": "_f2"})
    keys = [id_column, "_n", "_f1", "_f2"]
    named = stored(named.filter(F.col(id_column).isNotNull()).select(*keys, "kept"), "verdicts")
    gone = named.filter("NOT kept").select(keys)
    both = (
        named.groupBy(id_column)
        .agg(F.bool_and("kept").alias("all"), F.bool_or("kept").alias("some"))
        .filter("NOT all")
    )
    both = stored(both, "gone")
    some = both.filter("some").select(id_column)
    split = marked(documents, stored(bit_table(both.select(id_column)), "bits"), [id_column], "_hit")
    split = marked(split, stored(bit_table(some), "bits"), [id_column], "_some")
    left = split.filter("_hit").join(both.filter("NOT some"), id_column, "left_anti")
    text = F.when(F.col("_some"), F.col(text_column)).alias("_text")
    unsure = _printed(left.select(*documents.columns, text), words)
    part = gone.join(some, id_column, "left_semi").distinct()
    kept = unsure.join(stored(part, "part"), keys, "left_anti").select(documents.columns)
    return split.filter("NOT _hit").select(documents.columns).unionByName(kept)
