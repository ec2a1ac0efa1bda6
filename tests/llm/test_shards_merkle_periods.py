"""Shards, manifests and periodic runs against plain Python versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle, periods, queries, shards
from millrace.llm.numbering import numbered

NAMES = (
    "id n i tree top path digest row number group key0 tree_of size shard slot runs start best "
    "collapsed n_words text_crc32 row_number left right _text"
).split()


def clashing(table):
    return table.withColumns({name: F.lit(f"{name}!") for name in NAMES})


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


# --- numbers and shards


@pytest.mark.parametrize("n", [1, 2, 3, 7, 24, 25, 99, 100, 101, 257])
def test_places_are_a_permutation(spark, n):
    at = spark.range(n).select(
        "id",
        shards.place(F.col("id"), n, 5).alias("place"),
        shards.shard_and_slot(F.col("id"), n, 4, 5).alias("s"),
    )
    back = at.withColumn("number", shards.number_at(F.col("place"), n, 5)).withColumn(
        "also", shards.number_of(F.col("s.shard"), F.col("s.slot"), n, 4, 5)
    )
    rows = back.collect()
    assert sorted(row.place for row in rows) == list(range(n))
    assert all(row.number == row.id == row.also for row in rows)


def test_places_look_random(spark):
    n, parts = 40_000, 20
    cells = (
        spark.range(n)
        .select(F.col("id"), shards.place(F.col("id"), n).alias("p"))
        .groupBy((F.col("id") * parts / n).cast("int"), (F.col("p") * parts / n).cast("int"))
        .count()
        .collect()
    )
    assert len(cells) == parts * parts
    expected = n / parts**2
    chi = sum((row["count"] - expected) ** 2 / expected for row in cells)
    assert 250 < chi < 500  # 361 degrees of freedom
    other = spark.range(n).filter(
        shards.place(F.col("id"), n, 1) == shards.place(F.col("id"), n, 2)
    )
    assert other.count() < 20


def test_numbers_with_a_hot_key(spark):
    rows = spark.range(0, 3000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("key")
    )
    got = numbered(rows, [F.col("key")], "at").collect()
    assert sorted(row.at for row in got) == list(range(3000))
    assert [row.key for row in sorted(got, key=lambda row: row.at)] == sorted(r.key for r in got)
    assert numbered(rows.limit(0), [F.col("key")], "at").collect() == []


TEXTS = [None, "", " \t ", "one", "one", "x" * 200_000, "äöü 😀", "a b " * 40_000]


@pytest.fixture(scope="module")
def hard(spark):
    data = [(i + 1, text, "en" if i % 2 else None, "s", i) for i, text in enumerate(TEXTS)]
    data += [(None, "no id", "de", None, None), (None, "no id", "de", None, None), data[3]]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return clashing(spark.createDataFrame(data, schema)).cache()


def test_shards_of_hard_rows(spark, hard, folder):
    got = shards.sharded(hard, shards=4)
    assert set(got.columns) == set(hard.columns)
    rows = got.collect()
    n = len(TEXTS) + 3
    assert sorted(row.row_number for row in rows) == list(range(n))
    assert sorted((row.shard, row.slot) for row in rows) == sorted((k % 4, k // 4) for k in range(n))
    for row in rows:
        data = (row.text or "").encode()
        assert (row.size, row.text_crc32) == (len(data) + 8, zlib.crc32(data))
        assert row.n == "n!"
    assert shards.sharded(hard.limit(0)).collect() == []

    shards.write_shards(got, f"{folder}/shards", rows_in_file=2)
    back = spark.read.parquet(f"{folder}/shards")
    assert sorted((r.shard, r.slot, r.size) for r in back.select("shard", "slot", "size").collect()) == sorted(
        (r.shard, r.slot, r.size) for r in rows
    )


def test_shards_do_not_depend_on_files(spark, tables):
    documents = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    layouts = [documents.coalesce(1), documents.repartition(13, "text")]
    first, second = (
        {r.doc_id: (r.shard, r.slot) for r in shards.sharded(d).collect()} for d in layouts
    )
    assert first == second


# --- manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    framed = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return sha("".join(framed))


def climb(nodes):
    """The root, and for each leaf the siblings (left, right) of each level."""
    sides = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, lists = [], []
        for start in range(0, len(nodes), 8):
            run = nodes[start : start + 8]
            for k in range(len(run)):
                for i in members[start + k]:
                    sides[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            lists.append([i for m in members[start : start + 8] for i in m])
        nodes, members = above, lists
    return nodes[0], sides


def brute_manifest(rows):
    """``doc_id, leaf, subroot, root, proof, folded, verified`` of each row, as the query gives them."""
    groups = {}
    for row in rows:
        leaf = leaf_of(row.doc_id, row.source, row.lang, row.n_chars, row.text)
        tampered = leaf
        if row.doc_id is not None and crc(row.doc_id) % 3 == 0 and row.text is not None:
            lower = re.sub("[A-Z]", lambda m: m.group().lower(), row.text)
            tampered = leaf_of(row.doc_id, row.source, row.lang, row.n_chars, lower)
        groups.setdefault(row.lang, []).append((row.doc_id, leaf, tampered))
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    found = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        found[name] = (own, *climb([leaf for _, leaf, _ in own]))
    root, upper = climb([found[name][1] for name in names])
    out = []
    for name, on in zip(names, upper, strict=True):
        own, subroot, sides = found[name]
        for (doc_id, leaf, tampered), below in zip(own, sides, strict=True):
            node = tampered
            for left, right in below + on:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in below + on))
            out.append((doc_id, leaf, subroot, root, proof, node, node == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_manifest_like_brute_force(spark, hard, folder):
    hard.write.parquet(f"{folder}/documents.parquet")
    got = queries.op12_merkle_manifest(spark, folder).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_manifest(hard.collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [8], [65, 8, 1, 2, 9], [3] * 20])
def test_manifest_of_any_shape(spark, folder, sizes):
    data = [
        (100 * g + i, f"Text {i}", None if g == 0 else f"l{g}", "s", i)
        for g, size in enumerate(sizes)
        for i in range(size)
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = spark.createDataFrame(data, schema)
    rows.repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = queries.op12_merkle_manifest(spark, folder).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(brute_manifest(rows.collect()))
    assert all(row.verified == (crc(row.doc_id) % 3 != 0) for row in got)


def test_manifest_of_nothing(spark, hard):
    none = merkle.manifest(
        hard.limit(0), F.sha2("text", 256), F.col("lang"), [F.col("doc_id")], {"id": F.col("doc_id")}
    )
    assert none.collect() == []


# --- periodic runs


def brute_runs(seq):
    """Every longest stretch with a period, by trying each period on each place."""
    n, found = len(seq), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if seq[i] != seq[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and seq[end] == seq[end + q]:
                end += 1
            length = end + q - i
            stretch = seq[i : i + length]
            smaller = any(stretch[p:] == stretch[:-p] for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((i, length, q))
            i = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(seq, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return " ".join(word for k, word in enumerate(seq) if k not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def random_texts():
    rnd = random.Random(7)
    texts = []
    for case in range(240):
        letters = "ab" if case % 3 == 0 else "abcd" if case % 3 == 1 else "Abaä日"
        seq = [rnd.choice(letters) for _ in range(rnd.randrange(0, 70))]
        for _ in range(rnd.randrange(0, 4)):
            unit = [rnd.choice(letters) for _ in range(rnd.randrange(1, 31))]
            seq += unit * rnd.randrange(1, 7) + unit[: rnd.randrange(0, len(unit))]
        texts.append(rnd.choice([" ", "\n", " \t "]).join(seq))
    return texts


def test_runs_like_brute_force(spark):
    texts = random_texts()
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(2)
    seen = 0
    for row in periods.periodic_runs(table).collect():
        seq = words_of(texts[row.doc_id])
        runs = brute_runs(seq)
        assert [tuple(run) for run in row.runs] == runs, texts[row.doc_id]
        assert row.n_words == len(seq) and row.collapsed == brute_collapsed(seq, runs)
        seen += len(runs)
    assert seen > 300


def test_runs_of_hard_rows(spark, hard):
    rows = periods.periodic_runs(hard).collect()
    assert len(rows) == len(TEXTS) + 3
    found = {row.doc_id: row for row in rows}
    for i in (1, 2, 3):
        assert (found[i].n_words, found[i].runs, found[i].collapsed) == (0, [], "")
    assert [tuple(run) for run in found[8].runs] == [(0, 80_000, 2)]
    assert found[8].collapsed == "a b" and found[6].collapsed == "x" * 200_000
    assert found[None].collapsed == "no id"
    assert periods.periodic_runs(hard.limit(0)).collect() == []


def test_long_repeats_cost_no_pairs(spark):
    """One word a million times, and long periods: work grows with the words."""
    unit = " ".join(f"w{k % 997}" for k in range(5000))
    table = spark.createDataFrame(
        [(1, "same " * 1_000_000), (2, f"head {unit} {unit} {unit} {unit} tail")],
        "doc_id int, text string",
    )
    found = {row.doc_id: row for row in periods.periodic_runs(table).collect()}
    assert [tuple(run) for run in found[1].runs] == [(0, 1_000_000, 1)]
    assert (1, 20_000, 5000) in [tuple(run) for run in found[2].runs]
    assert found[2].runs[0].period == 997 or found[2].runs[0].period == 5000


def brute_query(row):
    seq = words_of(row.text)
    h = crc(row.doc_id)
    g, n = h // 10, len(seq)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        seq = [seq[i] if i < a else seq[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(seq)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (row.doc_id, len(runs), *best, milli, sha(listed), sha(brute_collapsed(seq, runs)))


def test_query_like_brute_force(spark, tables):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    got = queries.op13_periodic_runs(spark, tables)
    rows = got.select(*names, "runs_sha256", "collapsed_sha256").collect()
    texts = spark.read.parquet(f"{tables}/documents.parquet").filter(F.length("text") < 6000)
    expected = {row.doc_id: brute_query(row) for row in texts.collect()}
    assert len(rows) == 200 and sum(1 for r in expected.values() if r[1]) > 10
    for row in rows:
        if row.doc_id in expected:
            assert tuple(row) == expected[row.doc_id]
