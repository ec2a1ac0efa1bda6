"""Copies and near copies against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import exact, minhash
from millrace.llm import words as W
from millrace.llm.components import components, joined
from millrace.storage import _MADE, stored


def family(seed: int, n: int, size: int, edits: int) -> list[str]:
    """A text and variants of it with some words replaced, left out or put in."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(n):
        own = list(draw.choice([base, out[-1].split()]))
        for _ in range(draw.randrange(edits)):
            at = draw.randrange(len(own))
            own[at : at + draw.randrange(2)] = [word()][: draw.randrange(2)]
        out.append(" ".join(own))
    return out


def brute(texts, words):
    """Set size and smallest connected index of each text."""
    sets = []
    for text in texts:
        own = [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        runs = [tuple(own[i : i + words]) for i in range(len(own) - words + 1)]
        sets.append(set(runs or ([tuple(own)] if own else [])))
    above = list(range(len(texts)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * len(a | sets[j]):
                x, y = top(i), top(j)
                above[max(x, y)] = min(x, y)
    return [(len(s), top(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("words", [2, 5])
def test_components_like_brute_force(spark, words):
    texts = ["", "a", "A", "a b", "a b c d e f", "a b c d e f g"]
    texts += [t for seed in range(6) for t in family(seed, 25, 60 + 20 * seed, 8 + seed)]
    texts += family(77, 120, 150, 30)  # one dense family: most of its pairs are not alike
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(tuple(r) for r in minhash.near_copies(rows.repartition(3), words=words).collect())
    wanted = [(i, n, c, i == c) for i, (n, c) in enumerate(brute(texts, words))]
    assert got == wanted
    left = {r.doc_id for r in minhash.near_dedup(rows, words=words).collect()}
    assert left == {i for i, _, _, kept in wanted if kept}


def test_signature_estimates_similarity():
    draw = np.random.default_rng(1)
    pool = np.unique(draw.integers(0, 1 << 63, 1200).astype(np.uint64))
    a, b = np.sort(pool[:1000]), np.sort(pool[200:1100])
    sizes = np.array([len(a), len(b)])
    table = minhash.signatures(np.concatenate([a, b]), sizes, 4000)
    assert abs((table[0] == table[1]).mean() - 800 / 1100) < 0.04
    few = np.sort(pool[:7])
    table = minhash.signatures(few, np.array([7]), 160)
    assert set(table[0].tolist()) <= set(few.tolist())


def test_words_do_not_depend_on_neighbours():
    texts = ["Abc dé\tabc", "", "abc", None, "x" * 3_000_000 + " abc", "b abc\x0b"]
    hashes, counts = W.word_hashes(*W.text_bytes(pa.array(texts)))
    assert counts.tolist() == [3, 0, 1, 0, 2, 2]
    assert len({hashes[i] for i in (0, 2, 3, 5, 7)}) == 1 and len(set(hashes.tolist())) == 4
    pairs, runs = W.shingle_hashes(hashes, counts, 2)
    assert runs.tolist() == [2, 0, 1, 0, 1, 1] and len(set(pairs.tolist())) == 5


def test_long_chains_are_one_component(spark):
    chain = [(i, i + 1) for i in range(1, 200)] + [(500, 900), (900, 700)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {i: 1 for i in range(1, 201)} | {i: 500 for i in (500, 700, 900)}


def test_new_links_join_components(spark):
    first = [(1, 2), (2, 3), (5, 6), (9, 10)]
    labels = components(spark.createDataFrame(first, "a bigint, b bigint"))
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert sorted(map(tuple, joined(labels, none).collect())) == sorted(map(tuple, labels.collect()))
    more = spark.createDataFrame([(5, 4), (4, 1), (20, 30), (30, 20)], "a bigint, b bigint")
    got = {r.id: r.component for r in joined(labels, more).collect()}
    assert got == dict.fromkeys([1, 2, 3, 4, 5, 6], 1) | {9: 9, 10: 9, 20: 20, 30: 20}


@pytest.fixture
def many_partitions(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = [spark.conf.get(name) for name in names]
    for name, value in zip(names, ("24", "false"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def test_small_tables_are_few_files(spark, many_partitions):
    counts = spark.range(5000).groupBy((F.col("id") * 7).alias("key")).count()
    for most, files in ((10, 16), (20 << 16, 20), (1 << 30, 24)):
        table = stored(counts, "counts", most)
        assert table.count() == 5000 and len(table.inputFiles()) == files
    texts = [t for seed in range(2) for t in family(seed, 12, 60, 9)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    made = _MADE[spark.sparkContext.applicationId]
    begin = len(made)
    got = sorted(tuple(r) for r in minhash.near_copies(rows.coalesce(1), words=2).collect())
    assert got == [(i, n, c, i == c) for i, (n, c) in enumerate(brute(texts, 2))]
    assert max(len(spark.read.parquet(path).inputFiles()) for path in made[begin:]) <= 16


def test_exact_like_brute_force(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab \t\n") for _ in range(draw.randrange(9))) for _ in range(600)]
    head = "same beginning " * 10
    texts += [head + "x", head + "y", head + "x", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    groups: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    wanted = sorted((i, g[0], len(g), i == g[0]) for g in groups.values() for i in g)
    assert sorted(tuple(r) for r in exact.exact_groups(rows).collect()) == wanted
    assert {r.doc_id for r in exact.exact_dedup(rows).collect()} == {g[0] for g in groups.values()}


@pytest.mark.parametrize("dedup", [exact.exact_dedup, minhash.near_dedup])
def test_other_texts_of_an_id_stay(spark, dedup):
    a, b, c = ("".join(f"{letter}{i} " for i in range(40)) for letter in "abc")
    data = [(1, a), (5, a), (5, b), (5, b), (7, c), (None, a), (8, c), (8, "")]
    rows = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("_n1", F.lit("x"))
    got = {(r.doc_id, r.text) for r in dedup(rows).collect()}
    assert got == {(1, a), (5, b), (7, c), (None, a), (8, "")}


def test_hot_text_is_split(spark):
    """The join of copies with their groups is one that Spark can split."""
    rows = spark.range(3000).selectExpr("id AS doc_id", "'one text' AS text")
    joins = exact.exact_groups(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in joins
