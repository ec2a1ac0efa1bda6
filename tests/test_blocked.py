"""Pairs through blocks of the index against all pairs."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import blocked, meeting
from millrace.operators.similarity import similar_pairs


def brute(vectors, threshold, min_common):
    """``vectors``: id -> {feature: weight}; copies stand for each other."""
    groups = {}
    for id in sorted(vectors):
        groups.setdefault(tuple(sorted(vectors[id].items())), []).append(id)
    firsts = {ids[0]: (vectors[ids[0]], len(ids)) for ids in groups.values()}
    out = []
    for a, (va, ca) in firsts.items():
        for b, (vb, cb) in firsts.items():
            common = va.keys() & vb.keys()
            if a < b and len(common) >= min_common:
                dot = sum(va[f] * vb[f] for f in common)
                cosine = dot / math.sqrt(sum(w * w for w in va.values()) * sum(w * w for w in vb.values()))
                if cosine >= threshold:
                    out.append((a, b, ca, cb, len(common), round(cosine, 8)))
    return sorted(out)


def table(spark, vectors):
    rows = [(id, f, float(w)) for id, v in vectors.items() for f, w in v.items()]
    return spark.createDataFrame(rows, "id bigint, feature string, weight double").repartition(3)


def found(pairs):
    return sorted(
        map(tuple, pairs.select("id_a", "id_b", "copies_a", "copies_b", "common", F.round("cosine", 8)).collect())
    )


def random_vectors(seed, n, features, size):
    rnd = random.Random(seed)
    # Weighted picks, so that some features are in many vectors.
    weights = [1 / (k + 1) for k in range(features)]
    vectors = {}
    for id in range(n):
        own = set(rnd.choices(range(features), weights, k=rnd.randrange(1, size)))
        vectors[id] = {f"f{k}": rnd.choice([1, 1, 2, 5, -1, 9]) for k in own}
    vectors[n] = dict(vectors[3])
    vectors[n + 1] = dict(vectors[3])
    return vectors


@pytest.mark.parametrize(
    "seed, threshold, min_common, block", [(1, 0.2, 1, 10), (2, 0.2, 3, 1 << 14), (3, 0.75, 2, 25)]
)
def test_like_all_pairs(spark, monkeypatch, seed, threshold, min_common, block):
    monkeypatch.setattr(blocked, "BLOCK", block)
    vectors = random_vectors(seed, 90, 60, 12)
    got = blocked.blocked_pairs(table(spark, vectors), threshold, min_common)
    expected = brute(vectors, threshold, min_common)
    assert len(expected) > 20
    assert found(got.pairs) == expected
    copies = {row.id: row.same_as for row in got.copies.collect()}
    assert copies[90] == copies[91] == 3 and len(copies) == 92


def test_a_user_who_rated_everything(spark, monkeypatch):
    """Nearly all pairs share that user, and nearly none of them is looked at."""
    rnd = random.Random(8)
    items = {
        i: {f"u{rnd.randrange(12_000)}": float(rnd.randrange(1, 6)) for _ in range(30)} | {"all": 3.0}
        for i in range(500)
    }
    for i in range(0, 40, 2):  # alike items
        items[i + 1] = dict(list(items[i].items())[:18]) | dict(list(items[i + 1].items())[:9]) | {"all": 3.0}
    vectors = table(spark, items)
    self_join = 500 * 499 // 2
    expected = brute(items, 0.2, 1)
    assert len(expected) >= 20
    seen = {}
    plain = blocked._shipped

    def counted(*args):
        seen["n"] = plain(*args).agg(F.sum(F.size("entries"))).first()[0]
        return plain(*args)

    monkeypatch.setattr(blocked, "_shipped", counted)
    assert found(blocked.blocked_pairs(vectors, 0.2).pairs) == expected
    assert seen["n"] < 0.1 * self_join


def test_the_same_as_the_other_join(spark):
    vectors = table(spark, random_vectors(9, 120, 40, 9))
    assert found(blocked.blocked_pairs(vectors, 0.5).pairs) == found(similar_pairs(vectors, 0.5).pairs)


def test_no_vectors_and_no_pairs(spark):
    vectors = table(spark, {1: {"a": 1}, 2: {"b": 1}})
    assert found(blocked.blocked_pairs(vectors, 0.1).pairs) == []
    assert found(blocked.blocked_pairs(vectors.limit(0), 0.1).pairs) == []
    zero = spark.createDataFrame([(1, "a", 0.0), (2, "a", 0.0)], "id bigint, feature string, weight double")
    assert found(blocked.blocked_pairs(zero, 0.1).pairs) == []


def test_counting_leaves_few_rows(spark, monkeypatch):
    """With several common features an id is one row a feature, however many blocks of ids there are."""
    vectors = random_vectors(4, 200, 300, 14)
    for i in range(0, 200, 2):
        vectors[i]["all"] = 2
    expected = brute(vectors, 0.2, 3)
    assert len(expected) > 20
    seen = {}
    plain = blocked._shipped

    def kept(*args):
        found = plain(*args)
        seen["lists"], seen["met"] = found.count(), found.agg(F.sum(F.size("entries"))).first()[0]
        seen["types"] = dict(found.dtypes)
        return found

    monkeypatch.setattr(blocked, "_shipped", kept)
    monkeypatch.setattr(meeting, "SELDOM", 1 << 14)
    monkeypatch.setattr(blocked, "BLOCK", 1 << 14)
    assert found(blocked.blocked_pairs(table(spark, vectors), 0.2, 3).pairs) == expected
    assert seen["lists"] <= sum(len(v) for v in vectors.values())
    assert seen["types"]["entries"] == "array<int>" and seen["types"]["sizes"] == "array<tinyint>"


@pytest.mark.parametrize("seldom, min_common", [(0, 2), (6, 2), (6, 4), (1 << 8, 3)])
def test_frequent_features_are_not_lost(spark, monkeypatch, seldom, min_common):
    """Pairs whose common features are partly too frequent to meet at."""
    monkeypatch.setattr(meeting, "SELDOM", seldom)
    monkeypatch.setattr(blocked, "BLOCK", 16)
    vectors = random_vectors(6, 90, 40, 16)
    expected = brute(vectors, 0.2, min_common)
    assert len(expected) > 20
    assert found(blocked.blocked_pairs(table(spark, vectors), 0.2, min_common).pairs) == expected
    assert found(similar_pairs(table(spark, vectors), 0.2, min_common).pairs) == expected
