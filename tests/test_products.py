"""Best items by blocks of falling length against all products."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import products, recommend


def table(spark, matrix, id):
    return spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(matrix)], f"{id} bigint, factors array<double>"
    )


def brute(users, items, n):
    rows = []
    for u, row in enumerate(np.einsum("ij,kj->ik", users, items)):
        order = np.lexsort((np.arange(len(row)), -row))[:n]
        rows += [(u, place + 1, int(i), float(row[i])) for place, i in enumerate(order)]
    return rows


@pytest.mark.parametrize("first, most", [(3, 40), (1 << 12, 1 << 22)])
def test_like_all_products(spark, monkeypatch, first, most):
    monkeypatch.setattr(products, "FIRST", first)
    monkeypatch.setattr(products, "BLOCK_NUMBERS", most)
    rnd = np.random.default_rng(2)
    users = rnd.integers(-5, 6, (150, 4)).astype(float)
    items = rnd.integers(-5, 6, (37, 4)) * rnd.integers(1, 4, (37, 1)).astype(float)
    users[7] = 0  # all scores tie
    items[9] = items[4]
    got = products.top_products(table(spark, users, "user_id"), table(spark, items, "item_id"), 6)
    rows = got.select("user_id", "place", "item_id", "score").collect()
    assert sorted(map(tuple, rows)) == brute(users, items, 6)


def test_few_products(spark, monkeypatch):
    monkeypatch.setattr(products, "_ITEMS", 64)
    rnd = np.random.default_rng(5)
    users = rnd.standard_normal((300, 8))
    items = rnd.standard_normal((9000, 8)) * rnd.pareto(1.5, (9000, 1))
    got = products.top_products(table(spark, users, "user_id"), table(spark, items, "item_id"), 5)
    rows = got.collect()
    assert sorted(tuple(row)[:4] for row in rows) == brute(users, items, 5)
    assert np.mean([row.scored for row in rows]) < 0.1 * 9000


def test_fewer_items_and_none(spark):
    users, items = np.eye(3), np.eye(3)[:2]
    got = products.top_products(table(spark, users, "user_id"), table(spark, items, "item_id"), 5)
    assert sorted(tuple(row)[:4] for row in got.collect()) == brute(users, items, 5)
    none = table(spark, items, "item_id").limit(0)
    assert products.top_products(table(spark, users, "user_id"), none, 5).collect() == []
    nobody = table(spark, users, "user_id").limit(0)
    assert products.top_products(nobody, table(spark, items, "item_id"), 5).collect() == []


def test_a_null_factor_is_an_error(spark):
    bad = spark.createDataFrame([(1, [1.0, None])], "user_id bigint, factors array<double>")
    with pytest.raises(Exception, match="null"):
        products.top_products(bad, table(spark, np.eye(2), "item_id"), 1).collect()


def test_like_the_model(spark):
    rnd = np.random.default_rng(1)
    data = [(u, i, float(rnd.integers(1, 6))) for u in range(40) for i in rnd.choice(60, 12, False)]
    ratings = spark.createDataFrame(
        [(u, int(i), r) for u, i, r in data], "user_id int, item_id int, rating double"
    )
    model = recommend.factorise(ratings, rank=6, iterations=4)
    pruned = {(r.user_id, r.place): r for r in recommend.pruned_top_items(model, 7).collect()}
    full = {(r.user_id, r.place): r for r in recommend.top_items(model, 7).collect()}
    assert pruned.keys() == full.keys()
    for key, row in full.items():
        assert pruned[key].item_id == row.item_id
        assert pruned[key].score == pytest.approx(row.score, rel=1e-5)
    some = spark.createDataFrame([(3,), (3,), (5,)], "user_id int")
    few = recommend.pruned_top_items(model, 7, some).select("user_id", "place", "item_id").collect()
    assert sorted(map(tuple, few)) == sorted(
        (u, p, r.item_id) for (u, p), r in pruned.items() if u in (3, 5)
    )


def test_lists_without_all_products(spark, monkeypatch):
    """``top_items`` leaves out items that cannot be listed, and scores are floats as in the model."""
    from pyspark.ml.recommendation import ALSModel

    rnd = np.random.default_rng(4)
    data = [(u, int(i), float(rnd.integers(1, 6))) for u in range(30) for i in rnd.choice(50, 9, False)]
    ratings = spark.createDataFrame(data, "user_id int, item_id int, rating double")
    model = recommend.factorise(ratings, rank=5, iterations=3)
    full = {
        row.user_id: [(r.item_id, r.rating) for r in row.recommendations]
        for row in model.recommendForAllUsers(6).collect()
    }

    def refused(*_):
        raise AssertionError("all products")

    monkeypatch.setattr(ALSModel, "recommendForAllUsers", refused)
    got = recommend.top_items(model, 6)
    assert dict(got.dtypes) == {"user_id": "int", "place": "int", "item_id": "int", "score": "double"}
    for row in got.collect():
        item, score = full[row.user_id][row.place - 1]
        assert row.item_id == item and row.score == pytest.approx(score, rel=1e-6)
    assert got.count() == sum(map(len, full.values()))


def test_slow_products_only_where_they_count(monkeypatch):
    """Products in fixed order are few; the lists are those of all of them, ties included."""
    rnd = np.random.default_rng(6)
    users = rnd.integers(-3, 4, (40, 6)).astype(float)
    items = rnd.integers(-3, 4, (20_000, 6)).astype(float)
    norms = np.sqrt((items * items).sum(axis=1))
    order = np.lexsort((np.arange(len(items)), -norms))
    seen, plain = [], np.einsum

    def counted(*args):
        out = plain(*args)
        seen.append(out.size)
        return out

    monkeypatch.setattr(products.np, "einsum", counted)
    scores, ids = np.full((40, 5), -np.inf), np.full((40, 5), np.iinfo(np.int64).max)
    lengths = np.sqrt((users * users).sum(axis=1))
    met = products._scored(users, lengths, scores, ids, (order, items[order], norms[order]))
    monkeypatch.undo()
    expected = brute(users, items, 5)
    assert [(u, p + 1, int(ids[u, p]), scores[u, p]) for u in range(40) for p in range(5)] == expected
    assert sum(seen) < 0.5 * met.sum()
