"""Positions, folds, holdouts and their outputs."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import splits
from millrace.operators.positions import values_at

USERS = [1, 2, 1, 1, 2, 3, 1, 2, 3, 1]
ITEMS = [5, 1, 2, 9, 3, 1, 1, 2, 4, 7]
VALUES = [3, 4, 5, 1, 2, 5, 4, 3, 2, 5]


@pytest.fixture(scope="module")
def ratings(spark):
    data = [(u, i, float(r), p) for p, (u, i, r) in enumerate(zip(USERS, ITEMS, VALUES))]
    return spark.createDataFrame(
        data, "user_id bigint, item_id bigint, rating double, pos bigint"
    ).repartition(3)


def test_pos(rows):
    return sorted(row["pos"] for row in rows.filter("role = 'test'").collect())


test_pos.__test__ = False


@pytest.mark.parametrize("fold, expected", [(0, [0, 1]), (2, [4, 5]), (4, [8, 9])])
def test_five_folds(ratings, fold, expected):
    folded = splits.contiguous_folds(ratings, "pos", 5)
    assert sorted(r["pos"] for r in folded.filter(F.col("fold") == fold).collect()) == expected
    base, test = splits.fold_pair(ratings, "pos", fold, 5)
    assert sorted(r["pos"] for r in test.collect()) == expected
    assert sorted(r["pos"] for r in base.collect()) == [p for p in range(10) if p not in expected]


@pytest.mark.parametrize("n, folds", [(10, 3), (3, 5), (7, 7), (1, 4), (0, 3), (100, 6)])
def test_fold_rule_for_any_size(spark, n, folds):
    keys = random.Random(n).sample(range(-(10**12), 10**12), n)
    frame = spark.createDataFrame([(k,) for k in keys], "key bigint")
    found = {r["key"]: r["fold"] for r in splits.contiguous_folds(frame, "key", folds).collect()}
    assert found == {key: p * folds // n for p, key in enumerate(sorted(keys))}
    slices = [sorted(r["key"] for r in s.collect()) for s in splits.fold_slices(frame, "key", folds)]
    assert sum(slices, []) == sorted(keys)
    for fold in range(folds):
        base, test = splits.fold_pair(frame, "key", fold, folds)
        assert {r["key"] for r in test.collect()} == {k for k, f in found.items() if f == fold}
        assert base.count() + test.count() == n


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**40), 2**40), max_size=60), st.lists(st.integers(-2, 70), max_size=5))
def test_values_at_positions(spark, keys, positions):
    frame = spark.createDataFrame([(k,) for k in keys], "key bigint")
    ordered = sorted(keys)
    expected = {p: ordered[p] for p in positions if 0 <= p < len(keys)}
    assert values_at(frame, "key", positions) == expected


def test_fold_roles_repeat_every_row_for_every_fold(ratings):
    paired = splits.fold_roles(splits.contiguous_folds(ratings, "pos", 5), 5)
    assert paired.count() == 50
    tests = {(r["fold"], r["pos"]) for r in paired.filter("role = 'test'").collect()}
    assert tests == {(p // 2, p) for p in range(10)}


@pytest.mark.parametrize(
    "start, stop, cap, expected",
    [
        (1, 2, 0, [0, 1, 2, 4, 5, 8]),
        (1, 2, -1, [0, 1, 2, 4, 5, 8]),
        (1, 2, 3, [0, 1, 2]),
        (1, 2, 6, [0, 1, 2, 4, 5, 8]),
        (1, 2, 100, [0, 1, 2, 4, 5, 8]),
        (2, 3, 0, [2, 3, 4, 7, 8]),
        (4, 9, 0, [6, 9]),
        (11, 20, 0, []),
        (11, 20, 5, []),
    ],
)
def test_user_holdout(ratings, start, stop, cap, expected):
    split = splits.user_holdout(ratings, start, stop, cap)
    assert split.count() == 10
    assert test_pos(split) == expected


def test_holdout_ranks_a_hot_user_in_the_map_tasks(spark):
    frame = spark.range(0, 9000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user_id"),
        F.col("id").alias("pos"),
    )
    # The ranges that the split joins are filed; this is the plan that files them.
    chosen = splits.ranked_between(frame, 1, 10, "user_id", "pos")
    ranges = chosen.groupBy("user_id").agg(F.min("pos"), F.max("pos"))
    plan = ranges._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    split = splits.user_holdout(frame, 1, 10)
    hot = split.filter("user_id = 0")
    assert test_pos(hot) == [3 * i for i in range(10)]
    assert split.filter("role = 'test'").count() == 6000 + 10


def test_split_by_date(spark):
    frame = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-19 23:59:59' AS ts UNION ALL SELECT TIMESTAMP_NTZ'2024-01-20'"
    )
    found = {str(r["ts"]): r["split"] for r in splits.split_by_date(frame, "ts", "2024-01-20").collect()}
    assert found == {"2024-01-19 23:59:59": "train", "2024-01-20 00:00:00": "test"}


def test_written_pairs_are_sorted(spark, ratings, folder):
    folded = splits.fold_roles(splits.contiguous_folds(ratings, "pos", 5), 5)
    splits.write_pairs(folded.coalesce(1), folder)
    base = spark.read.parquet(f"{folder}/fold=0/role=base").collect()
    assert [(r["user_id"], r["item_id"]) for r in base][:4] == [(1, 1), (1, 2), (1, 7), (1, 9)]
    read = spark.read.parquet(folder)
    assert read.filter("role = 'test'").count() == 10
    assert read.count() == 50


def test_written_holdout(spark, ratings, folder):
    splits.write_pairs(splits.user_holdout(ratings, 1, 2), folder)
    assert spark.read.parquet(f"{folder}/role=test").count() == 6
    assert spark.read.parquet(f"{folder}/role=base").count() == 4
