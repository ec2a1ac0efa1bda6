"""Unique users of ranges from bitmaps, and merge functions of the caller's own."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.operators import combine, unique
from millrace.plans.events import dearest


def test_ranges_of_any_length(spark):
    rnd = random.Random(3)
    events = [(rnd.randrange(40) if rnd.random() < 0.7 else 0, f"u{rnd.randrange(300)}") for _ in range(900)]
    events += [(None, "u1"), (3, None), (60, "late")]
    table = spark.createDataFrame(events, "day int, user string").repartition(5)
    numbers = unique.number_users(table)
    bitmaps = unique.window_bitmaps(table, numbers, "day")
    spans = unique.window_spans(bitmaps, 20)
    asked = [(a, a + n) for a in range(-3, 62) for n in range(20)] + [(0, 0)]
    got = unique.unique_in_ranges(spans, spark.createDataFrame(asked, "first int, last int"))
    found = {(r["first"], r["last"]): r.unique_users for r in got.collect()}
    assert len(found) == len(set(asked))
    for a, b in asked:
        users = {u for d, u in events if d is not None and u is not None and a <= d <= b}
        assert found[a, b] == len(users), (a, b)


def test_many_users_and_later_ones(spark):
    early = spark.range(0, 70_000, 1, 3).select(F.col("id").alias("user"), F.lit(1).alias("day"))
    late = spark.range(50_000, 120_000, 1, 4).select(F.col("id").alias("user"), F.lit(2).alias("day"))
    numbers = unique.number_users(early)
    both = numbers.unionByName(unique.number_users(late, numbers))
    assert both.count() == both.select("number").distinct().count() == 120_000
    bitmaps = unique.window_bitmaps(early.unionByName(late), both, "day")
    asked = spark.createDataFrame([(1, 1), (2, 2), (1, 2)], "first int, last int")
    got = unique.unique_in_ranges(unique.window_spans(bitmaps, 2), asked).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 70_000), (1, 2, 120_000), (2, 2, 70_000)]
    # A bit a user and not a row a user.
    assert bitmaps.count() < 40


def test_nobody(spark):
    none = spark.createDataFrame([], "day int, user string")
    spans = unique.window_spans(unique.window_bitmaps(none, unique.number_users(none), "day"), 7)
    asked = spark.createDataFrame([(1, 5)], "first int, last int")
    assert [tuple(r) for r in unique.unique_in_ranges(spans, asked).collect()] == [(1, 5, 0)]


def expected(rows):
    best = {}
    for user, product, price in rows:
        own = best.setdefault(user, {})
        own[product] = max(own.get(product, price), price)
    return sorted(
        (
            (user, product, price)
            for user, own in best.items()
            for product, price in sorted(own.items(), key=lambda e: (-e[1], e[0]))[:3]
        ),
        key=repr,
    )


@pytest.mark.parametrize("gathered, fan, parts", [(1 << 16, 16, 3), (20, 2, 23)])
def test_merged_in_a_tree(spark, monkeypatch, gathered, fan, parts):
    monkeypatch.setattr(combine, "_GATHERED", gathered)
    monkeypatch.setattr(combine, "FAN", fan)
    rnd = random.Random(gathered)
    rows = [
        (
            "hot" if rnd.random() < 0.4 else rnd.choice([None, *(f"u{k}" for k in range(40))]),
            rnd.randrange(9),
            float(rnd.randrange(50)),
        )
        for _ in range(3000)
    ]
    table = spark.createDataFrame(rows, "user string, product int, price double").repartition(parts)
    got = combine.combined_by_key(table, ["user"], dearest).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)
    assert combine.combined_by_key(table.limit(0), ["user"], dearest).collect() == []


def test_a_hot_key_is_never_in_one_call(spark):
    table = spark.range(0, 200_000, 1, 20).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("user"),
        (F.col("id") % 11).alias("product"),
        (F.col("id") % 977).cast("double").alias("price"),
    )

    def counted(rows: pa.Table) -> pa.Table:
        if rows.num_rows > 120_000:
            raise ValueError("too many rows in one call")
        return dearest(rows)

    got = combine.combined_by_key(table, ["user"], counted)
    hot = got.filter("user = 'hot'").collect()
    assert [row.price for row in hot] == [976.0] * 3
    assert got.count() == 3 + 66_667
