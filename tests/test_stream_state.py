"""State read from checkpoints, state with a start, ratings told apart as they arrive."""

from __future__ import annotations

import random

import pytest

from millrace.operators.lines import accepted, parse_purchases
from millrace.operators.summary import user_totals
from millrace.sources.lines import stream_lines
from millrace.storage import read_batches, write_batch
from millrace.streaming.custom_state import custom_user_totals, rocksdb_state, update_state_by_key
from millrace.streaming.holdout import holdout_stream, parse_rating_lines
from millrace.streaming.purchases import latest_totals, start_each_batch, start_user_totals
from millrace.streaming.state_reader import kept_batches, state_at, state_changes


def drop(spark, texts, folder):
    lines = spark.createDataFrame([(text,) for text in texts], "value string")
    lines.coalesce(2).write.mode("append").text(f"{folder}/lines")


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def run(stream, folder, mode="update"):
    def file(batch, batch_id):
        write_batch(batch, f"{folder}/out", batch_id)

    start_each_batch(stream, file, f"{folder}/state", True, mode).awaitTermination()


def test_any_batch_of_the_state(spark, folder):
    for texts in (["a,x,1", "b,x,2"], ["a,x,3"], ["c,x,5", "b,x,1"]):
        drop(spark, texts, folder)
        events = accepted(parse_purchases(stream_lines(spark, f"{folder}/lines")))
        start_user_totals(events, f"{folder}/out", f"{folder}/state", once=True).awaitTermination()
    checkpoint = f"{folder}/state"
    assert kept_batches(spark, checkpoint) == (0, 2)
    assert rows(latest_totals(spark, checkpoint, 0)) == [("a", 1, 1.0), ("b", 1, 2.0)]
    assert rows(latest_totals(spark, checkpoint, 1)) == [("a", 2, 4.0), ("b", 1, 2.0)]
    assert rows(latest_totals(spark, checkpoint)) == [("a", 2, 4.0), ("b", 2, 3.0), ("c", 1, 5.0)]
    assert rows(state_changes(spark, checkpoint, 1, 2)) == [
        (1, "update", "a", 2, 4.0),
        (2, "update", "b", 2, 3.0),
        (2, "update", "c", 1, 5.0),
    ]


def test_no_state(spark, folder):
    spark.range(1).write.parquet(f"{folder}/other")
    with pytest.raises(Exception):
        kept_batches(spark, f"{folder}/other")


def test_state_that_goes_on_from_a_table(spark, folder):
    history = spark.createDataFrame(
        [("a", 10, 100.0), ("old", 3, 30.0)], "user string, n bigint, revenue double"
    )
    later = spark.createDataFrame([("a", 99, 99.0)], "user string, n bigint, revenue double")
    with rocksdb_state(spark):
        for texts, initial in ((["a,x,1", "b,x,2"], history), (["a,x,1", "a,x,1"], later)):
            drop(spark, texts, folder)
            events = accepted(parse_purchases(stream_lines(spark, f"{folder}/lines")))
            run(custom_user_totals(events, initial=initial), folder)
    # The second start does not take a state up again.
    expected = [("a", 13, 103.0), ("b", 1, 2.0), ("old", 3, 30.0)]
    assert rows(latest_totals(spark, f"{folder}/state", variable="state")) == expected
    filed = read_batches(spark, f"{folder}/out").select("batch_id", "user", "n")
    assert rows(filed) == [(0, "a", 11), (0, "b", 1), (1, "a", 13)]


def test_batch_and_stream_together_are_the_whole(spark, folder):
    rnd = random.Random(4)
    texts = [f"u{rnd.randrange(9)},p,{rnd.randrange(100)}.5" for _ in range(200)]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    first = spark.createDataFrame([(t,) for t in texts[:120]], "value string")
    drop(spark, texts[120:], folder)
    with rocksdb_state(spark):
        events = accepted(parse_purchases(stream_lines(spark, f"{folder}/lines")))
        run(custom_user_totals(events, initial=user_totals(accepted(parse_purchases(first)))), folder)
    got = latest_totals(spark, f"{folder}/state", variable="state")
    assert rows(got) == rows(user_totals(accepted(parse_purchases(lines))))


def test_forgotten_keys(spark, folder):
    def last_two(chunks, state):
        n = (state[0] if state else 0) + sum(len(chunk) for chunk in chunks)
        return (n,) if n < 3 else None

    with rocksdb_state(spark):
        for texts in (["a,x,1", "b,x,1"], ["a,x,1", "a,x,1"]):
            drop(spark, texts, folder)
            events = accepted(parse_purchases(stream_lines(spark, f"{folder}/lines")))
            run(update_state_by_key(events, "user", last_two, "n bigint"), folder)
    left = state_at(spark, f"{folder}/state", variable="state")
    assert rows(left) == [("b", 1)]


def brute(batches, start, stop):
    """Count line by line; within a batch in the order of the positions."""
    seen, out = {}, []
    for batch in batches:
        for user, pos in sorted(batch, key=lambda r: r[1]):
            seen[user] = seen.get(user, 0) + 1
            out.append((pos, user, "test" if start <= seen[user] <= stop else "base"))
    return sorted(out)


@pytest.mark.parametrize("start, stop", [(1, 3), (4, 6)])
def test_holdout_line_by_line(spark, folder, start, stop):
    rnd = random.Random(stop)
    users = [0 if rnd.random() < 0.4 else rnd.randrange(1, 12) for _ in range(400)]
    rated = [(user, pos) for pos, user in enumerate(users)]
    batches = [rated[:5], rated[5:250], rated[250:]]
    for batch in batches:
        mixed = rnd.sample(batch, len(batch))  # the order of lines in a batch means nothing
        texts = [f"{user}\t{pos}\t1.5\t{pos}" for user, pos in mixed]
        drop(spark, [*texts, "broken line", "1\t2\tx\t3"], folder)
        with rocksdb_state(spark):
            arrived = parse_rating_lines(stream_lines(spark, f"{folder}/lines"))
            run(holdout_stream(arrived, start, stop), folder, "append")
    filed = read_batches(spark, f"{folder}/out").select("pos", "user_id", "role")
    assert rows(filed) == brute(batches, start, stop)
    # The state holds a number a user and nothing else.
    state = state_at(spark, f"{folder}/state", variable="seen")
    counts = {u: min(users.count(u), stop) for u in set(users)}
    assert dict(rows(state)) == counts


def test_holdout_calls_the_state_by_part(spark, folder):
    """3000 users in 2 batches, one null and one with text: one call a part, not one a user."""
    def texts(n):
        return [f"{user if user else ''},{pos}" for pos, user in enumerate(list(range(3000)) * n)]

    with rocksdb_state(spark):
        for batch, n in ((0, 2), (1, 3)):
            drop(spark, texts(n), folder)
            lines = stream_lines(spark, f"{folder}/lines").selectExpr("split(value, ',') AS p")
            ratings = lines.selectExpr("nullif(p[0], '') AS who", f"int(p[1]) + {batch}000000 AS pos", "null AS no")
            run(holdout_stream(ratings, 2, 3, user="who"), folder, "append")
    filed = read_batches(spark, f"{folder}/out")
    assert filed.count() == 15_000
    tests = filed.filter("role = 'test'").selectExpr("pos").collect()
    assert {r.pos for r in tests} == {*range(3000, 6000), *range(1_000_000, 1_003_000)}
    state = state_at(spark, f"{folder}/state", variable="seen")
    assert state.columns == ["who", "n"] and dict(rows(state.filter("who < '1'"))) == {}
    assert {r.n for r in state.collect()} == {3} and state.filter("who IS NULL").count() == 1
    parts = spark.read.format("statestore").option("stateVarName", "seen").load(f"{folder}/state")
    assert parts.select("key").distinct().count() < 2100


def test_a_hot_user_sends_few_rows_to_its_state(spark):
    from millrace.streaming.holdout import _first_of_task

    ratings = spark.range(0, 30_000, 1, 3).selectExpr("0L AS user_id", "id AS pos")
    marked = _first_of_task(ratings, "user_id", "pos", 10)
    assert marked.count() == 30_000
    first = [row.pos for row in marked.filter("_first").collect()]
    assert set(range(10)) <= set(first) and len(first) <= 10 * 3 * 2
