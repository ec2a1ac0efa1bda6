"""Purchase lines, summaries and state, in batch and as streams."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.lines import accepted, by_user, parse_purchases, quarantined
from millrace.operators.state import user_totals_history
from millrace.operators.summary import (
    first_rows,
    products_by_popularity,
    purchase_summary,
    report_line,
    user_totals,
)
from millrace.sources.lines import read_lines, stream_lines
from millrace.storage import read_batches, write_batch
from millrace.streaming.custom_state import (
    custom_user_totals,
    rocksdb_state,
    update_state_by_key,
)
from millrace.streaming.purchases import (
    latest_totals,
    start_console,
    start_each_batch,
    start_preview,
    start_summaries,
    start_user_totals,
    start_window_totals,
    triggered,
)

BATCHES = [
    ["u1,lamp,10.00", "u2,desk,20.50", "u1,lamp,10.00", "u3,desk,4.50"],
    ["u2,lamp,1.25", "u4,chair,2.00"],
]
STATE_1 = {("u1", 2, 20.0), ("u2", 1, 20.5), ("u3", 1, 4.5)}
STATE_2 = {("u1", 2, 20.0), ("u2", 2, 21.75), ("u3", 1, 4.5), ("u4", 1, 2.0)}


def lines(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def purchases(spark, texts):
    return accepted(parse_purchases(lines(spark, texts)))


def drop(spark, texts, folder):
    lines(spark, texts).coalesce(1).write.mode("append").text(f"{folder}/lines")


def rows(frame):
    return {tuple(row) for row in frame.collect()}


@pytest.mark.parametrize(
    "line, problem, price",
    [
        ("u1,lamp,10.00", None, 10.0),
        ("u1,lamp", "too few fields", None),
        ("u1,lamp,", "bad price", None),
        ("", "too few fields", None),
        ("u1,lamp,abc", "bad price", None),
        ("u1,lamp,NaN", "bad price", None),
        ("u1,lamp,Infinity", "bad price", None),
        ("u1,lamp, 1.5 ", None, 1.5),
        ("u1,lamp,1.5d", None, 1.5),
        ("u1,lamp,1.0,x", None, 1.0),
        (" u1 ,lamp,-2", None, -2.0),
    ],
)
def test_parse_line(spark, line, problem, price):
    row = parse_purchases(lines(spark, [line])).first()
    assert (row["problem"], row["price"]) == (problem, price)
    if problem is None:
        assert row["user"] == line.split(",")[0]


def test_quarantine_keeps_the_text(spark):
    parsed = parse_purchases(lines(spark, ["u1,lamp,1", "broken", "u1,lamp,x"]))
    assert rows(quarantined(parsed)) == {("broken", "too few fields"), ("u1,lamp,x", "bad price")}
    assert rows(accepted(parsed)) == {("u1", "lamp", 1.0)}


def test_failfast(spark):
    good = parse_purchases(lines(spark, ["u1,lamp,1"]), mode="failfast")
    assert good.count() == 1
    with pytest.raises(PySparkException, match="bad price"):
        parse_purchases(lines(spark, ["u1,lamp,1", "u1,lamp,x"]), mode="failfast").collect()
    with pytest.raises(ValueError):
        parse_purchases(lines(spark, []), mode="other")


def test_by_user(spark):
    row = by_user(purchases(spark, ["u1,lamp,1.5"])).first()
    assert (row["user"], tuple(row["item"])) == ("u1", ("lamp", 1.5))


@pytest.mark.parametrize(
    "texts, expected",
    [
        (BATCHES[0], (4, 3, 45.0, "desk", 2)),
        (BATCHES[1], (2, 2, 3.25, "chair", 1)),
        ([], (0, 0, 0.0, None, 0)),
    ],
)
def test_summary_of_a_batch(spark, texts, expected):
    assert [tuple(r) for r in purchase_summary(purchases(spark, texts)).collect()] == [expected]


def test_summary_by_key_with_missing_values(spark):
    data = [("a", None, "x", 1.0), ("a", "u", None, 2.0), ("a", "u", "x", 4.0), ("b", "u", "y", 8.0)]
    frame = spark.createDataFrame(data, "k string, user string, product string, price double")
    assert rows(purchase_summary(frame, ["k"])) == {("a", 3, 1, 7.0, "x", 2), ("b", 1, 1, 8.0, "y", 1)}


def test_summary_of_one_hot_user_and_product(spark):
    """Most rows in one key: only combined rows are shuffled."""
    frame = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("user"),
        F.when(F.col("id") % 3 > 0, "best").otherwise("other").alias("product"),
        F.lit(1.0).alias("price"),
    )
    assert tuple(purchase_summary(frame).first()) == (30000, 10001, 30000.0, "best", 20000)


def test_report_line(spark):
    summary = report_line(purchase_summary(purchases(spark, BATCHES[0])))
    assert summary.first()["line"] == "desk leads with 2 sold"


def test_popularity_is_sorted(spark):
    popular = products_by_popularity(purchases(spark, BATCHES[0] + BATCHES[1])).collect()
    assert [tuple(r) for r in popular] == [("lamp", 3), ("desk", 2), ("chair", 1)]


def test_first_rows(spark):
    frame = spark.range(100).select("id")
    assert [r[0] for r in first_rows(frame, ["id"], 3).collect()] == [0, 1, 2]


def test_user_totals(spark):
    assert rows(user_totals(purchases(spark, BATCHES[0]))) == STATE_1


def test_history_repeats_totals_until_they_change(spark):
    data = [(0, "a", 1.0), (0, "a", 2.0), (2, "b", 5.0), (3, "a", 4.0)]
    frame = spark.createDataFrame(data, "day int, user string, price double")
    assert rows(user_totals_history(frame, "day")) == {
        (0, "a", 2, 3.0),
        (1, "a", 2, 3.0),
        (2, "a", 2, 3.0),
        (2, "b", 1, 5.0),
        (3, "a", 3, 7.0),
        (3, "b", 1, 5.0),
    }


def test_stream_summaries_with_an_empty_batch_and_quarantine(spark, folder):
    def run():
        start_summaries(
            stream_lines(spark, f"{folder}/lines"),
            f"{folder}/out",
            f"{folder}/state",
            quarantine=f"{folder}/bad",
            once=True,
        ).awaitTermination()

    for texts in (*BATCHES, ["broken"]):
        drop(spark, texts, folder)
        run()
    summary = read_batches(spark, f"{folder}/out").select("batch_id", "*").drop("batch_id")
    assert rows(read_batches(spark, f"{folder}/out").select("batch_id", *summary.columns)) == {
        (0, 4, 3, 45.0, "desk", 2),
        (1, 2, 2, 3.25, "chair", 1),
        (2, 0, 0, 0.0, None, 0),
    }
    bad = read_batches(spark, f"{folder}/bad").select("batch_id", "value", "problem")
    assert rows(bad) == {(2, "broken", "too few fields")}


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_running_totals_go_on_after_a_restart(spark, folder, mode):
    for texts, state in zip(BATCHES, (STATE_1, STATE_2)):
        drop(spark, texts, folder)
        events = accepted(parse_purchases(stream_lines(spark, f"{folder}/lines")))
        start_user_totals(
            events, f"{folder}/out", f"{folder}/state", mode, once=True
        ).awaitTermination()
        assert rows(latest_totals(spark, f"{folder}/state")) == state
    filed = read_batches(spark, f"{folder}/out").filter("batch_id = 1").drop("batch_id")
    changed = {row for row in STATE_2 if row[0] in ("u2", "u4")}
    assert rows(filed) == (STATE_2 if mode == "complete" else changed)


def test_stream_in_many_batches_equals_one_batch(spark, folder):
    texts = [f"u{i % 7},p{i % 3},{i}.25" for i in range(60)]
    for start in range(0, 60, 10):
        drop(spark, texts[start : start + 10], folder)
    stream = stream_lines(spark, f"{folder}/lines", max_files_per_trigger=1)
    query = start_user_totals(
        accepted(parse_purchases(stream)), f"{folder}/out", f"{folder}/state", once=True
    )
    query.awaitTermination()
    assert read_batches(spark, f"{folder}/out").select("batch_id").distinct().count() == 6
    batch = user_totals(accepted(parse_purchases(read_lines(spark, f"{folder}/lines"))))
    assert rows(latest_totals(spark, f"{folder}/state")) == rows(batch)


def test_a_repeated_batch_counts_once(spark, folder):
    for _ in range(2):
        write_batch(purchase_summary(purchases(spark, BATCHES[0])), folder, 0)
    assert read_batches(spark, folder).count() == 1


def test_preview_and_callback(spark, folder):
    seen = []
    drop(spark, [f"{i:02}" for i in range(20)], folder)
    stream = stream_lines(spark, f"{folder}/lines")
    start_preview(
        stream, ["value"], f"{folder}/out", f"{folder}/state-1", n=3, once=True
    ).awaitTermination()
    assert rows(read_batches(spark, f"{folder}/out").select("value")) == {("00",), ("01",), ("02",)}
    start_each_batch(
        stream, lambda batch, id: seen.append((id, batch.count())), f"{folder}/state-2", once=True
    ).awaitTermination()
    assert seen == [(0, 20)]


def test_console(spark, folder):
    drop(spark, BATCHES[0], folder)
    query = start_console(
        stream_lines(spark, f"{folder}/lines"), f"{folder}/state", once=True
    )
    query.awaitTermination()
    assert query.exception() is None


def test_window_totals_close_with_the_watermark(spark, folder):
    texts = ["2024-01-01 00:10,u1,1.0,b", "2024-01-01 00:20,u1,2.0,a", "2024-01-01 00:50,u2,4.0,b",
             "2024-01-01 01:10,u1,8.0,z", "2024-01-01 05:00,u3,16.0,a"]
    drop(spark, texts, folder)
    part = F.split("value", ",")
    events = stream_lines(spark, f"{folder}/lines").select(
        part[0].cast("timestamp").alias("time"),
        part[1].alias("user"),
        part[3].alias("product"),
        part[2].cast("double").alias("price"),
    )
    start_window_totals(
        events, "time", "1 hour", "10 minutes", f"{folder}/out", f"{folder}/state", once=True
    ).awaitTermination()
    closed = spark.read.parquet(f"{folder}/out").select(
        F.date_format("window_start", "HH:mm"), "purchases", "unique_users", "revenue",
        "top_product", "top_count",
    )
    assert rows(closed) == {("00:00", 3, 2, 7.0, "b", 2), ("01:00", 1, 1, 8.0, "z", 1)}


def _run_state(spark, folder, state_of):
    events = accepted(parse_purchases(stream_lines(spark, f"{folder}/lines")))
    with rocksdb_state(spark):
        (
            state_of(events)
            .writeStream.outputMode("update")
            .foreachBatch(lambda batch, id: write_batch(batch, f"{folder}/out", id))
            .option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )


def test_custom_state_equals_the_built_in(spark, folder):
    for texts, state in zip(BATCHES, (STATE_1, STATE_2)):
        drop(spark, texts, folder)
        _run_state(spark, folder, custom_user_totals)
        assert rows(latest_totals(spark, f"{folder}/state", variable="state")) == state


def test_custom_state_can_forget_a_key(spark, folder):
    def last_two(chunks, state):
        n = (state[0] if state else 0) + sum(len(chunk) for chunk in chunks)
        return (n,) if n < 3 else None

    for texts in (["u1,a,1", "u2,a,1"], ["u1,a,1", "u1,a,1"], ["u1,a,1"]):
        drop(spark, texts, folder)
        _run_state(spark, folder, lambda e: update_state_by_key(e, "user", last_two, "n bigint"))
    filed = read_batches(spark, f"{folder}/out").select("batch_id", "user", "n")
    assert rows(filed) == {(0, "u1", 1), (0, "u2", 1), (2, "u1", 1)}


def test_a_batch_every_ten_seconds_unless_once():
    class Writer:
        def __init__(self):
            self.asked = {}

        def option(self, name, value):
            self.asked[name] = value
            return self

        def trigger(self, **kind):
            self.asked |= kind
            return self

    assert triggered(Writer(), "c", False).asked == {
        "checkpointLocation": "c",
        "processingTime": "10 seconds",
    }
    assert triggered(Writer(), "c", True).asked["availableNow"]
