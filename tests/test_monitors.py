"""Live monitors: late rows in their place, timers for what does not come, any cut into batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sources.changes import read_changes
from tidemark.streaming.monitors import read_counter_rate, run_counter_rate, run_silent_pipeline

T0 = 1_704_103_200  # 2024-01-01 10:00:00 UTC


def seconds(column):
    return F.unix_seconds(column).alias("s")


def put(spark, work, name, rows, ddl):
    df = spark.createDataFrame(rows, ddl)
    at = df.columns[1]
    df = df.withColumn(at, F.timestamp_seconds(F.col(at)))
    df.coalesce(1).write.mode("append").parquet(f"{work}/{name}")
    return df.schema


def rates(spark, work, batches, **more):
    for rows in [*batches, [("beat", T0 + 10**6, 0.0)], [("beat", T0 + 2 * 10**6, 0.0)]]:
        schema = put(spark, work, "feed", rows, "topic string, sampled_at long, value double")
        feed = read_changes(spark, f"{work}/feed", schema, streaming=True)
        run_counter_rate(feed, f"{work}/out", f"{work}/cp", 0.5, 100, 600, **more).awaitTermination()
    found = read_counter_rate(spark, f"{work}/out").filter("topic <> 'beat'")
    rows = found.select("topic", seconds("sampled_at"), "increase", "firing", "silent").collect()
    return sorted((r["topic"], r["s"] - T0, r["increase"], r["firing"], r["silent"]) for r in rows)


SAMPLES = [
    ("a", T0, 10.0), ("a", T0 + 60, 100.0), ("a", T0 + 120, 5.0), ("a", T0 + 180, 6.0), ("a", T0 + 240, 7.0),
    ("a", T0 + 300, 8.0), ("a", T0 + 2000, 9.0), ("b", T0 + 30, 1.0),
]
WANT = [
    ("a", 60, 90.0, False, False), ("a", 120, 5.0, False, False), ("a", 180, 1.0, False, False),
    ("a", 240, 1.0, True, False), ("a", 300, 1.0, True, False), ("a", 900, None, None, True),
    ("a", 2000, 1.0, True, False), ("a", 2600, None, None, True), ("b", 630, None, None, True),
]


@pytest.mark.parametrize(
    "order", [[range(8)], [[0, 3], [1, 4, 7], [2, 5, 6]], [[5, 4], [3, 2, 1, 0], [7], [6]]]
)
def test_rates_and_alerts_in_any_cut(spark, work, order):
    """The last sample and the start of a breach survive batches; late samples find their place."""
    got = rates(spark, work, [[SAMPLES[i] for i in part] for part in order])
    assert got == sorted(WANT, key=lambda r: (r[0], r[1]))


def test_a_silence_is_shown_while_it_lasts(spark, work):
    """The timer fires without a new sample of the topic, once; a later sample goes on from the last."""
    batches = [[("a", T0, 10.0)], [("x", T0 + 9000, 0.0)], [("x", T0 + 9100, 0.0)]]
    ddl = "topic string, sampled_at long, value double"
    for rows in batches:
        schema = put(spark, work, "feed", rows, ddl)
        feed = read_changes(spark, f"{work}/feed", schema, streaming=True)
        run_counter_rate(feed, f"{work}/out", f"{work}/cp", 0.5, 100, 600).awaitTermination()
    so_far = read_counter_rate(spark, f"{work}/out").filter("topic = 'a'").collect()
    assert [(r["silent"], r["increase"]) for r in so_far] == [(True, None)]
    got = rates(spark, work, [[("a", T0 + 20_000, 30.0)]])
    assert [r[1:] for r in got if r[0] == "a"] == [
        (600, None, None, True), (20_000, 20.0, False, False), (20_600, None, None, True)]


def silent(spark, work, batches):
    for activity, runs in [*batches, ([10**6], [10**6]), ([2 * 10**6], [2 * 10**6])]:
        a = put(spark, work, "activity", [(1, T0 + s) for s in activity], "i int, ts long")
        r = put(spark, work, "runs", [(1, T0 + s) for s in runs], "i int, ts long")
        run_silent_pipeline(
            read_changes(spark, f"{work}/activity", a, streaming=True),
            read_changes(spark, f"{work}/runs", r, streaming=True),
            f"{work}/out", f"{work}/cp",
        ).awaitTermination()
    rows = spark.read.parquet(f"{work}/out").select(seconds("window_start"), "messages").collect()
    return sorted((r["s"] - T0, r["messages"]) for r in rows)


def test_silent_windows_wait_for_late_runs(spark, work):
    """A run and traffic that come late still count; a window is shown once, with all its rows."""
    batches = [([10, 20, 1000], [15]), ([2000, 30], [2900]), ([1100, 3700], [1850])]
    assert silent(spark, work, batches) == [(900, 2), (3600, 1)]


def test_nothing_is_shown_before_both_clocks_have_passed(spark, work):
    a = put(spark, work, "activity", [(1, T0), (1, T0 + 90_000)], "i int, ts long")
    r = put(spark, work, "runs", [(1, T0 - 900)], "i int, ts long")
    run_silent_pipeline(
        read_changes(spark, f"{work}/activity", a, streaming=True),
        read_changes(spark, f"{work}/runs", r, streaming=True), f"{work}/out", f"{work}/cp",
    ).awaitTermination()
    assert dt.datetime.fromtimestamp(T0) and spark.read.schema("messages long").parquet(f"{work}/out").count() == 0


def test_silence_is_found_with_one_store_of_state(spark, work):
    a = put(spark, work, "activity", [(1, T0), (1, T0 + 90_000)], "i int, ts long")
    r = put(spark, work, "runs", [(1, T0 + 90_000)], "i int, ts long")
    query = run_silent_pipeline(
        read_changes(spark, f"{work}/activity", a, streaming=True),
        read_changes(spark, f"{work}/runs", r, streaming=True), f"{work}/out", f"{work}/cp",
    )
    query.awaitTermination()
    assert [o["numStateStoreInstances"] for o in query.lastProgress["stateOperators"]] == [4]  # one a task
    assert [r["messages"] for r in spark.read.parquet(f"{work}/out").collect()] == [1]
