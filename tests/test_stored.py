"""Stored tables refuse what would corrupt them; streams lose no late message; landing keeps all."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.contracts import contract_for, contracts_of
from tidemark.operators.bronze import dedup_latest
from tidemark.operators.monitor import firing
from tidemark.sources.changes import read_changes, type_landing
from tidemark.sources.envelopes import EXTRA, land_domain, read_landing
from tidemark.sources.sinks import not_older
from tidemark.sources.tables import StoredTable
from tidemark.spec import DOMAINS
from tidemark.streaming.landing import read_topic_rate, run_dedup, run_landing, run_topic_rate

DDL = "id int, v string, source_ts_ms long, kafka_offset long"


def rows_of(spark, ids, version=1, value="a"):
    return spark.createDataFrame([(i, value, version, i) for i in ids], DDL)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_a_returned_column_is_null_for_old_rows(spark, work, kind):
    table = StoredTable(spark, work, "id")
    table.merge(rows_of(spark, range(100)).withColumn("x", F.lit(7)))
    table.merge(rows_of(spark, [1], 2))  # x leaves
    table.merge(rows_of(spark, [2], 3).withColumn("x", F.lit(9).cast(kind)))  # and returns
    got = {r["id"]: r["x"] for r in table.read().collect()}
    assert len(got) == 100 and {k for k, v in got.items() if v is not None} == {2}
    assert str(got[2]) == "9" and dict(table.read().dtypes)["x"] == kind
    table.merge(rows_of(spark, [3], 4).withColumn("x", F.lit(5).cast(kind)))
    assert {r["id"] for r in table.read().filter("x IS NOT NULL").collect()} == {2, 3}


def test_insert_missing_keeps_stored_rows(spark, work):
    table = StoredTable(spark, work, "id")
    table.merge(rows_of(spark, range(200)))
    table.insert_missing(rows_of(spark, [5, 1000, 1000], 9, "new"))
    got = {r["id"]: r["v"] for r in table.read().collect()}
    assert len(got) == 201 and got[5] == "a" and got[1000] == "new" and table.read().count() == 201


def test_a_merge_is_one_shuffle(spark, work):
    """Stored and incoming rows meet once; each task keeps its best row per key before."""
    table = StoredTable(spark, work, "id")
    table.merge(rows_of(spark, range(50)))
    both = table.read().withColumn("_incoming", F.lit(0)).unionByName(rows_of(spark, [1], 2).withColumn("_incoming", F.lit(1)))
    text = dedup_latest(both, "id", ["source_ts_ms", "kafka_offset", "_incoming"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in text.split("Exchange")[1]


def test_typed_landing_takes_each_message_once(spark, work):
    """Copies in one batch and in a later one; messages without offset all stay."""
    spec = DOMAINS["search_events"]
    ddl = "topic string, value string, kafka_offset long, kafka_partition int, kafka_created_at long"
    value = '{"before": null, "after": {"search_id": "s"}, "op": "c", "source": {"ts_ms": 5}}'

    def arrive(places):
        rows = [(spec.topic, value, offset, partition, 1) for offset, partition in places]
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{work}/feed")
        stream = read_changes(spark, f"{work}/feed", ddl, streaming=True)
        run_landing(stream, [spec], f"{work}/landing", f"{work}/cp", once=True).awaitTermination()
        landed = read_landing(spark, f"{work}/landing", spec).select("RECORD_METADATA.*")
        return sorted((r["offset"] or 0, r["partition"]) for r in landed.collect())

    assert arrive([(3, 0), (3, 0), (3, 1), (7, 0)]) == [(3, 0), (3, 1), (7, 0)]
    assert arrive([(3, 0), (7, 0), (5, 1)]) == [(3, 0), (3, 1), (5, 1), (7, 0)]
    assert arrive([(None, 0), (None, 0)])[:2] == [(0, 0), (0, 0)]


def test_dedup_lands_rows_without_offset(spark, work):
    ddl = "topic string, kafka_partition int, kafka_offset long"
    spark.createDataFrame([("t", 0, None), ("t", 0, None)], ddl).coalesce(1).write.parquet(f"{work}/feed")
    stream = read_changes(spark, f"{work}/feed", ddl, streaming=True)
    run_dedup(stream, f"{work}/out", f"{work}/cp").awaitTermination()
    assert spark.read.parquet(f"{work}/out").count() == 2


def test_a_first_delivery_is_landed_however_late(spark, work):
    ddl = "topic string, kafka_partition int, kafka_offset long, arrived_at string"
    arrivals = [(1, "10:00"), (2, "11:00"), (3, "12:00"), (4, "06:00"), (1, "13:00"), (4, "13:00")]
    for offset, at in arrivals:
        spark.createDataFrame([("t", 0, offset, at)], ddl).write.mode("append").parquet(f"{work}/feed")
        stream = read_changes(spark, f"{work}/feed", ddl, streaming=True, files_per_trigger=1)
        run_dedup(stream, f"{work}/out", f"{work}/cp").awaitTermination()
    # a lost checkpoint delivers everything once more
    stream = read_changes(spark, f"{work}/feed", ddl, streaming=True)
    run_dedup(stream.filter("kafka_offset < 4"), f"{work}/again", f"{work}/cp2").awaitTermination()
    got = spark.read.parquet(f"{work}/out").collect()
    assert sorted((r["kafka_offset"], r["arrived_at"]) for r in got) == [
        (1, "10:00"), (2, "11:00"), (3, "12:00"), (4, "06:00")]
    assert spark.read.parquet(f"{work}/again").count() == 3


def test_rates_add_late_rows_and_show_open_windows(spark, work):
    ddl = "topic string, ts timestamp, bytes long"
    for at in ("2024-01-01 10:00:10", "2024-01-01 12:00:00", "2024-01-01 10:00:50"):
        row = spark.createDataFrame([("t", at, 5)], "topic string, ts string, bytes long")
        row.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(f"{work}/feed")
        stream = read_changes(spark, f"{work}/feed", ddl, streaming=True)
        run_topic_rate(stream, f"{work}/out", f"{work}/cp").awaitTermination()
    got = read_topic_rate(spark, f"{work}/out").orderBy("window_start").collect()
    assert [(r["messages"], r["bytes"]) for r in got] == [(2, 10), (1, 5)]


def test_landing_keeps_unknown_fields(spark):
    spec = DOMAINS["search_events"]
    df = spark.createDataFrame([("s1", 7, "x", 5)], "search_id string, user_id int, query_text string, tier int")
    row = type_landing(df, spec.landing_schema).collect()[0]
    assert (row["SEARCH_ID"], row["USER_ID"], row[EXTRA]) == ("s1", 7, '{"tier":5}')
    again = type_landing(type_landing(df, spec.landing_schema), spec.landing_schema).collect()[0]
    assert again[EXTRA] == '{"tier":5}'


def test_envelopes_land_typed(spark):
    spec = DOMAINS["search_events"]
    values = [
        '{"after": {"search_id": "a", "user_id": 3, "tier": "x"}, "op": "c", "source": {"ts_ms": 5}}',
        '{"before": {"search_id": "a"}, "after": null, "op": "d", "source": {"ts_ms": 6}}',
        None,
        "not json",
    ]
    feed = spark.createDataFrame(
        [(spec.topic, v, i, 0, 9) for i, v in enumerate(values)] + [("else", values[0], 9, 0, 9)],
        "topic string, value string, kafka_offset long, kafka_partition int, kafka_created_at long",
    )
    got = [(r["SEARCH_ID"], r["USER_ID"], r["__OP"], r[EXTRA]) for r in land_domain(feed, spec).collect()]
    assert got == [("a", 3, "c", '{"tier":"x"}'), ("a", None, "d", None), (None,) * 4]


CONTRACTS = "table_name string, table_type string, cdc_strategy string, unique_key string, active boolean"


def test_two_active_contracts_are_an_error(spark):
    rows = [("orders", "fact", "log", "k", True), ("orders", "fact", "append", "k", False)]
    assert contract_for("silver_orders", spark.createDataFrame(rows, CONTRACTS)).cdc_strategy == "log"
    rows.append(("orders", "entity", "append", "k", True))
    with pytest.raises(ValueError, match="several active contracts for orders"):
        contracts_of(["silver_drivers", "silver_orders"], spark.createDataFrame(rows, CONTRACTS))


def test_firing_needs_an_unbroken_breach(spark):
    samples = [("a", 0, True), ("a", 60, True), ("a", 120, True), ("b", 0, True), ("b", 60, False),
               ("b", 120, True), ("c", 100, True), ("d", 0, True), ("d", 500, False)]
    df = spark.createDataFrame(samples, "topic string, s long, breach boolean").withColumn(
        "sampled_at", F.timestamp_seconds("s").cast("timestamp_ntz")
    )
    now = F.timestamp_seconds(F.lit(130)).cast("timestamp_ntz")
    assert {r["topic"]: r["samples"] for r in firing(df, now, 120).collect()} == {"a": 3, "d": 1}


def test_not_older(spark):
    cases = [((1, 1), (1, 1), True), ((2, 0), (1, 9), True), ((1, 9), (2, 0), False),
             ((None, 1), (1, 1), False), ((1, 1), (None, 5), True), ((None, None), (None, None), True)]
    df = spark.createDataFrame([(s, t) for s, t, _ in cases], "source struct<a:int,b:int>, target struct<a:int,b:int>")
    assert [r[0] for r in df.select(not_older(["a", "b"])).collect()] == [w for _, _, w in cases]


