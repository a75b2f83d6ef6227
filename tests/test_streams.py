"""Live feeds: gates, routing, resolution, redelivery."""

import random

from pyspark.sql import functions as F

from tidemark.operators.monitor import consume_pending, pending_domains
from tidemark.operators.resolve import resolve_cdc
from tidemark.sources.changes import (
    dedup_redelivery,
    land,
    read_changes,
    topic_tables,
    unwrap_envelope,
)
from tidemark.sources.tables import StoredTable
from tidemark.spec import DOMAINS
from tidemark.streaming.gate import run_gate, run_routing
from tidemark.streaming.live import current_state, run_resolve

DDL = "id string, v int, op string, source_ts_ms long, kafka_offset long, kafka_partition int"


def write(spark, rows, path):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)


def test_gate_notices_each_row_once(spark, work):
    ddl = "domain string, n int"
    feed = f"{work}/feed"

    def arrive(rows):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(feed)

    def run():
        stream = read_changes(spark, feed, ddl, streaming=True)
        run_gate(stream, "domain", f"{work}/gate", f"{work}/checkpoint").awaitTermination()
        return spark.read.parquet(f"{work}/gate/pending_runs")

    arrive([("fast", 1), ("fast", 2)])
    assert {r["domain"] for r in run().collect()} == {"fast"}
    # no traffic: nothing is added
    assert run().count() == 1
    arrive([("fast", 3), ("slow", 1)])
    pending = run()
    assert {r["domain"]: r["signals"] for r in pending_domains(pending).collect()} == {
        "fast": 2, "slow": 1}
    log = spark.read.parquet(f"{work}/gate/stream_consumption_log")
    assert {r["domain"]: r["n"] for r in log.groupBy("domain").agg(F.sum("rows_seen").alias("n")).collect()
            } == {"fast": 3, "slow": 1}
    # rows read earlier are consumed, the ones that came in between stay
    read = pending.filter("domain = 'fast'")
    left = pending_domains(consume_pending(pending, read)).collect()
    assert [r["domain"] for r in left] == ["slow"]


def test_stream_equals_batch(spark, work):
    rng = random.Random(3)
    changes = [(f"k{rng.randrange(9)}", i, rng.choice("cudr"), rng.randrange(8), i, 0)
               for i in range(120)]
    rng.shuffle(changes)
    for stateful in (False, True):
        feed, place = f"{work}/feed{stateful}", f"{work}/table{stateful}"
        table = StoredTable(spark, place, "id")
        for part in range(3):
            # late and repeated messages included
            write(spark, changes[part * 40:part * 40 + 45], feed)
            stream = read_changes(spark, feed, DDL, streaming=True)
            run_resolve(stream, table, f"{work}/cp{stateful}", stateful=stateful).awaitTermination()
        batch = resolve_cdc(spark.read.parquet(feed), "upsert", "id")
        assert {tuple(r) for r in current_state(table).collect()} == {tuple(r) for r in batch.collect()}


def test_replayed_batch_changes_nothing(spark, work):
    feed = f"{work}/feed"
    write(spark, [("a", 1, "c", 1, 1, 0), ("b", 1, "c", 1, 2, 0), ("b", None, "d", 2, 3, 0)], feed)
    table = StoredTable(spark, f"{work}/table", "id")
    for attempt in range(2):  # a lost checkpoint replays everything
        stream = read_changes(spark, feed, DDL, streaming=True)
        run_resolve(stream, table, f"{work}/cp{attempt}").awaitTermination()
    assert [r["id"] for r in current_state(table).collect()] == ["a"]
    assert table.read().count() == 2  # the delete marker stays


def test_routing(spark, work):
    ddl = "topic string, n int"
    spark.createDataFrame(
        [("pg.public.orders", 1), ("pg.public.drivers", 2), ("pg.public.orders", 3), ("other", 4)], ddl
    ).write.parquet(f"{work}/feed")
    stream = read_changes(spark, f"{work}/feed", ddl, streaming=True)
    run_routing(stream, topic_tables(), f"{work}/landing", f"{work}/cp").awaitTermination()
    landed = spark.read.parquet(f"{work}/landing")
    assert {(r["table_name"], r["n"]) for r in landed.collect()} == {
        ("ORDERS", 1), ("DRIVERS", 2), ("ORDERS", 3)}


def test_redelivery_on_a_stream(spark, work):
    ddl = "topic string, kafka_partition int, kafka_offset long, arrived_at timestamp"
    rows = spark.range(20).selectExpr(
        "'t' AS topic", "CAST(id % 2 AS INT) AS kafka_partition", "id AS kafka_offset",
        "timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) AS arrived_at")
    rows.coalesce(1).write.mode("append").parquet(f"{work}/feed")
    rows.coalesce(1).write.mode("append").parquet(f"{work}/feed")
    stream = read_changes(spark, f"{work}/feed", ddl, streaming=True, files_per_trigger=1)
    (dedup_redelivery(stream).writeStream.format("parquet").option("path", f"{work}/out")
     .option("checkpointLocation", f"{work}/cp").trigger(availableNow=True).start().awaitTermination())
    assert spark.read.parquet(f"{work}/out").count() == 20


def test_envelopes(spark):
    ddl = ("before struct<id:int,v:int>, after struct<id:int,v:int>, op string, "
           "source struct<ts_ms:long>")
    df = spark.createDataFrame(
        [(None, (1, 5), "c", (10,)), ((1, 5), (1, 6), "u", (20,)), ((1, 6), None, "d", (30,)),
         (None, None, None, None)], ddl)
    assert [tuple(r) for r in unwrap_envelope(df, "id").collect()] == [
        (1, 5, "c", 10), (1, 6, "u", 20), (1, None, "d", 30), (None, None, None, None)]


def test_landing_is_typed_and_append_only(spark, work):
    spec = DOMAINS["search_events"]
    df = spark.createDataFrame([("s1", "7", "x", 5)], "search_id string, user_id string, "
                               "query_text string, ignored int")
    for _ in range(2):
        land(df, f"{work}/landing", spec)
    landed = spark.read.schema(spec.landing_schema).parquet(f"{work}/landing")
    assert landed.count() == 2
    row = landed.collect()[0]
    assert (row["SEARCH_ID"], row["USER_ID"], row["RESULT_COUNT"]) == ("s1", 7, None)
    assert landed.columns[-3:] == ["__OP", "__SOURCE_TS_MS", "RECORD_METADATA"]
