"""Landing: every message is landed, a tombstone, or a reject with its reason and its text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sources.changes import read_changes
from tidemark.sources.envelopes import (
    EXTRA,
    land_domain,
    read_landing,
    read_rejects,
    rejected,
    type_messages,
)
from tidemark.spec import DOMAINS
from tidemark.streaming.landing import run_landing

FEED = "topic string, value string, kafka_offset long, kafka_partition int, kafka_created_at long"
MSSQL, SEARCH, ORDERS = (DOMAINS[d] for d in ("users_mssql", "search_events", "orders"))


def feed(spark, values, spec=SEARCH):
    return spark.createDataFrame([(spec.topic, v, i, 0, 9) for i, v in enumerate(values)], FEED)


def event(fields, op='"c"', ts="5"):
    return f'{{"before":null,"after":{{"search_id":"a"{fields}}},"op":{op},"source":{{"ts_ms":{ts}}}}}'


CASES = [
    (event(""), []),
    ("{", ["broken_json"]),
    ("", ["broken_json"]),
    (event(',"user_id":1,"user_id":2'), ["broken_json"]),
    ("7", ["not_an_object"]),
    ('{"op":"c"}', ["no_image"]),
    ('{"after":null,"before":null,"op":"d"}', ["no_image"]),
    ('{"after":5,"op":"c"}', ["not_an_object:after"]),
    ('{"after":{"search_id":"a"},"before":[],"op":"c"}', ["not_an_object:before"]),
    ('{"after":{"search_id":null},"op":"c"}', ["no_key"]),
    (event(',"user_id":"12"'), []),
    (event(',"user_id":1e2'), []),
    (event(',"user_id":2147483648'), ["wrong_type:user_id"]),
    (event(',"user_id":1.5'), ["wrong_type:user_id"]),
    (event(',"user_id":true,"result_count":{}'), ["wrong_type:user_id", "wrong_type:result_count"]),
    (event(',"query_text":5,"filters":{"b":1,"a":[2]}'), []),
    (event(',"timestamp":"2024-01-01T10:00:00Z"'), []),
    (event(',"timestamp":"2024-01-01T10:00:00.123456000+02:00"'), []),
    (event(',"timestamp":"2024-01-01T10:00:00.123456789Z"'), ["wrong_type:timestamp"]),
    (event(',"timestamp":"2024-01-01T10:00:00"'), ["wrong_type:timestamp"]),
    (event(',"timestamp":"2024-13-01T10:00:00Z"'), ["wrong_type:timestamp"]),
    (event(',"timestamp":1704103200000'), ["wrong_type:timestamp"]),
    (event("", ts='"x"'), ["wrong_type:source.ts_ms"]),
    (event("", ts="9007199254740993"), []),
]


def test_reasons(spark):
    typed = type_messages(feed(spark, [v for v, _ in CASES]), [SEARCH]).orderBy("kafka_offset").collect()
    for row, (value, reasons) in zip(typed, CASES):
        assert row["reasons"] == reasons, value
        assert row["outcome"] == ("rejected" if reasons else "landed")
        assert (row["search_events"] is None) == bool(reasons) and row["value"] == value


def test_values_are_exact(spark):
    values = [
        event(',"user_id":"12","query_text":5,"filters":{"b":1,"a":[2]},"tier":1.5'),
        event(',"timestamp":"2024-01-01T10:00:00Z"', ts="9007199254740993"),
        event(',"timestamp":"2024-01-01T10:00:00.123456000+02:00"', op="null"),
    ]
    rows = land_domain(feed(spark, values), SEARCH).withColumn(
        "micros", F.unix_micros("TIMESTAMP")).orderBy("RECORD_METADATA.offset").collect()
    first = rows[0]
    assert (first["USER_ID"], first["QUERY_TEXT"], first["FILTERS"], first[EXTRA]) == (
        12, "5", '{"a":[2],"b":1}', '{"tier":1.5}')
    at = dt.datetime(2024, 1, 1, 10, tzinfo=dt.timezone.utc)
    assert [r["micros"] for r in rows[1:]] == [
        int(at.timestamp()) * 10**6, int(at.timestamp() - 7200) * 10**6 + 123456]
    assert rows[1]["__SOURCE_TS_MS"] == 9007199254740993 and rows[2]["__OP"] is None


def test_dates_have_no_time(spark):
    def person(day):
        return f'{{"after":{{"uuid":"u","birthday":{day}}},"op":"c","source":{{"ts_ms":1}}}}'.replace("uuid", MSSQL.key)

    days = ['"1990-05-01"', '"1990-05-01T00:00"', '"1990"', "7000", "null", '"1990-02-30"']
    rows = type_messages(feed(spark, map(person, days), MSSQL), [MSSQL]).orderBy("kafka_offset").collect()
    assert [r["reasons"] for r in rows] == [[], *[["wrong_type:birthday"]] * 3, [], ["wrong_type:birthday"]]
    assert rows[0]["users_mssql"]["BIRTHDAY"] == dt.date(1990, 5, 1)


def test_tombstones_and_unknown_topics(spark):
    rows = feed(spark, [None, "null", event("")]).unionByName(
        spark.createDataFrame([("nobody", None, 9, 0, 1), ("nobody", "{}", 10, 0, 1)], FEED))
    typed = type_messages(rows, [SEARCH, ORDERS])
    counts = {r["outcome"]: r["count"] for r in typed.groupBy("outcome").count().collect()}
    assert counts == {"tombstone": 2, "landed": 1, "rejected": 2}
    gone = rejected(typed).collect()
    assert {(r["topic"], r["value"], tuple(r["reasons"])) for r in gone} == {
        ("nobody", None, ("unknown_topic",)), ("nobody", "{}", ("unknown_topic",))}
    assert land_domain(rows, SEARCH).count() == 3 and land_domain(rows, ORDERS).count() == 0


@pytest.mark.parametrize("once", [False, True])
def test_a_batch_is_read_and_written_once(spark, work, once):
    """Landed rows by domain and rejects, and one write per batch whatever the domains."""
    good = [event(f',"user_id":{i}') for i in range(4)]
    batches = [
        [(SEARCH, good[0]), (ORDERS, '{"after":{"order_id":"o"},"op":"c","source":{"ts_ms":1}}'), (SEARCH, "{")],
        [(SEARCH, good[1]), (SEARCH, None)],
    ]
    offset = 0
    writes = []
    for batch in batches:
        rows = [(s.topic, v, offset + i, 0, 9) for i, (s, v) in enumerate(batch)]
        offset += len(batch)
        rows = [*rows, rows[0]]  # delivered twice
        spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(f"{work}/feed")
        stream = read_changes(spark, f"{work}/feed", FEED, streaming=True)
        run_landing(stream, [SEARCH, ORDERS], f"{work}/out", f"{work}/cp", once=once).awaitTermination()
        writes.append(len(spark.read.parquet(f"{work}/out/batch={len(writes)}").inputFiles()))
    searches = read_landing(spark, f"{work}/out", SEARCH)
    assert sorted((r["USER_ID"] is None, r["USER_ID"] or 0) for r in searches.collect()) == sorted(
        [(False, 0), (False, 1), (True, 0)] + ([] if once else [(False, 0), (False, 1)]))
    assert read_landing(spark, f"{work}/out", ORDERS).count() == 1
    gone = read_rejects(spark, f"{work}/out").collect()
    assert [(r["value"], r["reasons"], r["kafka_offset"]) for r in gone] == [("{", ["broken_json"], 2)]
    text = searches._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "domain#" in text.split("PartitionFilters")[1][:200]


def test_one_scan_and_one_parse_for_all_domains(spark, work):
    spark.createDataFrame([(SEARCH.topic, event(""), 0, 0, 1)], FEED).write.parquet(work)
    typed = type_messages(spark.read.schema(FEED).parquet(work), [SEARCH, ORDERS, MSSQL])
    text = typed._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.lower().count("parse_json") <= 1 + text.count("static_invoke")
    assert "Exchange" not in text and "Python" not in text


def test_only_batches_with_the_same_offsets_are_read_again(spark, work):
    """A partition that lags opens its own past, not the history of the others."""
    from tidemark.streaming.landing import _unseen

    ddl = "topic string, kafka_partition int, kafka_offset long"
    past = [[("t", 0, i) for i in range(100 * b, 100 * b + 100)] for b in range(5)]
    for b, rows in enumerate(past):
        new = _unseen(spark.createDataFrame(rows, ddl), work, b)
        new.write.mode("overwrite").parquet(f"{work}/batch={b}")
    late = _unseen(spark.createDataFrame([("t", 1, 3), ("t", 0, 250), ("t", 0, 900)], ddl), work, 9)
    assert sorted((r[1], r[2]) for r in late.collect()) == [(0, 900), (1, 3)]
    text = late._jdf.queryExecution().executedPlan().toString()
    assert " IN (2,3,4)" in text.split("PartitionFilters")[1][:120]


def test_feeds_of_one_file_are_made_by_many_tasks(spark, sf_dir):
    """JSON is made, parsed and typed on all cores, however few files a table has."""
    from workloads.inputs import table
    from workloads.landing import enriched_feed
    from workloads.layers import envelope_feed

    cores = spark.sparkContext.defaultParallelism
    assert table(spark, sf_dir, "events").rdd.getNumPartitions() < cores
    assert enriched_feed(spark, sf_dir).rdd.getNumPartitions() >= cores
    assert envelope_feed(spark, sf_dir).rdd.getNumPartitions() >= cores
