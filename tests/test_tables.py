"""Stored merges and column expressions over small tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    average,
    bucket_start,
    cents,
    declared_field,
    digits_modulo,
    epoch_ms,
    epoch_text_to_ms,
    ms_to_ntz,
    ratio,
    seconds_between,
)
from tidemark.operators.merge import merge_insert_missing, merge_upsert, sync_columns, update_where
from tidemark.sources.tables import StoredTable

DDL = "id int, v string, source_ts_ms long, kafka_offset long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def content(df):
    return {r["id"]: r["v"] for r in df.collect()}


def test_lifecycle(spark, work):
    table = StoredTable(spark, work, "id")
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.remove(spark.createDataFrame([(1,)], "id int"))
    assert not table.exists()
    table.merge(frame(spark, *[(i, "a", 1, i) for i in range(50)], (0, "older", 0, 0)))
    # newer and older versions, and a new key
    batch = frame(spark, (1, "b", 2, 99), (2, "old", 0, 98), (77, "n", 1, 97))
    table.merge(batch)
    expected = {i: "a" for i in range(50)} | {1: "b", 77: "n"}
    assert content(table.read()) == expected
    version = table.version()
    # applying a batch again changes nothing
    table.merge(batch)
    assert table.version() == version + 1 and content(table.read()) == expected
    table.remove(spark.createDataFrame([(i,) for i in range(50)], "id int"))
    assert content(table.read()) == {77: "n"}
    table.remove(spark.createDataFrame([(77,)], "id int"))
    assert table.exists() and content(table.read()) == {}
    table.insert_missing(frame(spark, (5, "x", 1, 1), (6, "x", 1, 1)))
    table.insert_missing(frame(spark, (6, "y", 9, 9), (7, "y", 9, 9)))
    assert content(table.read()) == {5: "x", 6: "x", 7: "y"}
    table.merge(frame(spark, (5, "older", 0, 0)), order=())
    assert content(table.read()) == {5: "older", 6: "x", 7: "y"}
    table.overwrite(frame(spark, (8, "z", 1, 1)))
    assert content(table.read()) == {8: "z"}
    table.overwrite(table.read().filter("id < 0"))
    assert content(table.read()) == {} and table.read().columns == ["id", "v", "source_ts_ms", "kafka_offset"]


def test_incomplete_directories_are_invisible(spark, work):
    table = StoredTable(spark, work, "id")
    table.overwrite(frame(spark, (1, "a", 1, 1)))
    # a writer that died before its end leaves files of the next version behind
    frame(spark, (1, "lost", 9, 9)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{work}/v00000002")
    assert content(table.read()) == {1: "a"}
    table.merge(frame(spark, (2, "b", 1, 1)))
    assert content(table.read()) == {1: "a", 2: "b"} and table.version() == 2


def test_reader_keeps_its_version(spark, work):
    table = StoredTable(spark, work, "id")
    table.overwrite(frame(spark, (1, "a", 1, 1)))
    before = table.read()
    table.overwrite(frame(spark, (1, "b", 2, 2)))
    assert content(before) == {1: "a"} and content(table.read()) == {1: "b"}


def test_columns_follow_the_batch(spark, work):
    table = StoredTable(spark, work, "id")
    table.merge(frame(spark, *[(i, "a", 1, i) for i in range(20)]))
    wider = spark.createDataFrame(
        [(3, "new", 2, 50)], "id int, extra string, source_ts_ms long, kafka_offset long"
    )
    table.merge(wider)
    read = table.read()
    assert read.columns == wider.columns and read.count() == 20
    assert [r["id"] for r in read.filter("extra = 'new'").collect()] == [3]
    with pytest.raises(ValueError, match="changes type"):
        table.merge(wider.withColumn("extra", F.lit(1)))


def test_merge_expression(spark):
    target = frame(spark, (1, "a", 5, 5), (2, "a", 5, 5))
    updates = frame(spark, (1, "older", 4, 9), (2, "newer", 6, 6), (2, "newest", 6, 7), (3, "n", 1, 1))
    merged = merge_upsert(target, updates, "id")
    assert content(merged) == {1: "a", 2: "newest", 3: "n"}
    assert content(merge_upsert(merged, updates, "id")) == content(merged)


def test_insert_missing_and_update(spark):
    target = frame(spark, (1, "a", 5, 5))
    seeded = merge_insert_missing(target, frame(spark, (1, "b", 1, 1), (2, "b", 1, 1)), "id")
    assert content(seeded) == {1: "a", 2: "b"}
    changed = update_where(seeded, F.col("id") == 2, {"v": F.lit("off"), "kafka_offset": F.lit(0)})
    assert content(changed) == {1: "a", 2: "off"} and changed.schema == seeded.schema
    null_predicate = update_where(seeded, F.lit(None).cast("boolean"), {"v": F.lit("x")})
    assert content(null_predicate) == {1: "a", 2: "b"}


def test_sync_columns(spark):
    target = frame(spark, (1, "a", 5, 5))
    incoming = spark.createDataFrame([(1, 2.0)], "id int, w double")
    assert sync_columns(target, incoming).collect()[0].asDict() == {"id": 1, "w": None}


def one(spark, expression, **columns):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
    return df.select(expression.alias("x")).collect()[0]["x"]


def test_epoch_text(spark):
    for text in ("1.7596876e12", "1759687600000", "1759687600000.0"):
        assert one(spark, epoch_text_to_ms("t"), t=text) == 1759687600000
    assert one(spark, epoch_text_to_ms("t"), t="soon") is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on that day
        ts = F.lit("2024-03-10 02:30:59.9").cast("timestamp_ntz")
        late = F.lit("2024-03-10 02:31:00.1").cast("timestamp_ntz")
        assert one(spark, epoch_ms(ts)) == 1710037859900
        assert one(spark, ms_to_ntz(epoch_ms(ts)).cast("string")) == "2024-03-10 02:30:59.9"
        assert one(spark, bucket_start(ts, 900).cast("string")) == "2024-03-10 02:30:00"
        assert one(spark, seconds_between(ts, late)) == 1
        before = F.lit("1969-12-31 23:59:59.5").cast("timestamp_ntz")
        assert one(spark, ms_to_ntz(epoch_ms(before)).cast("string")) == "1969-12-31 23:59:59.5"
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_exact_ratios(spark):
    assert one(spark, ratio("a", "b", 100), a=1, b=3) == 33.33
    assert one(spark, ratio("a", "b", 100), a=1, b=800) == 0.13
    assert one(spark, ratio("a", "b"), a=-1, b=8) == -0.13
    assert one(spark, ratio("a", "b"), a=1, b=0) is None
    assert one(spark, average("a", "b"), a=5, b=2) == 0.03
    assert one(spark, cents("a"), a=1.005) in (100, 101)
    assert one(spark, cents("a"), a=19.99) == 1999


def test_declared_fields(spark):
    doc = " table_type = fact ,cdc_strategy=log,owner=x,unique_key=a=b,cdc_strategy=upsert"
    assert one(spark, declared_field("d", "table_type"), d=doc) == "fact"
    assert one(spark, declared_field("d", "cdc_strategy"), d=doc) == "upsert"
    assert one(spark, declared_field("d", "unique_key"), d=doc) == "a=b"
    assert one(spark, declared_field("d", "topic"), d=doc) is None
    assert one(spark, declared_field("d", "table_type"), d="") is None


def test_digits_modulo(spark):
    def by_hand(key):
        return str(int("".join(c for c in key if c.isdigit()) or "0") % 354 + 1) if key else None

    for key in ("zk8801425", "x", "", "9" * 40, "a1b2" * 20, "353"):
        assert one(spark, digits_modulo("k"), k=key) == by_hand(key)
