"""``payments_by_status`` by differences: batches in any order, taken back, and repeated."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.resolve import resolve_cdc
from tidemark.plans.differential import PaymentsByStatus, apply_all
from tidemark.plans.gold import payments_by_status

DDL = (
    "event_id string, op string, source_ts_ms long, kafka_offset long, kafka_partition int, "
    "event_name string, payment_id string, event_timestamp timestamp_ntz"
)


def at(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def row(key, version, name="created", payment="p", hour=0, op="c"):
    return (key, op, version, version, 0, name, payment, None if hour is None else at(hour))


BATCHES = [
    [row("a", 1), row("b", 1, "closed", hour=90), row("c", 5, "closed", "q", hour=50)],
    # the first and the last instant go, a payment changes, a late old version is no news
    [row("b", 2, "closed", hour=90, op="d"), row("a", 2, "created", "r", hour=30), row("c", 4, "created", "z")],
    # a stage empties, one comes back, rows without payment, stage or instant
    [row("c", 6, "refunded", "q", hour=10), row("b", 3, None, "p", hour=20), row("d", 1, "closed", None),
     row("e", 1, "closed", "p", None), row("f", 1, "created", "r", hour=30), (None, *row("x", 1)[1:])],
    [],
    [row("a", 3, op="d"), row("f", 2, op="d"), row("e", 2, op="d")],
]


def rows(df):
    return sorted(map(repr, df.collect()))


def frames(spark, batches):
    return [spark.createDataFrame(b, DDL) for b in batches]


@pytest.mark.parametrize("n", [2, 3, len(BATCHES)])
def test_every_state_is_the_full_report(spark, work, n):
    target = apply_all(PaymentsByStatus(spark, work, buckets=2), frames(spark, BATCHES[:n]))
    whole = spark.createDataFrame([r for b in BATCHES[:n] for r in b], DDL)
    want = payments_by_status(resolve_cdc(whole.filter("event_id IS NOT NULL"), "upsert", "event_id"))
    assert rows(target.report()) == rows(want)


def test_repeating_and_reordering_change_nothing(spark, work):
    target = apply_all(PaymentsByStatus(spark, work, buckets=2), frames(spark, BATCHES[:3]))
    before = rows(target.report())
    target.apply(spark.createDataFrame(BATCHES[2], DDL), 2)  # written again
    assert rows(target.report()) == before
    target.apply(spark.createDataFrame(BATCHES[0] + BATCHES[1], DDL), 3)  # delivered again
    assert rows(target.report()) == before
    other = PaymentsByStatus(spark, f"{work}-b", buckets=4)
    assert rows(apply_all(other, frames(spark, [BATCHES[2], BATCHES[0], BATCHES[1]])).report()) == before


def test_a_batch_reads_its_own_keys_only(spark, work):
    """Old rows come from the buckets of the batch's keys, and nothing of the report is re-read."""
    target = PaymentsByStatus(spark, work, buckets=16)
    many = [row(f"k{i}", 1, payment=f"p{i}", hour=i % 50) for i in range(500)]
    target.apply(spark.createDataFrame(many, DDL), 0)
    one = spark.createDataFrame([row("k7", 2, "closed", "p7", 3)], DDL)
    touched = one.select("event_id", target._bucket("event_id"))
    past = target._touched(target._read("changes", 1), touched, "event_id")
    scan = past._jdf.queryExecution().executedPlan().toString()
    number = touched.first()["bucket"]
    assert f"bucket#" in scan.split("PartitionFilters")[1][:200] and past.count() == 1
    files = {f.split("bucket=")[1].split("/")[0] for f in target._read("changes").filter(F.col("bucket") == number).inputFiles()}
    assert len(files) >= 1
    target.apply(one, 1)
    got = {r["event_name"]: (r["eventos"], r["pagamentos"]) for r in target.report().collect()}
    assert got == {"created": (499, 499), "closed": (1, 1)}
    assert spark.read.parquet(f"{work}/totals/batch=1").count() == 2
