"""Physical plans: what must hold at any size."""

import pytest
from support import SF, plan, single_task_steps

from tidemark.operators.aggregates import share_of_total
from tidemark.operators.bronze import bronze, dedup_latest
from tidemark.operators.joins import dedup_dimension
from tidemark.operators.resolve import resolve_cdc
from tidemark.plans import gold
from tidemark.spec import DOMAINS
from workloads.inputs import landing, table
from workloads.layers import silver, user_feed
from workloads.registry import QUERIES


def test_single_task_steps_are_seen(spark):
    assert "Window" in set(single_task_steps(plan(QUERIES["payment_funnel"](spark, SF))))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_the_total_reads_the_groups_again_and_not_the_table(spark):
    shared = share_of_total(table(spark, SF, "lineitem"), "l_returnflag")
    assert final_plan(shared).count("FileScan") <= 1 + final_plan(shared).count("ReusedExchange")


def test_deduplication_shrinks_before_the_shuffle(spark):
    text = plan(dedup_latest(user_feed(spark, SF), "user_id"))
    below_exchange = text.split("Exchange")[1]
    assert "WindowGroupLimit" in below_exchange and text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["bronze_order_items", "silver_driver_shifts", "dedup_latest"])
def test_a_feed_dealt_by_key_is_neither_sorted_nor_unrolled_before_its_only_shuffle(spark, name):
    above, below = plan(QUERIES[name](spark, SF)).split("Exchange hashpartitioning")
    assert "Generate explode" in above and "WindowGroupLimit" in above and "FileScan" not in above
    assert not any(step in below for step in ("Generate", "Sort", "WindowGroupLimit"))


@pytest.mark.parametrize("name", ["order_items", "users_mssql"])
def test_a_feed_dealt_by_key_has_the_same_rows(spark, name):
    plain, keyed = landing(spark, SF, name), landing(spark, SF, name, keyed=True)
    assert keyed.dtypes == plain.dtypes
    assert keyed.exceptAll(plain).count() == 0 and plain.exceptAll(keyed).count() == 0


def test_delete_filter_stays_above_the_ranking(spark):
    feed = spark.read.schema("id string, op string, source_ts_ms long, kafka_offset long, v int")
    text = plan(resolve_cdc(feed.parquet(f"{SF}/events.parquet"), "upsert", "id"))
    above, below = text.split("Window [", 1)
    assert "<=> d" in above and "<=> d" not in below
    assert "PushedFilters: [IsNotNull(id)]" in below


def test_scans_read_only_what_reports_need(spark, work):
    landing(spark, SF, "order_items").write.parquet(work)
    items = bronze(spark.read.parquet(work), DOMAINS["order_items"])
    registry = silver(spark, SF, "restaurants")
    text = plan(gold.revenue_per_restaurant(items, registry))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "SUBTOTAL" in line)
    assert "MODIFIERS" not in scan and "CUISINE_TYPE" not in scan
    assert "IsNotNull(ORDER_ITEM_ID)" in scan


def test_lifecycle_aggregates_before_it_shuffles(spark):
    rows = spark.range(10).selectExpr(
        "CAST(id AS STRING) AS payment_id", "'created' AS event_name", "id AS event_timestamp_ms",
        "timestamp_ntz'2024-01-01 00:00:00' AS event_timestamp")
    text = plan(gold.payment_lifecycle(rows))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("HashAggregate") == 4 and "SortAggregate" not in text


def test_dimension_null_keys_leave_at_the_scan(spark, work):
    spark.createDataFrame([("u", "k", 1, 1)], "uuid string, k string, source_ts_ms long, "
                          "kafka_offset long").write.parquet(work)
    assert "PushedFilters: [IsNotNull(k)]" in plan(dedup_dimension(spark.read.parquet(work), "k"))


@pytest.mark.parametrize("name, most", [("user_behavior", 3), ("bridge_aggregate", 2)])
def test_facts_are_read_for_counts_and_terms_only(spark, name, most):
    """Searches are read for their counts and for their terms; recommendations once."""
    events = final_plan(QUERIES[name](spark, SF)).split("FileScan parquet")
    scans = sum("event_type" in part.split("\n")[0] for part in events[1:])
    assert 0 < scans <= most
