"""Version resolution on hand-written change histories."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.bronze import above_watermark, bronze, dedup_latest
from tidemark.operators.contracts import contract_for
from tidemark.operators.resolve import resolve_cdc, resolve_latest_agg
from tidemark.spec import DOMAINS

DDL = "id string, v int, op string, source_ts_ms long, kafka_offset long, kafka_partition int"

HISTORY = [
    # insert, update, update
    ("a", 1, "c", 10, 1, 0), ("a", 2, "u", 20, 2, 0), ("a", 3, "u", 30, 3, 0),
    # two updates in one millisecond: the higher offset wins
    ("b", 1, "u", 10, 4, 1), ("b", 2, "u", 10, 5, 1),
    # update then delete
    ("c", 1, "u", 10, 6, 0), ("c", None, "d", 20, 7, 0),
    # delete, then an older update arriving late
    ("d", None, "d", 20, 8, 0), ("d", 9, "u", 15, 9, 0),
    # delete, then a newer insert
    ("e", None, "d", 20, 10, 0), ("e", 7, "c", 30, 11, 0),
    # no operation is not a delete
    ("f", 5, None, 10, 12, 0),
    # tombstones
    (None, None, None, None, 13, 0), (None, None, None, None, 14, 0),
    # the same message twice
    ("g", 4, "c", 10, 15, 0), ("g", 4, "c", 10, 15, 0),
]
STATE = {"a": 3, "b": 2, "e": 7, "f": 5, "g": 4}


def state(df):
    rows = df.collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: r["v"] for r in rows}


@pytest.mark.parametrize("resolve", [lambda d: resolve_cdc(d, "upsert", "id"),
                                     lambda d: resolve_latest_agg(d, "id")])
def test_upsert(spark, resolve):
    assert state(resolve(spark.createDataFrame(HISTORY, DDL))) == STATE


def test_append_keeps_versions_and_drops_deletes(spark):
    rows = resolve_cdc(spark.createDataFrame(HISTORY, DDL), "append", "id").collect()
    assert len(rows) == sum(1 for r in HISTORY if r[0] and r[2] != "d")
    assert any(r["op"] is None for r in rows)


def test_log_keeps_all_but_tombstones(spark):
    rows = resolve_cdc(spark.createDataFrame(HISTORY, DDL), "log", "id").collect()
    assert len(rows) == sum(1 for r in HISTORY if r[0])


def test_unknown_strategy_fails_before_running(spark):
    with pytest.raises(ValueError, match="unknown cdc strategy"):
        resolve_cdc(spark.createDataFrame(HISTORY, DDL), "merge", "id")


change = st.tuples(
    st.sampled_from(["a", "b", "c", None]),
    st.integers(0, 9),
    st.sampled_from(["c", "u", "d", "r", None]),
    st.integers(0, 4),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(changes=st.lists(change, min_size=1, max_size=25), seed=st.integers(0, 99))
def test_resolution_ignores_order_and_redelivery(spark, changes, seed):
    rows = [(k, v, op, ts, i, 0) for i, (k, v, op, ts) in enumerate(changes)]
    newest = {}
    for row in rows:
        if row[0] is not None and (row[0] not in newest or row[3:5] > newest[row[0]][3:5]):
            newest[row[0]] = row
    expected = {k: r[1] for k, r in newest.items() if r[2] != "d"}
    again = rows + random.Random(seed).choices(rows, k=5)
    random.Random(seed).shuffle(again)
    df = spark.createDataFrame(again, DDL).repartition(3)
    assert state(resolve_cdc(df, "upsert", "id")) == expected
    assert state(resolve_latest_agg(df, "id")) == expected


def test_hot_key(spark):
    """One key with almost all rows, spread over many input tasks."""
    df = spark.range(0, 50_000, 1, 16).selectExpr(
        "CASE WHEN id % 100 < 99 THEN 'hot' ELSE concat('k', id) END AS id",
        "CAST(id AS INT) AS v", "'u' AS op", "id % 1000 AS source_ts_ms",
        "id AS kafka_offset", "0 AS kafka_partition",
    )
    got = state(resolve_cdc(df, "upsert", "id"))
    # newest stamp is 999 (only on k-rows: 999 % 100 = 99), so the best hot row has 998
    assert got["hot"] == 49_998 and len(got) == 501


LANDING = "ORDER_ID string, TOTAL_AMOUNT double, __OP string, __SOURCE_TS_MS long, " \
    "RECORD_METADATA struct<offset:long,partition:int,CreateTime:long>"


def landing(spark, rows):
    from tidemark.sources.changes import type_landing

    return type_landing(spark.createDataFrame(rows, LANDING), DOMAINS["orders"].landing_schema)


def test_bronze_keeps_deletes_and_drops_tombstones(spark):
    rows = [
        ("1", 5.0, "c", 10, (1, 0, 100)), ("1", 6.0, "u", 20, (2, 0, 200)),
        ("2", 5.0, "c", 10, (3, 0, 100)), ("2", None, "d", 20, (4, 0, 300)),
        (None, None, None, None, (5, 0, 300)),
    ]
    got = {r["order_id"]: (r["total_amount"], r["op"]) for r in
           bronze(landing(spark, rows), DOMAINS["orders"]).collect()}
    assert got == {"1": (6.0, "u"), "2": (None, "d")}


def test_watermark_is_strict_and_starts_at_zero(spark):
    rows = [("1", 5.0, "c", 10, (1, 0, 100)), ("2", 6.0, "c", 20, (2, 0, 101))]
    all_rows = bronze(landing(spark, rows), DOMAINS["orders"])
    assert above_watermark(all_rows, all_rows.filter("false")).count() == 2
    assert [r["order_id"] for r in
            above_watermark(all_rows, all_rows.filter("order_id = '1'")).collect()] == ["2"]


def test_dedup_breaks_ties_by_partition(spark):
    rows = [("x", 1, "u", 5, 5, 0), ("x", 2, "u", 5, 5, 1)]
    assert dedup_latest(spark.createDataFrame(rows, DDL), "id").collect()[0]["v"] == 2


def test_contract_lookup(spark, caplog):
    contracts = spark.createDataFrame(
        [("orders", "fact", "log", "k", True), ("drivers", "fact", "log", "k", False)],
        "table_name string, table_type string, cdc_strategy string, unique_key string, active boolean",
    )
    assert contract_for("silver_orders", contracts).cdc_strategy == "log"
    assert contract_for("silver_drivers", contracts).unique_key == "uuid"
    with caplog.at_level("WARNING"):
        assert contract_for("silver_unheard", contracts).unique_key == "id"
    assert "unheard" in caplog.text
