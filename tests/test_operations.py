"""Exports, contracts, checks, monitors and audit rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import contracts as c
from tidemark.operators.audit import layer_row_counts, processing_log
from tidemark.operators.monitor import (
    bucketed_lag,
    consume_pending,
    counter_changes,
    counter_rate,
    freshness_breach,
    offset_lag,
    pending_domains,
    run_request,
    silent_pipeline,
    top_topics,
)
from tidemark.operators.quality import (
    Check,
    check_unique,
    column_suite,
    count_failures,
    enforce,
    quality_summary,
    reconcile,
)
from tidemark.plans.checks import SUITES, size
from tidemark.sources.artifacts import read_run_results
from tidemark.sources.exports import export_summary, load_exports, select_files, upsert_exports
from tidemark.sources.tables import StoredTable


# --------------------------------------------------------------------- exports
@pytest.fixture
def exports(tmp_path):
    def put(name, *records):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        (tmp_path / name).write_text("\n".join(lines) + "\n\n")

    stamp = "2024-01-01T00:00:00Z"
    put("kafka_orders_2.json", {"order_id": "a", "driver_key": "zk8801425", "total_amount": 2.5},
        {"order_id": "b", "driver_key": None})
    put("kafka_orders_1.json", {"order_id": "a", "total_amount": 1.0}, {"total_amount": 9})
    put("kafka_events_1.json",
        {"event_id": "e1", "payment_id": "p", "dt_current_timestamp": stamp,
         "event": {"event_name": "created", "timestamp": 1.7596876e12}},
        {"event_id": "e2", "payment_id": "p"}, "{broken")
    put("mongodb_users_1.JSON", {"uuid": "m1", "user_id": 4, "cpf": "1"})
    put("kafka_shift_9.json", {"shift_id": "s", "num_orders": 3})
    put("mysql_menu_1.json", {"x": 1})
    put("notes.txt", "ignored")
    return str(tmp_path)


def test_export_files(spark, exports):
    def names(batch, domain=None):
        return sorted(r["file"] for r in select_files(spark, exports, batch, domain).collect())

    everything = ["kafka_events_1.json", "kafka_orders_1.json", "kafka_orders_2.json",
                  "kafka_shift_9.json", "mongodb_users_1.JSON"]
    assert names("all") == everything
    assert names("initial") == everything[:4] and names("incremental") == everything[4:]
    assert names("all", "orders") == everything[1:3]
    assert names("initial", "orders") == everything[1:2]
    assert "mysql_menu_1.json" not in names("all")
    with pytest.raises(ValueError):
        select_files(spark, exports, "half")


def test_exports_end_in_an_upsert(spark, exports, work):
    orders = StoredTable(spark, work, "order_id")
    for batch in ("initial", "incremental", "all"):
        upsert_exports(spark, exports, {"orders": orders}, batch)
    got = {r["order_id"]: r["total_amount"] for r in orders.read().collect()}
    assert got == {"a": 2.5, "b": None}


def test_export_rows(spark, exports):
    loaded = load_exports(spark, exports)
    orders = {r["order_id"]: r for r in loaded["orders"].collect()}
    assert orders["a"]["total_amount"] == 2.5  # the later file wins
    assert orders["a"]["driver_key"] == str(8801425 % 354 + 1) and orders["b"]["driver_key"] is None
    events = loaded["payment_events"].collect()
    assert [r["event_id"] for r in events] == ["e1"]
    assert json.loads(events[0]["event"])["event_name"] == "created"
    summary = {r["domain"]: tuple(r)[1:] for r in export_summary(spark, exports).collect()}
    assert summary["orders"] == (2, 3, 1) and summary["payment_events"] == (1, 1, 2)
    assert summary["driver_shifts"] == (1, 1, 0)


# ------------------------------------------------------------------- contracts
CURRENT = ("table_name string, topic string, table_type string, cdc_strategy string, "
           "unique_key string, active boolean, registered_at timestamp, updated_at timestamp, "
           "source string, previous_strategy string, changed_by string, notes string")


def contract(name, strategy="upsert", key="id", previous=None, kind="entity", active=True):
    return (name, f"pg.public.{name}", kind, strategy, key, active, None, None, "manual", previous,
            "bootstrap", None)


def incoming(spark, *rows):
    df = spark.createDataFrame(list(rows), "subject string, doc string")
    return c.parse_doc(c.subjects_to_tables(df))


def test_contract_sync(spark):
    current = spark.createDataFrame(
        [contract("same"), contract("empty", "log"), contract("flip", "log", previous="append"),
         contract("rekey", "upsert", previous="append"), contract("alone", "log")], CURRENT)
    subjects = incoming(
        spark, ("pg.public.same-value", "cdc_strategy=upsert"), ("pg.public.empty-value", ""),
        ("pg.public.flip-value", "cdc_strategy=upsert"), ("pg.public.rekey-value", "unique_key=uuid"),
        ("pg.public.fresh-value", "table_type=fact"), ("pg.public.fresh-key", None))
    now = F.current_timestamp()
    rows = {r["table_name"]: r for r in c.sync_contracts(current, subjects, now).collect()}
    assert set(rows) == {"same", "empty", "flip", "rekey", "alone", "fresh"}
    assert rows["same"]["source"] == "manual" and rows["empty"]["cdc_strategy"] == "log"
    assert (rows["flip"]["cdc_strategy"], rows["flip"]["previous_strategy"]) == ("upsert", "log")
    # an unrelated update does not forget the previous strategy
    assert (rows["rekey"]["unique_key"], rows["rekey"]["previous_strategy"]) == ("uuid", "append")
    fresh = rows["fresh"]
    assert (fresh["table_type"], fresh["cdc_strategy"], fresh["unique_key"]) == ("fact", "upsert", "id")
    assert fresh["topic"] == "pg.public.fresh" and fresh["active"]
    summary = {r["change_type"]: r["n"] for r in c.sync_summary(current, subjects).collect()}
    assert summary == {"insert": 1, "update": 2, "no_change": 2}
    history = {(r["table_name"], r["field_changed"]): (r["old_value"], r["new_value"])
               for r in c.contract_history(current, subjects, now).collect()}
    assert set(history) == {("flip", "cdc_strategy"), ("rekey", "unique_key"), ("fresh", "all")}
    assert history["flip", "cdc_strategy"] == ("log", "upsert")
    assert json.loads(history["fresh", "all"][1])["table_type"] == "fact"
    # a second sync of the same subjects has nothing to do
    again = c.sync_contracts(current, subjects, now)
    assert {r["change_type"] for r in c.sync_summary(again, subjects).collect()} == {"no_change"}


def test_new_subjects_compare_like_with_like(spark):
    subjects = spark.createDataFrame(
        [("pg.public.orders-value", None), ("pg.public.menu-value", None), ("pg.public.menu-key", None)],
        "subject string, doc string")
    known = spark.createDataFrame([contract("orders")], CURRENT)
    assert [r["table_name"] for r in c.new_subjects(subjects, known).collect()] == ["menu"]


def test_drift_is_null_safe(spark):
    expected = spark.createDataFrame([contract("a", key=None), contract("b", key=None), contract("x")], CURRENT)
    actual = spark.createDataFrame(
        [contract("A", "UPSERT", None), contract("b", key="id"), contract("y"), contract("x", active=False)],
        CURRENT)
    got = {r["table_name"]: r["motivo"]
           for r in c.check_contract_drift(expected, actual).collect()}
    assert got == {"b": "differs", "x": "lacking", "y": "unasked"}


# --------------------------------------------------------------------- quality
def test_suites_have_the_published_size():
    assert size() == {"bronze": 83, "silver": 72, "gold": 30}
    assert sum(len(s.scoped) for n, s in SUITES.items() if n.startswith("bronze_")) == 13


def test_severities(spark):
    df = spark.createDataFrame([(1, "c"), (1, "d"), (None, None)], "id int, op string")
    counted = column_suite(df, "t", [("id", None), ("id", "NOT (op <=> 'd')")],
                           [("op", ["c"], "warn")]).unionByName(
        count_failures([Check("unique_t_id", "warn", check_unique(df, "id"))]))
    rows = [tuple(r) for r in quality_summary(counted).collect()]
    assert rows == [("not_null_t_id", "error", 1, "error"), ("not_null_t_id", "error", 1, "error"),
                    ("accepted_values_t_op", "warn", 1, "warn"), ("unique_t_id", "warn", 1, "warn")]
    summary = quality_summary(counted)
    with pytest.raises(AssertionError, match="not_null_t_id"):
        enforce(summary)
    enforce(summary.filter("severity = 'warn'"))
    with pytest.raises(ValueError):
        Check("x", "fatal", df)


def test_reconcile_treats_null_as_a_value(spark):
    silver = spark.createDataFrame([("a", 5), ("b", None), (None, 1)], "payment_id string, event_timestamp_ms long")
    gold = spark.createDataFrame([("a", 1, 5), ("b", 1, 7), ("z", 1, 1)],
                                 "payment_id string, total_eventos long, ultimo_evento_ms long")
    got = {r["payment_id"]: r["motivo"] for r in reconcile(silver, gold).collect()}
    assert got == {"b": "newest", "z": "unfounded"}


# -------------------------------------------------------------------- monitors
def test_slow_domain_is_not_overtaken(spark):
    rows = spark.createDataFrame(
        [(1, "fast", 200, False), (2, "slow", 100, False), (3, "fast", 300, True)],
        "row_id int, domain string, detected_at int, consumed boolean")
    assert {r["domain"] for r in pending_domains(rows).collect()} == {"fast", "slow"}
    assert tuple(run_request(rows).collect()[0]) == ("fast,slow", 200)
    after = consume_pending(rows, rows.filter("row_id = 1"))
    assert {r["domain"] for r in pending_domains(after).collect()} == {"slow"}
    assert run_request(consume_pending(rows, rows)).count() == 0


def test_counter_reset_is_activity(spark):
    ddl = "topic string, value double"
    before = spark.createDataFrame([("same", 5.0), ("reset", 9.0), ("gone", 1.0)], ddl)
    after = spark.createDataFrame([("same", 5.0), ("reset", 2.0), ("fresh", 3.0), ("zero", 0.0)], ddl)
    assert {r["topic"] for r in counter_changes(before, after).collect()} == {"reset", "gone", "fresh"}


def test_rates(spark):
    rows = [("a", "2024-01-01 00:00:00", 10.0), ("a", "2024-01-01 00:00:10", 30.0),
            ("a", "2024-01-03 00:00:00", 50.0), ("a", "2024-01-03 00:00:05", 5.0)]
    samples = spark.createDataFrame(rows, "topic string, t string, value double").selectExpr(
        "topic", "CAST(t AS TIMESTAMP_NTZ) AS sampled_at", "value")
    got = [(r["increase"], r["per_second"]) for r in counter_rate(samples).orderBy("sampled_at").collect()]
    assert got == [(20.0, 2.0), (20.0, 20.0 / 172_790), (5.0, 1.0)]


def test_bucketed_lag_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), t, rng.randrange(100)) for t in rng.sample(range(1000), 120)]
    want = {}
    for key in "ab":
        previous = None
        for _, t, v in sorted(r for r in rows if r[0] == key):
            want[key, t] = previous
            previous = v
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = bucketed_lag(df, "k", "t", ["v"], F.floor(F.col("t") / 50))
    assert {(r["k"], r["t"]): r["prev_v"] for r in got.collect()} == want


def test_lag_freshness_silence_topk(spark):
    ddl = "topic string, kafka_partition int, kafka_offset long"
    landed = spark.createDataFrame([("a", 0, 20_000), ("a", 1, 10), ("b", 0, 1_500)], ddl)
    consumed = spark.createDataFrame([("a", 0, 5), ("b", 0, 100)], ddl)
    got = {(r["topic"], r["kafka_partition"]): (r["lag"], r["tier"], r["breach"])
           for r in offset_lag(landed, consumed).collect()}
    assert got == {("a", 0): (19_995, "red", True), ("a", 1): (11, "green", False),
                   ("b", 0): (1_400, "yellow", False)}
    arrivals = spark.createDataFrame([("x", 1_000_000), ("y", 50_000)], "d string, kafka_created_at long")
    late = freshness_breach(arrivals, "d", F.lit(1_000_000)).collect()
    assert [(r["domain"], r["age_seconds"]) for r in late] == [("y", 950.0)]
    traffic = spark.sql("SELECT * FROM VALUES (timestamp_ntz'2024-01-01 00:01:00'),"
                        "(timestamp_ntz'2024-01-01 00:20:00') AS t(ts)")
    runs = spark.sql("SELECT timestamp_ntz'2024-01-01 00:14:59' AS ts")
    silent = silent_pipeline(traffic, runs).selectExpr("CAST(window_start AS STRING) AS w").collect()
    assert [r["w"] for r in silent] == ["2024-01-01 00:15:00"]
    volumes = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "topic string, bytes long")
    assert [r["topic"] for r in top_topics(volumes, "bytes", 2).collect()] == ["c", "a"]


# ----------------------------------------------------------------------- audit
def test_processing_log(spark, tmp_path):
    document = {
        "metadata": {"invocation_id": "i1"},
        "results": [
            {"unique_id": "model.p.silver_orders", "status": "success", "execution_time": 1.23456,
             "timing": [{"name": "compile", "started_at": "2024-01-01T00:00:00Z",
                         "completed_at": "2024-01-01T00:00:01Z"},
                        {"name": "execute", "started_at": "2024-01-01T00:00:01Z",
                         "completed_at": "2024-01-01T00:00:02Z"}]},
            {"unique_id": "model.p.gold_x", "status": "error", "execution_time": 0.5,
             "message": "m" * 3000, "timing": []},
            {"unique_id": "model.p.stray", "status": "skipped"},
            {"unique_id": "test.p.unique", "status": "pass"},
        ],
    }
    (tmp_path / "run_results.json").write_text(json.dumps(document, indent=2))
    results = read_run_results(spark, str(tmp_path / "run_results.json"))
    counts = layer_row_counts({"silver_orders": spark.range(7)})
    rows = {r["dbt_model"]: r for r in
            processing_log(results, counts, "run", F.current_timestamp()).collect()}
    assert set(rows) == {"silver_orders", "gold_x", "stray"}
    ok, bad, stray = rows["silver_orders"], rows["gold_x"], rows["stray"]
    assert (ok["layer"], ok["table_name"], ok["status"], ok["rows_processed"]) == (
        "silver", "orders", "success", 7)
    assert (ok["finished_at"] - ok["started_at"]).total_seconds() == 1 and float(ok["duration_seconds"]) == 1.235
    assert bad["status"] == "error" and len(bad["error_message"]) == 3000 and bad["started_at"] is None
    short = processing_log(results, counts, "run", F.current_timestamp(), message_width=2000)
    assert short.filter("dbt_model = 'gold_x'").collect()[0]["error_message"] == "m" * 2000
    assert (stray["layer"], stray["status"], stray["error_message"]) == ("other", "error", None)
    assert ok["dbt_invocation_id"] == "i1"


def test_the_log_joins_only_what_it_keeps(spark, sf_dir):
    """Messages of runs that did not fail, and times the log does not show, never reach the join."""
    from workloads.governance import run_results

    none = spark.createDataFrame([], "model string, rows_processed long")
    logged = processing_log(run_results(spark, sf_dir), none, "run", F.lit(None).cast("timestamp"))
    above, join, _ = logged._jdf.queryExecution().optimizedPlan().toString().partition("Join LeftOuter")
    assert join and "timing" not in above and "repeat(" not in above and "startsWith" not in above.lower()
    assert "element_at" not in above
