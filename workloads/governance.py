"""Queries for contracts, data quality, monitoring and audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import epoch_ms, ms_to_ntz
from tidemark.operators import audit, contracts, monitor, quality
from tidemark.operators.bronze import bronze as bronze_of
from tidemark.operators.resolve import resolve_cdc
from tidemark.plans import gold
from tidemark.plans.checks import layer_suite
from tidemark.spec import DOMAINS
from workloads.inputs import TOPIC_SAMPLES_SQL, landing, landing_sql, table, topic_samples
from workloads.layers import MIXED_FEED_SQL, bronze, history, mixed_feed, silver
from workloads.sql import NEWEST, bronze_sql, history_sql, silver_sql, with_silver

QUERIES = {}
ORACLES = {}

# A fixed commit instant keeps sync results comparable.
def _now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


_NOW_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


# ------------------------------------------------------------------- contracts
def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value and one key subject per customer; docs declare different subsets."""
    key = F.col("c_custkey")
    name = F.lower(F.regexp_replace("c_name", "#", "_"))
    doc = (
        F.when(key % 5 == 0, F.lit(""))
        .when(key % 5 == 1, F.concat(F.lit("table_type=fact,cdc_strategy=append,unique_key=k"), key))
        .when(key % 5 == 2, F.lit(" cdc_strategy = log , owner=ops"))
        .when(key % 5 == 3, F.lit("unique_key=uuid"))
    )
    kind = F.explode(F.array(F.lit("-value"), F.lit("-key")))
    return table(spark, sf_dir, "customer").select(
        name.alias("_name"), doc.alias("doc"), kind.alias("_kind")
    ).select(F.concat(F.lit("pg.public."), "_name", "_kind").alias("subject"), "doc")


SUBJECTS_SQL = """
SELECT 'pg.public.' || lower(replace(c_name, '#', '_')) || kind AS subject,
  CASE CAST(c_custkey % 5 AS INTEGER) WHEN 0 THEN ''
    WHEN 1 THEN 'table_type=fact,cdc_strategy=append,unique_key=k' || c_custkey
    WHEN 2 THEN ' cdc_strategy = log , owner=ops' WHEN 3 THEN 'unique_key=uuid' END AS doc
FROM customer, (VALUES ('-value'), ('-key')) kinds(kind)"""

_TABLES_SQL = f"""
SELECT subject, doc, left(subject, length(subject) - 6) AS topic,
  split_part(left(subject, length(subject) - 6), '.', 3) AS table_name
FROM ({SUBJECTS_SQL}) s WHERE subject LIKE '%-value'"""

_PARSED_SQL = f"""
SELECT *, CASE WHEN doc LIKE 'table_type=%' THEN 'fact' END AS table_type,
  CASE WHEN doc LIKE 'table_type=%' THEN 'append' WHEN doc LIKE ' cdc%' THEN 'log' END
    AS cdc_strategy,
  CASE WHEN doc LIKE 'table_type=%' THEN replace(doc, 'table_type=fact,cdc_strategy=append,unique_key=', '')
    WHEN doc LIKE 'unique_key=%' THEN 'uuid' END AS unique_key
FROM ({_TABLES_SQL}) t"""

QUERIES["subjects_to_tables"] = lambda spark, sf: contracts.subjects_to_tables(subjects(spark, sf))
ORACLES["subjects_to_tables"] = _TABLES_SQL


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.parse_doc(contracts.subjects_to_tables(subjects(spark, sf_dir)))


QUERIES["parse_contract_doc"] = incoming
ORACLES["parse_contract_doc"] = _PARSED_SQL


def stored_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract table that already knows the frequent customers, in varied states."""
    known = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("_n")
    ).filter("_n >= 10")
    key = F.col("c_custkey")
    name = F.lower(F.regexp_replace("c_name", "#", "_"))
    start = F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "customer").join(known, "c_custkey").select(
        name.alias("table_name"),
        F.concat(F.lit("pg.public."), name).alias("topic"),
        F.when(F.col("_n") > 12, "fact").otherwise("entity").alias("table_type"),
        F.when(key % 2 == 0, "log").otherwise("upsert").alias("cdc_strategy"),
        F.when(key % 3 == 0, F.lit("uuid")).otherwise(F.concat(F.lit("k"), key)).alias("unique_key"),
        (F.col("c_acctbal") >= 0).alias("active"),
        start.alias("registered_at"),
        start.alias("updated_at"),
        F.lit("manual").alias("source"),
        F.lit("append").alias("previous_strategy"),
        F.lit("bootstrap").alias("changed_by"),
        F.col("c_mktsegment").alias("notes"),
    )


_STORED_SQL = """
SELECT lower(replace(c_name, '#', '_')) AS table_name,
  'pg.public.' || lower(replace(c_name, '#', '_')) AS topic,
  CASE WHEN n > 12 THEN 'fact' ELSE 'entity' END AS table_type,
  CASE WHEN c_custkey % 2 = 0 THEN 'log' ELSE 'upsert' END AS cdc_strategy,
  CASE WHEN c_custkey % 3 = 0 THEN 'uuid' ELSE 'k' || c_custkey END AS unique_key,
  c_acctbal >= 0 AS active, TIMESTAMP '2023-01-01 00:00:00' AS registered_at,
  TIMESTAMP '2023-01-01 00:00:00' AS updated_at, 'manual' AS source,
  'append' AS previous_strategy, 'bootstrap' AS changed_by, c_mktsegment AS notes
FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 10) o
  ON o_custkey = c_custkey"""

_SYNC_CTE = f"""
WITH cur AS ({_STORED_SQL}), inc AS ({_PARSED_SQL}),
both_sides AS (
  SELECT i.table_name, c.table_name IS NULL AS fresh, i.topic AS new_topic,
    i.table_type AS nt, i.cdc_strategy AS ns, i.unique_key AS nk, c.* EXCLUDE (table_name),
    coalesce(i.table_type <> c.table_type, false) AS dt,
    coalesce(i.cdc_strategy <> c.cdc_strategy, false) AS ds,
    coalesce(i.unique_key <> c.unique_key, false) AS dk
  FROM inc i LEFT JOIN cur c USING (table_name)),
sync AS (SELECT *, CASE WHEN fresh THEN 'insert' WHEN dt OR ds OR dk THEN 'update'
  ELSE 'no_change' END AS change_type FROM both_sides)"""

QUERIES["sync_contracts"] = lambda spark, sf: contracts.sync_contracts(
    stored_contracts(spark, sf), incoming(spark, sf), _now()
)
ORACLES["sync_contracts"] = _SYNC_CTE + f"""
SELECT table_name, CASE WHEN fresh THEN new_topic ELSE topic END AS topic,
  coalesce(nt, table_type, 'entity') AS table_type,
  coalesce(ns, cdc_strategy, 'upsert') AS cdc_strategy,
  coalesce(nk, unique_key, 'id') AS unique_key, coalesce(active, true) AS active,
  coalesce(registered_at, {_NOW_SQL}) AS registered_at,
  CASE WHEN change_type = 'no_change' THEN updated_at ELSE {_NOW_SQL} END AS updated_at,
  CASE WHEN change_type = 'no_change' THEN source ELSE 'schema_registry' END AS source,
  CASE WHEN NOT fresh AND ds THEN cdc_strategy ELSE previous_strategy END AS previous_strategy,
  CASE WHEN change_type = 'no_change' THEN changed_by ELSE 'sync_metadata' END AS changed_by,
  notes
FROM sync"""

QUERIES["contract_history"] = lambda spark, sf: contracts.contract_history(
    stored_contracts(spark, sf), incoming(spark, sf), _now()
)
ORACLES["contract_history"] = _SYNC_CTE + f""",
lines AS (
  SELECT table_name, 'insert' AS change_type, 'all' AS field_changed, CAST(NULL AS VARCHAR) AS old_value,
    '{{"table_type":"' || coalesce(nt, 'entity') || '","cdc_strategy":"' || coalesce(ns, 'upsert')
      || '","unique_key":"' || coalesce(nk, 'id') || '"}}' AS new_value
  FROM sync WHERE fresh
  UNION ALL SELECT table_name, 'update', 'table_type', table_type, nt FROM sync WHERE dt
  UNION ALL SELECT table_name, 'update', 'cdc_strategy', cdc_strategy, ns FROM sync WHERE ds
  UNION ALL SELECT table_name, 'update', 'unique_key', unique_key, nk FROM sync WHERE dk)
SELECT *, {_NOW_SQL} AS changed_at, 'sync_metadata' AS changed_by, 'schema_registry' AS source
FROM lines"""

QUERIES["sync_summary"] = lambda spark, sf: contracts.sync_summary(
    stored_contracts(spark, sf), incoming(spark, sf)
)
ORACLES["sync_summary"] = _SYNC_CTE + " SELECT change_type, count(*) AS n FROM sync GROUP BY 1"

QUERIES["new_subjects"] = lambda spark, sf: contracts.new_subjects(
    subjects(spark, sf), stored_contracts(spark, sf)
)
ORACLES["new_subjects"] = (
    f"SELECT * FROM ({_TABLES_SQL}) t WHERE table_name NOT IN "
    f"(SELECT table_name FROM ({_STORED_SQL}) c)"
)


def fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static contracts for every customer with a positive balance."""
    return table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.lower(F.regexp_replace("c_name", "#", "_")).alias("table_name"),
        F.lit("fact").alias("table_type"),
        F.lit("append").alias("cdc_strategy"),
        F.lit("event_id").alias("unique_key"),
    )


_FALLBACK_SQL = """
SELECT lower(replace(c_name, '#', '_')) AS table_name, 'fact' AS table_type,
  'append' AS cdc_strategy, 'event_id' AS unique_key FROM customer WHERE c_acctbal > 0"""
_EFFECTIVE_SQL = f"""
SELECT table_name, table_type, cdc_strategy, unique_key FROM ({_STORED_SQL}) c WHERE active
UNION ALL
SELECT * FROM ({_FALLBACK_SQL}) f WHERE table_name NOT IN
  (SELECT table_name FROM ({_STORED_SQL}) c WHERE active)"""

QUERIES["effective_contracts"] = lambda spark, sf: contracts.effective_contracts(
    stored_contracts(spark, sf), fallback(spark, sf)
)
ORACLES["effective_contracts"] = _EFFECTIVE_SQL

QUERIES["model_contracts"] = lambda spark, sf: contracts.model_contracts(
    subjects(spark, sf)
    .transform(contracts.subjects_to_tables)
    .select(F.concat(F.lit("silver_"), "table_name").alias("model_name")),
    stored_contracts(spark, sf),
    fallback(spark, sf),
)
ORACLES["model_contracts"] = f"""
SELECT 'silver_' || t.table_name AS model_name, t.table_name,
  coalesce(e.table_type, 'entity') AS table_type, coalesce(e.cdc_strategy, 'upsert') AS cdc_strategy,
  coalesce(e.unique_key, 'id') AS unique_key, e.table_name IS NOT NULL AS known
FROM ({_TABLES_SQL}) t LEFT JOIN ({_EFFECTIVE_SQL}) e USING (table_name)"""

QUERIES["check_contract_drift"] = lambda spark, sf: contracts.check_contract_drift(
    fallback(spark, sf).withColumns(
        {"table_type": F.lit("Entity"), "cdc_strategy": F.lit("UPSERT"), "unique_key": F.lit("uuid")}
    ),
    stored_contracts(spark, sf),
)
_DRIFT_COLUMNS = (
    "table_name, tipo_esperado, estrategia_esperada, chave_esperada, "
    "tipo_atual, estrategia_atual, chave_atual"
)
ORACLES["check_contract_drift"] = f"""
WITH wanted AS (SELECT table_name, 'entity' AS tipo, 'upsert' AS estrategia, 'uuid' AS chave
  FROM ({_FALLBACK_SQL}) f),
found AS (SELECT table_name, table_type AS tipo, cdc_strategy AS estrategia, unique_key AS chave
  FROM ({_STORED_SQL}) c WHERE active),
common AS (SELECT table_name FROM wanted INTERSECT SELECT table_name FROM found)
SELECT {_DRIFT_COLUMNS}, 'lacking' AS motivo FROM (
  SELECT table_name, tipo AS tipo_esperado, estrategia AS estrategia_esperada,
    chave AS chave_esperada, NULL::VARCHAR AS tipo_atual, NULL::VARCHAR AS estrategia_atual,
    NULL::VARCHAR AS chave_atual FROM wanted WHERE table_name NOT IN (FROM common)) a
UNION ALL SELECT table_name, NULL, NULL, NULL, tipo, estrategia, chave, 'unasked'
  FROM found WHERE table_name NOT IN (FROM common)
UNION ALL SELECT table_name, w.tipo, w.estrategia, w.chave, f.tipo, f.estrategia, f.chave, 'differs'
  FROM (SELECT * FROM wanted EXCEPT SELECT * FROM found) w JOIN found f USING (table_name)"""


# --------------------------------------------------------------------- quality
QUERIES["check_unique"] = lambda spark, sf: quality.check_unique(
    silver(spark, sf, "users_mongo"), "cpf"
)
ORACLES["check_unique"] = with_silver("users_mongo") + (
    " SELECT cpf, count(*) AS n FROM s_users_mongo WHERE cpf IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
)

_CHECKED = "event_id, op, source_ts_ms, kafka_offset"
QUERIES["check_not_null"] = lambda spark, sf: quality.check_not_null(
    bronze(spark, sf, "payment_events"), "payment_id"
).select("event_id", "op", "source_ts_ms", "kafka_offset")
ORACLES["check_not_null"] = (
    f"SELECT {_CHECKED} FROM ({bronze_sql('payment_events')}) b WHERE payment_id IS NULL"
)

QUERIES["check_accepted_values"] = lambda spark, sf: quality.check_accepted_values(
    bronze(spark, sf, "orders"), "op", ["c", "r"]
)
ORACLES["check_accepted_values"] = (
    f"SELECT op, count(*) AS n FROM ({bronze_sql('orders')}) b WHERE op NOT IN ('c', 'r') GROUP BY 1"
)

QUERIES["check_relationships"] = lambda spark, sf: quality.check_relationships(
    table(spark, sf, "orders"), "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey"
)
ORACLES["check_relationships"] = (
    "SELECT o_orderkey, count(*) AS n FROM orders WHERE o_orderkey NOT IN "
    "(SELECT l_orderkey FROM lineitem) GROUP BY 1"
)


_SPLIT_MS = 1705363200000


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report built from earlier arrivals against the current facts."""
    changes = history(spark, sf_dir, "payment_events")
    earlier = changes.filter(F.col("kafka_created_at") < _SPLIT_MS)
    report = gold.payment_lifecycle(resolve_cdc(earlier, "upsert", "event_id"))
    return quality.reconcile(silver(spark, sf_dir, "payment_events"), report)


QUERIES["reconcile"] = reconcile
ORACLES["reconcile"] = with_silver("payment_events") + f""",
earlier AS (SELECT * FROM ({history_sql('payment_events')}) h WHERE kafka_created_at < {_SPLIT_MS}
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY {NEWEST}) = 1),
s AS (SELECT payment_id, count(*) AS n, max(event_timestamp_ms) AS m FROM s_payment_events
  WHERE payment_id IS NOT NULL GROUP BY 1),
g AS (SELECT payment_id, count(*) AS n, max(event_timestamp_ms) AS m FROM earlier
  WHERE payment_id IS NOT NULL AND op IS DISTINCT FROM 'd' GROUP BY 1),
differing AS (SELECT payment_id FROM (SELECT * FROM s EXCEPT SELECT * FROM g)
  UNION SELECT payment_id FROM (SELECT * FROM g EXCEPT SELECT * FROM s))
SELECT d.payment_id, (SELECT n FROM s WHERE s.payment_id = d.payment_id) AS eventos_silver,
  (SELECT m FROM s WHERE s.payment_id = d.payment_id) AS ultimo_ms_silver,
  (SELECT n FROM g WHERE g.payment_id = d.payment_id) AS eventos_gold,
  (SELECT m FROM g WHERE g.payment_id = d.payment_id) AS ultimo_ms_gold,
  CASE WHEN d.payment_id NOT IN (SELECT payment_id FROM g) THEN 'lacking'
    WHEN d.payment_id NOT IN (SELECT payment_id FROM s) THEN 'unfounded'
    WHEN d.payment_id NOT IN (SELECT s.payment_id FROM s JOIN g USING (payment_id, n)) THEN 'count'
    ELSE 'newest' END AS motivo
FROM differing d"""


def check_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed keys against a Bronze that lacks the later arrivals."""
    pairs = {}
    for name, spec in DOMAINS.items():
        landed = landing(spark, sf_dir, name)
        built = bronze_of(landed.filter(F.col("RECORD_METADATA.CreateTime") < _SPLIT_MS), spec)
        pairs[f"bronze_{name}"] = (landed, built, spec.key.upper())
    return quality.check_backlog(pairs)


QUERIES["check_backlog"] = check_backlog
ORACLES["check_backlog"] = " UNION ALL ".join(
    f"SELECT 'bronze_{d}' AS dominio, l AS chaves_no_landing, b AS linhas_no_modelo, l - b AS backlog "
    f"FROM (SELECT count(DISTINCT {DOMAINS[d].key}) AS l, "
    f"count(DISTINCT {DOMAINS[d].key}) FILTER (kafka_created_at < {_SPLIT_MS}) AS b "
    f"FROM ({landing_sql(d)}) x) z WHERE l <> b"
    for d in DOMAINS
)


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of the orders domain in both layers, counted and judged."""
    tables = {
        "bronze_orders": bronze(spark, sf_dir, "orders"),
        "silver_orders": silver(spark, sf_dir, "orders"),
        "silver_users_mongo": silver(spark, sf_dir, "users_mongo"),
        "silver_restaurants": silver(spark, sf_dir, "restaurants"),
        "silver_drivers": silver(spark, sf_dir, "drivers"),
    }
    wanted = ("bronze_orders", "silver_orders")
    return quality.quality_summary(layer_suite(tables, wanted))


def _failures(name: str, severity: str, sql: str) -> str:
    return f"SELECT '{name}' AS \"check\", '{severity}' AS severity, ({sql}) AS failures"


def _orders_checks() -> str:
    lines = []
    for table_name, alias in (("bronze_orders", "b"), ("silver_orders", "s")):
        lines.append(_failures(
            f"unique_{table_name}_order_id", "error",
            f"SELECT count(*) FROM (SELECT order_id FROM {alias} GROUP BY 1 HAVING count(*) > 1) d"))
    for column in ("order_id", "op", "source_ts_ms", "kafka_offset", "kafka_created_at"):
        lines.append(_failures(f"not_null_bronze_orders_{column}", "error",
                               f"SELECT count(*) FROM b WHERE {column} IS NULL"))
    for column in ("user_key", "restaurant_key"):
        lines.append(_failures(
            f"not_null_bronze_orders_{column}", "error",
            f"SELECT count(*) FROM b WHERE {column} IS NULL AND op IS DISTINCT FROM 'd'"))
    lines.append(_failures("accepted_values_bronze_orders_op", "error",
                           "SELECT count(*) FROM b WHERE op NOT IN ('c', 'u', 'd', 'r')"))
    for column in ("order_id", "source_ts_ms", "kafka_offset"):
        lines.append(_failures(f"not_null_silver_orders_{column}", "error",
                               f"SELECT count(*) FROM s WHERE {column} IS NULL"))
    lines.append(_failures("accepted_values_silver_orders_op", "error",
                           "SELECT count(*) FROM s WHERE op NOT IN ('c', 'u', 'r')"))
    for column, parent, key in (
        ("user_key", "users_mongo", "cpf"),
        ("restaurant_key", "restaurants", "cnpj"),
        ("driver_key", "drivers", "driver_id"),
    ):
        lines.append(_failures(
            f"relationships_silver_orders_{column}", "warn",
            f"SELECT count(DISTINCT {column}) FROM s WHERE {column} NOT IN "
            f"(SELECT {key} FROM s_{parent} WHERE {key} IS NOT NULL)"))
    return " UNION ALL ".join(lines)


QUERIES["quality_summary"] = quality_summary
ORACLES["quality_summary"] = with_silver("users_mongo", "restaurants", "drivers") + f""",
b AS ({bronze_sql('orders')}), s AS ({silver_sql('orders')}), counted AS ({_orders_checks()})
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM counted"""


# ------------------------------------------------------------------ monitoring
def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate signals: one per event; purchases were consumed before."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.col("event_type").alias("domain"),
        F.col("ts").alias("detected_at"),
        (F.col("event_type") == "purchase").alias("consumed"),
    )


QUERIES["gate_log"] = lambda spark, sf: monitor.gate_log(
    mixed_feed(spark, sf), "topic", _now()
)
ORACLES["gate_log"] = (
    f"SELECT topic AS domain, count(*) AS rows_seen, {_NOW_SQL} AS consumed_at "
    f"FROM ({MIXED_FEED_SQL}) f GROUP BY 1"
)

QUERIES["pending_domains"] = lambda spark, sf: monitor.pending_domains(pending(spark, sf))
ORACLES["pending_domains"] = (
    "SELECT event_type AS domain, count(*) AS signals, max(ts) AS newest FROM events "
    "WHERE event_type <> 'purchase' GROUP BY 1"
)
QUERIES["run_request"] = lambda spark, sf: monitor.run_request(pending(spark, sf))
ORACLES["run_request"] = (
    "SELECT string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS domains, max(ts) AS newest "
    "FROM events WHERE event_type <> 'purchase'"
)

QUERIES["consume_pending"] = lambda spark, sf: monitor.consume_pending(
    pending(spark, sf),
    pending(spark, sf).filter(F.col("detected_at") < F.lit("2024-01-16").cast("timestamp_ntz")),
)
ORACLES["consume_pending"] = (
    "SELECT event_id AS row_id, event_type AS domain, ts AS detected_at, "
    "event_type = 'purchase' OR ts < TIMESTAMP '2024-01-16' AS consumed FROM events"
)


_COUNTED = "2024-01-16"


def _totals(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """Running message counter per user, at the start of a day or after all events."""
    events = table(spark, sf_dir, "events")
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return events.groupBy(F.concat(F.lit("user-"), "user_id").alias("topic")).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )


QUERIES["counter_changes"] = lambda spark, sf: monitor.counter_changes(
    _totals(spark, sf, _COUNTED), _totals(spark, sf)
)
ORACLES["counter_changes"] = f"""
SELECT 'user-' || user_id AS topic,
  CAST(count(*) FILTER (ts < TIMESTAMP '{_COUNTED}') AS DOUBLE) AS previous,
  CAST(count(*) AS DOUBLE) AS current
FROM events GROUP BY user_id HAVING count(*) FILTER (ts >= TIMESTAMP '{_COUNTED}') > 0"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), "ts", F.length("props").cast("bigint").alias("bytes")
    )


QUERIES["topic_rate"] = lambda spark, sf: monitor.topic_rate(messages(spark, sf))
ORACLES["topic_rate"] = (
    "SELECT event_type AS topic, date_trunc('minute', ts) AS window_start, count(*) AS messages, "
    "CAST(sum(length(props)) AS BIGINT) AS bytes FROM events GROUP BY 1, 2"
)

QUERIES["counter_rate"] = lambda spark, sf: monitor.counter_rate(topic_samples(spark, sf))
ORACLES["counter_rate"] = f"""
SELECT topic, sampled_at, increase,
  increase / ((epoch_us(sampled_at) // 1000 / 1000.0) - (epoch_us(pt) // 1000 / 1000.0)) AS per_second
FROM (SELECT *, CASE WHEN value < pv THEN value ELSE value - pv END AS increase FROM (
  SELECT *, lag(value) OVER w AS pv, lag(sampled_at) OVER w AS pt FROM ({TOPIC_SAMPLES_SQL}) s
  WINDOW w AS (PARTITION BY topic ORDER BY sampled_at)) a) b
WHERE pv IS NOT NULL"""

QUERIES["top_topics"] = lambda spark, sf: monitor.top_topics(
    messages(spark, sf)
    .withColumn("topic", F.concat("topic", F.lit("-"), F.dayofmonth("ts")))
    .groupBy("topic")
    .agg(F.sum("bytes").alias("bytes")),
    "bytes",
)
ORACLES["top_topics"] = (
    "SELECT event_type || '-' || day(ts) AS topic, CAST(sum(length(props)) AS BIGINT) AS bytes "
    "FROM events GROUP BY 1 ORDER BY bytes DESC, topic LIMIT 5"
)

_READ_UNTIL = 1705363200000
QUERIES["offset_lag"] = lambda spark, sf: monitor.offset_lag(
    mixed_feed(spark, sf), F.col("kafka_created_at") < _READ_UNTIL
).withColumn("lag", F.col("lag").cast("bigint"))
ORACLES["offset_lag"] = f"""
SELECT *, CASE WHEN lag >= 10000 THEN 'red' WHEN lag >= 1000 THEN 'yellow' ELSE 'green' END AS tier,
  lag > 10000 AS breach
FROM (SELECT topic, kafka_partition, end_offset, done_offset,
    CAST(end_offset - coalesce(done_offset, -1) AS BIGINT) AS lag
  FROM (SELECT topic, kafka_partition, max(kafka_offset) AS end_offset,
      max(kafka_offset) FILTER (kafka_created_at < {_READ_UNTIL}) AS done_offset
    FROM ({MIXED_FEED_SQL}) f GROUP BY 1, 2) o) l"""

QUERIES["group_lag"] = lambda spark, sf: monitor.group_lag(
    monitor.offset_lag(mixed_feed(spark, sf), F.col("kafka_created_at") < _READ_UNTIL)
)
ORACLES["group_lag"] = (
    f"SELECT topic, CAST(sum(lag) AS BIGINT) AS lag FROM ({ORACLES['offset_lag']}) l GROUP BY 1"
)

_CLOCK = 1706659200000
QUERIES["freshness_breach"] = lambda spark, sf: monitor.freshness_breach(
    table(spark, sf, "events").select(
        F.concat(F.lit("user-"), "user_id").alias("topic"), epoch_ms("ts").alias("kafka_created_at")
    ),
    "topic",
    F.lit(_CLOCK),
)
ORACLES["freshness_breach"] = f"""
SELECT 'user-' || user_id AS domain, max(epoch_us(ts) // 1000) AS last_ms,
  ({_CLOCK} - max(epoch_us(ts) // 1000)) / 1000.0 AS age_seconds
FROM events GROUP BY user_id HAVING {_CLOCK} - max(epoch_us(ts) // 1000) > 900000"""

def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user-"), "user_id").alias("topic"), epoch_ms("ts").alias("kafka_created_at")
    )


# Late enough that most users are older than the tiers, early enough that some are not.
_FRESH_CLOCK = 1706616000000
QUERIES["freshness_status"] = lambda spark, sf: monitor.freshness_status(
    _arrivals(spark, sf),
    "topic",
    F.lit(_FRESH_CLOCK),
    table(spark, sf, "customer").select(F.concat(F.lit("user-"), "c_custkey").alias("domain")),
    warn_seconds=86_400,
    error_seconds=864_000,
)
ORACLES["freshness_status"] = f"""
SELECT *, CASE WHEN age_seconds IS NULL OR age_seconds > 864000 THEN 'error'
  WHEN age_seconds > 86400 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT domain, last_ms, ({_FRESH_CLOCK} - last_ms) / 1000.0 AS age_seconds
  FROM (SELECT DISTINCT 'user-' || c_custkey AS domain FROM customer) c
  LEFT JOIN (SELECT 'user-' || user_id AS domain, max(epoch_us(ts) // 1000) AS last_ms
    FROM events GROUP BY user_id) e USING (domain)) a"""

QUERIES["alert_firing"] = lambda spark, sf: monitor.firing(
    table(spark, sf, "events").select(
        F.concat(F.lit("user-"), "user_id").alias("topic"),
        F.col("ts").alias("sampled_at"),
        (F.col("event_type") != "purchase").alias("breach"),
    ),
    F.lit("2024-01-25 00:00:00").cast("timestamp_ntz"),
    hold_seconds=172_800,
)
ORACLES["alert_firing"] = """
WITH past AS (SELECT 'user-' || user_id AS topic, ts, event_type <> 'purchase' AS breach
  FROM events WHERE ts <= TIMESTAMP '2024-01-25'),
marked AS (SELECT *, count(*) FILTER (NOT breach) OVER (PARTITION BY topic ORDER BY ts DESC
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS calm_after FROM past)
SELECT topic, min(ts) AS since, count(*) AS samples FROM marked
WHERE breach AND calm_after = 0 GROUP BY 1
HAVING epoch_us(TIMESTAMP '2024-01-25') // 1000 - epoch_us(min(ts)) // 1000 >= 172800000"""

QUERIES["select_topics"] = lambda spark, sf: monitor.select_topics(
    mixed_feed(spark, sf), r"pg\.public\.(orders|drivers?_?shifts)"
).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))
ORACLES["select_topics"] = (
    f"SELECT topic, count(*) AS messages FROM ({MIXED_FEED_SQL}) f "
    "WHERE topic IN ('pg.public.orders', 'pg.public.driver_shifts') GROUP BY 1"
)

QUERIES["silent_pipeline"] = lambda spark, sf: monitor.silent_pipeline(
    table(spark, sf, "events"), table(spark, sf, "events").filter("event_type = 'signup'")
)
ORACLES["silent_pipeline"] = """
SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start, count(*) AS messages
FROM events GROUP BY 1 HAVING count(*) FILTER (event_type = 'signup') = 0"""


# ----------------------------------------------------------------------- audit
QUERIES["layer_row_counts"] = lambda spark, sf: audit.layer_row_counts(
    {
        **{f"bronze_{d}": bronze(spark, sf, d) for d in ("orders", "drivers")},
        **{f"silver_{d}": silver(spark, sf, d) for d in ("orders", "drivers")},
    }
)
ORACLES["layer_row_counts"] = " UNION ALL ".join(
    f"SELECT '{layer}_{d}' AS model, count(*) AS rows_processed FROM ({sql(d)}) x_{layer}_{d}"
    for layer, sql in (("bronze", bronze_sql), ("silver", silver_sql))
    for d in ("orders", "drivers")
)

QUERIES["usage_rollup"] = lambda spark, sf: audit.usage_rollup(
    table(spark, sf, "events"),
    "ts",
    ["event_type"],
    {"runs": F.count(F.lit(1)), "users": F.count_distinct("user_id")},
)
ORACLES["usage_rollup"] = (
    "SELECT date_trunc('day', ts)::TIMESTAMP AS period, event_type, count(*) AS runs, "
    "count(DISTINCT user_id) AS users, min(ts) AS first_seen, max(ts) AS last_seen "
    "FROM events GROUP BY 1, 2"
)


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run results derived from orders: one result per order, failed where status is F."""
    key = F.col("o_orderkey")
    prefix = F.element_at(
        F.array(*[F.lit(p) for p in ("model.p.bronze_", "model.p.silver_", "model.p.gold_", "test.p.")]),
        (key % 4 + 1).cast("int"),
    )
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:0"), (key % 10), F.lit("Z"))
    timing = F.array(
        *[
            F.struct(F.lit(n).alias("name"), stamp.alias("started_at"), stamp.alias("completed_at"))
            for n in ("compile", "execute")
        ]
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), "o_orderstatus").alias("invocation_id"),
        F.concat(prefix, F.lit("t"), key).alias("unique_id"),
        F.when(F.col("o_orderstatus") == "F", "error").otherwise("success").alias("status"),
        (F.col("o_totalprice") / 1000).alias("execution_time"),
        F.repeat(F.col("o_orderpriority"), 300).alias("message"),
        timing.alias("timing"),
    )


def processing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("rows_processed")
    )
    counts = lines.select(F.concat(F.lit("silver_t"), "l_orderkey").alias("model"), "rows_processed")
    logged = audit.processing_log(run_results(spark, sf_dir), counts, "r1", _now())
    stamps = {c: ms_to_ntz(F.unix_millis(c)) for c in ("started_at", "finished_at")}
    return logged.withColumns(
        {**stamps, "duration_seconds": F.col("duration_seconds").cast("double")}
    )


QUERIES["processing_log"] = processing_log
ORACLES["processing_log"] = f"""
SELECT 't' || o_orderkey AS table_name, layer, layer || '_t' || o_orderkey AS dbt_model,
  'run-' || o_orderstatus AS dbt_invocation_id, 'r1' AS run_id,
  CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'success' END AS status,
  CASE WHEN layer = 'silver' THEN coalesce(n, 0) ELSE 0 END AS rows_processed,
  floor(o_totalprice + 0.5) / 1000.0 AS duration_seconds,
  date_trunc('day', o_orderdate)::TIMESTAMP + to_seconds(o_orderkey % 10) AS started_at,
  date_trunc('day', o_orderdate)::TIMESTAMP + to_seconds(o_orderkey % 10) AS finished_at,
  CASE WHEN o_orderstatus = 'F' THEN repeat(o_orderpriority, 300) END AS error_message,
  'sensor' AS triggered_by, {_NOW_SQL} AS logged_at
FROM (SELECT *, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver'
    WHEN 2 THEN 'gold' END AS layer FROM orders) o
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
WHERE layer IS NOT NULL"""

