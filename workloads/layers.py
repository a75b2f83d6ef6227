"""Queries for sources, Bronze, Silver and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import (
    digits_modulo,
    epoch_ms,
    epoch_text_to_ms,
    identifier,
    ms_to_ntz,
    seconds_between,
)
from tidemark.operators import bronze as b
from tidemark.operators import merge as m
from tidemark.operators import resolve as r
from tidemark.operators.contracts import contract_for
from tidemark.operators.merge import union_by_name
from tidemark.sources.changes import dedup_redelivery, read_changes, route, topic_tables, unwrap_envelope
from tidemark.sources.envelopes import land_domain
from tidemark.spec import DOMAINS
from workloads.inputs import landing, landing_sql, table, union_all
from workloads.sql import NEWEST, bronze_sql, history_sql, silver_sql

QUERIES = {}
ORACLES = {}


def history(spark: SparkSession, sf_dir: str, domain: str, keyed: bool = False) -> DataFrame:
    """Normalised change history of a domain."""
    return b.normalise(landing(spark, sf_dir, domain, keyed=keyed), DOMAINS[domain])


def silver(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    """Current state of a domain, resolved from its whole landing history."""
    contract = contract_for(f"silver_{domain}")
    return r.silver(history(spark, sf_dir, domain, contract.cdc_strategy == "upsert"), contract)


def bronze(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    return b.bronze(landing(spark, sf_dir, domain, keyed=True), DOMAINS[domain])


# A NULL date column reads back differently in the two engines' clients; it is text here.
_DATES = {"users_mssql": "birthday", "drivers": "date_birth"}
_NO_STAMP = ("users_mongo", "users_mssql", "restaurants", "drivers")


def _comparable(df: DataFrame, domain: str) -> DataFrame:
    if domain in _DATES:
        df = df.withColumn(_DATES[domain], F.col(_DATES[domain]).cast("string"))
    if domain in _NO_STAMP:
        df = df.withColumn("dt_current_timestamp", F.col("dt_current_timestamp").cast("string"))
    return df


def _comparable_sql(sql: str, domain: str) -> str:
    casts = []
    if domain in _DATES:
        casts.append(f"CAST({_DATES[domain]} AS VARCHAR) AS {_DATES[domain]}")
    if domain in _NO_STAMP:
        casts.append("CAST(dt_current_timestamp AS VARCHAR) AS dt_current_timestamp")
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql}) t" if casts else sql


for _name in DOMAINS:
    QUERIES[f"bronze_{_name}"] = (
        lambda spark, sf, d=_name: _comparable(bronze(spark, sf, d), d)
    )
    ORACLES[f"bronze_{_name}"] = _comparable_sql(bronze_sql(_name), _name)
    QUERIES[f"silver_{_name}"] = (
        lambda spark, sf, d=_name: _comparable(silver(spark, sf, d), d)
    )
    ORACLES[f"silver_{_name}"] = _comparable_sql(silver_sql(_name), _name)


# --------------------------------------------------------------------- sources
EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def scan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed scan of a feed; pruned to the columns in use."""
    rows = read_changes(spark, sf_dir, EVENTS_DDL, name_filter="events.parquet")
    return rows.select("event_id", "user_id", "event_type", epoch_ms("ts").alias("arrived_ms"))


QUERIES["scan_changes"] = scan_changes
ORACLES["scan_changes"] = (
    "SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS arrived_ms FROM events"
)


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as before/after envelopes: errors are deletes, every 101st is a tombstone."""
    row = F.struct("event_id", "user_id", "event_type", "value")
    op = (
        F.when(F.col("event_type") == "error", "d")
        .when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "view", "r")
        .otherwise("u")
    )
    empty = F.col("event_id") % 101 == 0
    return table(spark, sf_dir, "events").select(
        F.when(~empty & op.isin("d", "u"), row).alias("before"),
        F.when(~empty & (op != "d"), row).alias("after"),
        F.when(~empty, op).alias("op"),
        F.when(~empty, F.struct(epoch_ms("ts").alias("ts_ms"))).alias("source"),
        F.col("event_id").alias("kafka_offset"),
    )


QUERIES["unwrap_envelope"] = lambda spark, sf: unwrap_envelope(
    envelopes(spark, sf), "event_id", keep=["kafka_offset"]
)
ORACLES["unwrap_envelope"] = """
SELECT
  CASE WHEN live THEN event_id END AS event_id,
  CASE WHEN live AND op <> 'd' THEN user_id END AS user_id,
  CASE WHEN live AND op <> 'd' THEN event_type END AS event_type,
  CASE WHEN live AND op <> 'd' THEN value END AS value,
  CASE WHEN live THEN op END AS "__OP",
  CASE WHEN live THEN ms END AS "__SOURCE_TS_MS",
  offs AS kafka_offset
FROM (
  SELECT *, event_id AS offs, event_id % 101 <> 0 AS live, epoch_us(ts) // 1000 AS ms,
    CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' ELSE 'u' END
      AS op
  FROM events
) e"""


def mixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed carrying several topics: the key and position of every domain's changes."""
    return union_all(
        [
            landing(spark, sf_dir, name).select(
                F.lit(spec.topic).alias("topic"),
                F.col(spec.key.upper()).alias("entity"),
                F.col("RECORD_METADATA.partition").alias("kafka_partition"),
                F.col("RECORD_METADATA.offset").alias("kafka_offset"),
                F.col("RECORD_METADATA.CreateTime").alias("kafka_created_at"),
            )
            for name, spec in DOMAINS.items()
        ]
    )


MIXED_FEED_SQL = " UNION ALL ".join(
    f"SELECT '{s.topic}' AS topic, '{n.upper()}' AS table_name, CAST({s.key} AS VARCHAR) AS entity, "
    f"kafka_partition, kafka_offset, kafka_created_at FROM ({landing_sql(n)}) x_{n}"
    for n, s in DOMAINS.items()
)


LANDED = ("orders", "search_events", "users_mssql")


def envelope_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed of JSON envelopes for several domains, with a field no contract knows."""
    stamps = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    frames = []
    for name in LANDED:
        spec = DOMAINS[name]
        rows = landing(spark, sf_dir, name, dealt=True)
        image = F.struct(
            *[F.col(identifier(f.name)).cast(f.dataType).alias(f.name) for f in spec.source_schema],
            F.lit("gold").alias("loyalty"),
        )
        dead = F.col("__SOURCE_TS_MS").isNull()
        gone = F.coalesce(F.col("__OP") == "d", F.lit(False))
        value = F.to_json(
            F.struct(
                F.when(gone, image).alias("before"),
                F.when(~gone, image).alias("after"),
                F.col("__OP").alias("op"),
                F.struct(F.col("__SOURCE_TS_MS").alias("ts_ms")).alias("source"),
            ),
            stamps,
        )
        frames.append(
            rows.select(
                F.lit(spec.topic).alias("topic"),
                F.when(~dead, value).alias("value"),
                F.col("RECORD_METADATA.offset").alias("kafka_offset"),
                F.col("RECORD_METADATA.partition").alias("kafka_partition"),
                F.col("RECORD_METADATA.CreateTime").alias("kafka_created_at"),
            )
        )
    return union_all(frames)


def landed_rows(name: str, landed: DataFrame) -> DataFrame:
    """Landing rows with lower-case names, times as zone-less timestamps, dates as text."""
    columns = []
    for field in DOMAINS[name].source_schema:
        column = F.col(identifier(field.name))
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")  # as it was cast when the feed was made
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return landed.select(
        F.lit(name).alias("domain"),
        *columns,
        F.col("__OP").alias("op"),
        F.col("__SOURCE_TS_MS").alias("source_ts_ms"),
        F.col("RECORD_METADATA.offset").alias("kafka_offset"),
        F.col("RECORD_METADATA.partition").alias("kafka_partition"),
        F.col("RECORD_METADATA.CreateTime").alias("kafka_created_at"),
        F.get_json_object("_EXTRA", "$.loyalty").alias("loyalty"),
    )


def land_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixed feed landed as typed rows of three domains."""
    feed = envelope_feed(spark, sf_dir)
    return union_by_name([landed_rows(d, land_domain(feed, DOMAINS[d])) for d in LANDED])


def _landed_sql(name: str) -> str:
    casts = []
    for field in DOMAINS[name].source_schema:
        if isinstance(field.dataType, T.TimestampType):
            casts.append(f"CAST({field.name} AS TIMESTAMP) AS {field.name}")
        elif isinstance(field.dataType, T.DateType):
            casts.append(f"CAST({field.name} AS VARCHAR) AS {field.name}")
    replaced = f" REPLACE ({', '.join(casts)})" if casts else ""
    return (
        f"SELECT '{name}' AS domain, *{replaced}, CASE WHEN source_ts_ms IS NOT NULL "
        f"AND op IS DISTINCT FROM 'd' THEN 'gold' END AS loyalty FROM ({landing_sql(name)}) l_{name}"
    )


QUERIES["land_changes"] = land_changes
ORACLES["land_changes"] = " UNION ALL BY NAME ".join(_landed_sql(d) for d in LANDED)


def route_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, keyed rows and last offset that each landing table receives."""
    return (
        route(mixed_feed(spark, sf_dir), topic_tables())
        .groupBy("topic", "table_name", "kafka_partition")
        .agg(
            F.count(F.lit(1)).alias("landed_rows"),
            F.count("entity").alias("keyed_rows"),
            F.max("kafka_offset").alias("last_offset"),
        )
    )


QUERIES["route_domains"] = route_domains
ORACLES["route_domains"] = f"""
SELECT topic, table_name, kafka_partition, count(*) AS landed_rows, count(entity) AS keyed_rows,
  max(kafka_offset) AS last_offset
FROM ({MIXED_FEED_SQL}) feed GROUP BY ALL"""


# ---------------------------------------------------------------- Bronze steps
QUERIES["flatten_metadata"] = lambda spark, sf: b.flatten_metadata(
    landing(spark, sf, "payment_events").select("EVENT_ID", "RECORD_METADATA")
).withColumnRenamed("EVENT_ID", "event_id")
ORACLES["flatten_metadata"] = (
    "SELECT event_id, kafka_offset, kafka_partition, kafka_created_at "
    f"FROM ({landing_sql('payment_events')}) landed"
)

QUERIES["drop_tombstones"] = lambda spark, sf: b.drop_tombstones(
    b.project_aliases(b.flatten_metadata(landing(spark, sf, "orders")), DOMAINS["orders"]),
    "order_id",
)
ORACLES["drop_tombstones"] = history_sql("orders")

QUERIES["dedup_redelivery"] = lambda spark, sf: dedup_redelivery(
    history(spark, sf, "payment_events")
)
ORACLES["dedup_redelivery"] = f"SELECT DISTINCT * FROM ({history_sql('payment_events')}) h"

# Arrivals up to this instant are already in the Bronze target.
_SPLIT = "2024-01-16 00:00:00"
_SPLIT_MS = 1705363200000


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    early = F.col("kafka_created_at") < _SPLIT_MS
    return rows.filter(early), rows.filter(~early)


def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(spark, sf_dir, "payment_events")
    target, _ = _split(rows)
    return b.above_watermark(rows, target)


QUERIES["incremental_filter"] = incremental_filter
ORACLES["incremental_filter"] = f"""
WITH h AS ({history_sql('payment_events')})
SELECT * FROM h WHERE kafka_created_at >
  (SELECT coalesce(max(kafka_created_at), 0) FROM h WHERE kafka_created_at < {_SPLIT_MS})"""

QUERIES["dedup_latest"] = lambda spark, sf: b.dedup_latest(
    history(spark, sf, "order_items", keyed=True), "order_item_id"
)
ORACLES["dedup_latest"] = f"""
WITH h AS ({history_sql('order_items')})
SELECT DISTINCT h.* FROM h JOIN (
  SELECT order_item_id AS k, max(row(source_ts_ms, kafka_offset)) AS v FROM h GROUP BY 1
) best ON h.order_item_id = best.k AND row(h.source_ts_ms, h.kafka_offset) = best.v"""


# -------------------------------------------------------------- Silver by user
def user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user feed as a batch."""
    return user_changes(table(spark, sf_dir, "events"))


def user_changes(events: DataFrame) -> DataFrame:
    """Events as a change feed per user with a day-wide clock, hence many ties.

    Every 101st row is a tombstone, ``op`` is missing on every 97th, errors delete.
    """
    dead = F.col("event_id") % 101 == 0
    op = F.when(F.col("event_id") % 97 != 0, F.when(F.col("event_type") == "error", "d")
                .when(F.col("event_type") == "signup", "c")
                .when(F.col("event_type") == "view", "r").otherwise("u"))
    rows = events.withColumns({"dead": dead, "_op": op})
    gone = F.col("dead") | F.col("_op").eqNullSafe("d")
    days = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return rows.select(
        F.when(~dead, F.col("user_id")).alias("user_id"),
        F.when(~gone, F.col("event_type")).alias("event_type"),
        F.when(~gone, F.col("value")).alias("value"),
        F.when(~dead, F.col("_op")).alias("op"),
        F.when(~dead, days * 86_400_000).alias("source_ts_ms"),
        F.col("event_id").alias("kafka_offset"),
        (F.col("user_id") % 4).cast("int").alias("kafka_partition"),
        epoch_ms("ts").alias("kafka_created_at"),
    )


USER_FEED_SQL = """
SELECT CASE WHEN NOT dead THEN user_id END AS user_id,
  CASE WHEN NOT gone THEN event_type END AS event_type,
  CASE WHEN NOT gone THEN value END AS value,
  CASE WHEN NOT dead THEN op END AS op,
  CASE WHEN NOT dead THEN (epoch_us(date_trunc('day', ts)) // 1000) END AS source_ts_ms,
  event_id AS kafka_offset, CAST(part AS INTEGER) AS kafka_partition,
  epoch_us(ts) // 1000 AS kafka_created_at
FROM (
  SELECT *, dead OR coalesce(op = 'd', false) AS gone FROM (
    SELECT *, user_id % 4 AS part, event_id % 101 = 0 AS dead,
      CASE WHEN event_id % 97 <> 0 THEN
        CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r'
          ELSE 'u' END END AS op
    FROM events) a
) b"""

_LATEST_USER = f"""
SELECT * FROM ({USER_FEED_SQL}) f WHERE user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {NEWEST}) = 1"""

QUERIES["resolve_upsert"] = lambda spark, sf: r.resolve_cdc(user_feed(spark, sf), "upsert", "user_id")
ORACLES["resolve_upsert"] = f"SELECT * FROM ({_LATEST_USER}) l WHERE op IS DISTINCT FROM 'd'"
QUERIES["resolve_latest_agg"] = lambda spark, sf: r.resolve_latest_agg(user_feed(spark, sf), "user_id")
ORACLES["resolve_latest_agg"] = ORACLES["resolve_upsert"]
QUERIES["resolve_append"] = lambda spark, sf: r.resolve_cdc(user_feed(spark, sf), "append", "user_id")
ORACLES["resolve_append"] = (
    f"SELECT * FROM ({USER_FEED_SQL}) f WHERE op IS DISTINCT FROM 'd' AND user_id IS NOT NULL"
)
QUERIES["resolve_log"] = lambda spark, sf: r.resolve_cdc(user_feed(spark, sf), "log", "user_id")
ORACLES["resolve_log"] = f"SELECT * FROM ({USER_FEED_SQL}) f WHERE user_id IS NOT NULL"


# ---------------------------------------------------------------------- merges
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later arrivals merged into the state of the earlier ones."""
    early, late = _split(b.drop_tombstones(user_feed(spark, sf_dir), "user_id"))
    return m.merge_upsert(b.dedup_latest(early, "user_id"), late, "user_id")


QUERIES["merge_upsert"] = merge_upsert
ORACLES["merge_upsert"] = _LATEST_USER


def merge_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier arrivals merged after the later ones: the newer state must survive."""
    early, late = _split(b.drop_tombstones(user_feed(spark, sf_dir), "user_id"))
    return m.merge_upsert(b.dedup_latest(late, "user_id"), early, "user_id")


QUERIES["merge_upsert_late"] = merge_older
ORACLES["merge_upsert_late"] = _LATEST_USER


def merge_insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed customers into a target holding only the frequent ones."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    ordered = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n >= 10")
    )
    target = customers.join(ordered, "c_custkey", "left_semi").withColumn(
        "c_mktsegment", F.lit("kept")
    )
    return m.merge_insert_missing(target, customers, "c_custkey")


QUERIES["merge_insert_missing"] = merge_insert_missing
ORACLES["merge_insert_missing"] = """
SELECT c_custkey, c_name,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 10) THEN 'kept' ELSE c_mktsegment END
    AS c_mktsegment
FROM customer"""


def soft_deactivate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in debt leave scope; nothing is deleted."""
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.lit(True).alias("active"), F.lit("manual").alias("changed_by"),
        "s_acctbal",
    )
    return m.update_where(
        suppliers,
        F.col("s_acctbal") < 2000,
        {"active": F.lit(False), "changed_by": F.lit("bootstrap")},
    )


QUERIES["soft_deactivate"] = soft_deactivate
ORACLES["soft_deactivate"] = """
SELECT s_suppkey, s_name, NOT (s_acctbal < 2000) AS active,
  CASE WHEN s_acctbal < 2000 THEN 'bootstrap' ELSE 'manual' END AS changed_by, s_acctbal
FROM supplier"""


def sync_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows take the shape of a batch with a new and a vanished column."""
    stored = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    incoming = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return m.sync_columns(stored, incoming)


QUERIES["sync_columns"] = sync_columns
ORACLES["sync_columns"] = (
    "SELECT o_orderkey, o_custkey, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders"
)


# --------------------------------------------------------------------- scalars
QUERIES["json_extract"] = lambda spark, sf: table(spark, sf, "events").select(
    "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")
)
ORACLES["json_extract"] = (
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
)


def epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = landing(spark, sf_dir, "payment_events").filter("EVENT IS NOT NULL")
    ms = epoch_text_to_ms(F.get_json_object("EVENT", "$.timestamp"))
    return feed.select(
        F.col("EVENT_ID").alias("event_id"), ms.alias("ms"), ms_to_ntz(ms).alias("instant")
    )


QUERIES["epoch_to_timestamp"] = epoch_to_timestamp
ORACLES["epoch_to_timestamp"] = f"""
SELECT event_id, ms, make_timestamp(ms * 1000) AS instant FROM (
  SELECT event_id, CAST(floor(CAST(json_extract_string(event, '$.timestamp') AS DOUBLE) + 0.5)
    AS BIGINT) AS ms
  FROM ({landing_sql('payment_events')}) l WHERE event IS NOT NULL) t"""

QUERIES["seconds_between"] = lambda spark, sf: (
    table(spark, sf, "events")
    .groupBy("user_id", "event_type")
    .agg(F.min("ts").alias("a"), F.max("ts").alias("z"))
    .select("user_id", "event_type", seconds_between("a", "z").alias("seconds"))
)
ORACLES["seconds_between"] = (
    "SELECT user_id, event_type, date_diff('second', min(ts), max(ts)) AS seconds "
    "FROM events GROUP BY 1, 2"
)

QUERIES["remap_key"] = lambda spark, sf: table(spark, sf, "customer").select(
    "c_custkey", digits_modulo("c_name").alias("driver_key")
)
ORACLES["remap_key"] = (
    "SELECT c_custkey, CAST(CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT) % 354 + 1 "
    "AS VARCHAR) AS driver_key FROM customer"
)
