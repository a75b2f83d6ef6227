"""Change feeds derived from the driver tables.

The driver tables hold no change history, so each domain's landing feed is derived
from a whole table by expression: every source row becomes an insert or snapshot row
and, depending on its key, also an update, a redelivery, a delete with its tombstone,
or an old update that arrives after the delete.  Every row of the table takes part.

The derivation expressions below are plain SQL text valid in Spark and in DuckDB, so
that both sides of the correctness check start from the same feed; everything after
the feed (normalisation, resolution, reports) is written twice, independently.
``{ms:x}`` stands for the epoch milliseconds of a zone-less timestamp.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import bucket_start
from tidemark.spec import DOMAINS

EPOCH_MS = {
    "spark": (
        "(datediff(to_date({0}), DATE'1970-01-01') * 86400000L + hour({0}) * 3600000L"
        " + minute({0}) * 60000L + CAST(floor(extract(SECOND FROM {0}) * 1000) AS BIGINT))"
    ),
    "duckdb": "(epoch_us({0}) // 1000)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt by ``key`` over three tasks a core.

    A table may be one file with one row group, which one task reads; what costs much per row
    (JSON made, parsed and typed) is dealt before it is done, while rows are small.
    """
    return rows.repartition(3 * rows.sparkSession.sparkContext.defaultParallelism, key)


@dataclass(frozen=True)
class Feed:
    """How one domain's feed is derived from a driver table."""

    table: str
    entity: str                 # key of the changed row, as text
    row: str                    # integer that selects which changes a row undergoes
    base_ms: str                # commit time of the first version
    payload: dict[str, str]     # source column -> expression; may use ``ver``
    sequence: str = ""          # unique number per source row; defaults to ``row``
    spread: str = ""            # integer that picks the log partition of a key
    prepared: str = "NULL"      # text computed once per source row, for use in the payload

    @property
    def position(self) -> str:
        return self.sequence or self.row

    @property
    def lane(self) -> str:
        return self.spread or self.row


_STAGE = (
    "CASE CAST(event_id % 7 AS INT) WHEN 0 THEN 'created' WHEN 1 THEN 'authorized' "
    "WHEN 2 THEN 'captured' WHEN 3 THEN 'succeeded' WHEN 4 THEN 'settled' "
    "WHEN 5 THEN 'closed' ELSE 'refunded' END"
)
_STAGE_MS = "CAST({ms:ts} AS STRING)"
_REC_KIND = (
    "CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'click' "
    "WHEN 'purchase' THEN 'add_to_cart' ELSE 'recommendation_served' END"
)
_ISSUE = (
    "CASE l_linenumber WHEN 1 THEN 'Late Start' WHEN 2 THEN 'App Crash' "
    "WHEN 3 THEN 'Lost GPS' WHEN 4 THEN CAST(NULL AS STRING) ELSE 'None' END"
)


def _person(key: str) -> str:
    """Every fifth customer shares a tax number with the next one."""
    return (
        f"lpad(CAST({key} - CASE WHEN {key} % 5 = 1 THEN 1 ELSE 0 END AS STRING), 11, '0')"
    )


_LINE_KEY = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
_LINE_ROW = "(l_partkey * 7 + l_suppkey)"
_LINE_SEQUENCE = "(l_partkey * 10000000 + l_suppkey)"

FEEDS = {
    "payment_events": Feed(
        "events", "CAST(event_id AS STRING)", "event_id", "{ms:ts}",
        {
            "payment_id": "CAST(user_id AS STRING)",
            "event": "prepared",
            "dt_current_timestamp": "ts",
        },
        # the moment is written as an integer or as a scientific float
        prepared="'{\"event_name\": \"' || " + _STAGE + " || '\", \"timestamp\": ' || "
                 "CASE WHEN event_id % 3 = 0 THEN substr(" + _STAGE_MS + ", 1, 1) || '.' || "
                 "substr(" + _STAGE_MS + ", 2) || 'e12' ELSE " + _STAGE_MS + " END || '}'",
    ),
    "orders": Feed(
        "orders", "CAST(o_orderkey AS STRING)", "o_orderkey", "{ms:o_orderdate}",
        {
            "order_date": "o_orderdate",
            "total_amount": "o_totalprice + ver",
            "user_key": _person("o_custkey"),
            "restaurant_key": "'cnpj-' || CAST((o_orderkey * 31 + o_custkey) % 200 AS STRING)",
            "driver_key": "CAST(o_orderkey % 100 AS STRING)",
            "payment_key": "o_orderstatus || CAST(o_orderkey AS STRING)",
            "rating_key": "o_orderpriority",
            "dt_current_timestamp": "o_orderdate",
        },
    ),
    "order_items": Feed(
        "lineitem", _LINE_KEY, _LINE_ROW, "{ms:l_shipdate}",
        {
            "order_id": "CAST(l_orderkey AS STRING)",
            "product_id": "CAST(l_suppkey AS STRING)",
            "restaurant_id": "CAST(l_partkey AS INT)",
            "product_name": "'product ' || CAST(l_suppkey AS STRING)",
            "product_type": "l_returnflag",
            "cuisine_type": "l_linestatus",
            "unit_price": "l_extendedprice",
            "quantity": "CAST(l_quantity AS INT)",
            "subtotal": "l_extendedprice + ver",
            "discount_applied": "CAST(floor(l_extendedprice * l_discount * 100.0 + 0.5) AS DOUBLE) / CAST(100 AS DOUBLE)",
            "modifiers": "CAST(NULL AS STRING)",
            "is_combo": "(l_linenumber % 2 = 0)",
            "is_vegetarian": "(l_returnflag = 'N')",
            "dt_current_timestamp": "l_shipdate",
        },
        _LINE_SEQUENCE, "(l_orderkey + l_linenumber)",
    ),
    "driver_shifts": Feed(
        "lineitem", _LINE_KEY, _LINE_ROW, "{ms:l_shipdate}",
        {
            "driver_id": "CAST(l_suppkey AS STRING)",
            "city": "'city-' || CAST(l_suppkey % 12 AS STRING)",
            "region": "l_linestatus",
            "shift_type": "l_returnflag",
            "login_method": "CASE WHEN l_linenumber % 2 = 0 THEN 'pin' ELSE 'face' END",
            "device_os": "CASE WHEN l_linenumber % 3 = 0 THEN 'ios' ELSE 'android' END",
            "start_time": "l_shipdate",
            "end_time": "l_shipdate",
            "shift_duration_min": "CAST(l_quantity AS INT) * 10 + CAST(ver AS INT)",
            "num_orders": "l_linenumber",
            "distance_covered_km": "l_quantity * 1.5",
            "earnings_brl": "l_extendedprice",
            "shift_rating": "CASE WHEN l_linenumber = 7 THEN CAST(NULL AS DOUBLE) "
                            "ELSE CAST(floor(l_discount * 50.0 + 0.5) AS DOUBLE) / CAST(4 AS DOUBLE) END",
            "issues_reported": _ISSUE,
            "available": "(l_linestatus = 'O')",
            "dt_current_timestamp": "l_shipdate",
        },
        _LINE_SEQUENCE, "(l_orderkey + l_linenumber)",
    ),
    "search_events": Feed(
        "events", "'s' || CAST(event_id AS STRING)", "event_id + 3", "{ms:ts}",
        {
            "user_id": "CAST(user_id AS INT)",
            "query_text": "event_type || ' ' || CAST(event_id % 23 AS STRING)",
            "filters": "props",
            "result_count": "CAST(floor(value) AS INT)",
            "clicked_product_id": "CASE WHEN event_type = 'click' "
                                  "THEN 'p' || CAST(event_id AS STRING) END",
            "timestamp": "ts",
        },
    ),
    "recommendations": Feed(
        "events", "'r' || CAST(event_id AS STRING)", "event_id + 5", "{ms:ts}",
        {
            "user_id": "CAST(user_id AS INT)",
            "product_id": "'p' || CAST(event_id % 500 AS STRING)",
            "event_type": _REC_KIND,
            "timestamp": "ts",
            "dt_current_timestamp": "ts",
        },
    ),
    "users_mongo": Feed(
        "customer", "'m' || CAST(c_custkey AS STRING)", "c_custkey + 2",
        "(1700000000000 + c_custkey * 1000)",
        {
            "user_id": "CAST(c_custkey AS INT)",
            "cpf": _person("c_custkey"),
            "email": "lower(c_name) || '.' || CAST(ver AS STRING) || '@example.com'",
            "phone_number": "lpad(CAST(c_custkey AS STRING), 9, '9')",
            "city": "'city-' || CAST(c_nationkey AS STRING)",
            "country": "c_mktsegment",
            "delivery_address": "c_name",
            "dt_current_timestamp": "CAST(NULL AS TIMESTAMP)",
        },
    ),
    "users_mssql": Feed(
        "customer", "'q' || CAST(c_custkey AS STRING)", "c_custkey + 6",
        "(1700000000000 + c_custkey * 1000)",
        {
            "user_id": "CAST(c_custkey AS INT)",
            "cpf": _person("c_custkey"),
            "first_name": "substr(c_name, 1, 8) || CAST(ver AS STRING)",
            "last_name": "substr(c_name, 10, 9)",
            "phone_number": "lpad(CAST(c_custkey AS STRING), 9, '8')",
            "birthday": "DATE '1950-01-01' + CAST(c_custkey * 7 % 20000 AS INT)",
            "job": "c_mktsegment",
            "company_name": "'company-' || CAST(c_nationkey AS STRING)",
            "country": "CAST(c_nationkey AS STRING)",
            "dt_current_timestamp": "CAST(NULL AS TIMESTAMP)",
        },
    ),
    "restaurants": Feed(
        "part", "'t' || CAST(p_partkey AS STRING)", "p_partkey + 1",
        "(1700000000000 + p_partkey * 1000)",
        {
            # every fourth restaurant is registered again under its neighbour's key
            "restaurant_id": "CAST(p_partkey - CASE WHEN p_partkey % 4 = 1 THEN 1 ELSE 0 END"
                             " AS INT)",
            "cnpj": "'cnpj-' || CAST(p_partkey AS STRING)",
            "name": "p_name || ' ' || CAST(ver AS STRING)",
            "address": "p_brand",
            "city": "p_type",
            "country": "'BR'",
            "phone_number": "lpad(CAST(p_partkey AS STRING), 9, '7')",
            "cuisine_type": "p_type",
            "opening_time": "'10:00:00'",
            "closing_time": "'22:00:00'",
            "average_rating": "CAST(floor(p_retailprice / 10.0) AS DOUBLE) / CAST(100 AS DOUBLE)",
            "num_reviews": "p_size",
            "dt_current_timestamp": "CAST(NULL AS TIMESTAMP)",
        },
    ),
    "drivers": Feed(
        "supplier", "'d' || CAST(s_suppkey AS STRING)", "s_suppkey + 4",
        "(1700000000000 + s_suppkey * 1000)",
        {
            "driver_id": "CAST(s_suppkey - CASE WHEN s_suppkey % 4 = 1 THEN 1 ELSE 0 END"
                         " AS STRING)",
            "first_name": "substr(s_name, 1, 8) || CAST(ver AS STRING)",
            "last_name": "substr(s_name, 10, 9)",
            "phone_number": "lpad(CAST(s_suppkey AS STRING), 9, '6')",
            "city": "'city-' || CAST(s_nationkey AS STRING)",
            "country": "CAST(s_nationkey AS STRING)",
            "date_birth": "DATE '1960-01-01' + CAST(s_suppkey * 11 % 15000 AS INT)",
            "license_number": "s_name",
            "vehicle_type": "CASE WHEN s_suppkey % 2 = 0 THEN 'bike' ELSE 'car' END",
            "vehicle_make": "CAST(NULL AS STRING)",
            "vehicle_model": "CAST(NULL AS STRING)",
            "vehicle_year": "CAST(2000 + s_suppkey % 24 AS INT)",
            "dt_current_timestamp": "CAST(NULL AS TIMESTAMP)",
        },
    ),
}


# Which changes a source row undergoes; ``row`` is its integer, ``ver`` the step.
#   row % 10 = 0   insert, delete, tombstone; every second one also gets an update
#                  that is older than the delete and arrives after it
#   row % 3 = 0    insert, update (in the same millisecond for even rows)
#   row % 7 = 1    insert, delivered twice
#   else           insert or snapshot row only; op is missing when row % 97 = 0
_STEPS = (
    "CASE WHEN row_no % 20 = 0 THEN 3 WHEN row_no % 10 = 0 THEN 2 "
    "WHEN row_no % 3 = 0 THEN 1 WHEN row_no % 7 = 1 THEN 1 ELSE 0 END"
)
# A redelivered message is the same message again: it keeps step 0.
_VERSION = "CASE WHEN row_no % 10 = 0 OR row_no % 3 = 0 THEN step ELSE 0 END"
_CONTROL = {
    "dead": "(row_no % 10 = 0 AND ver = 2)",
    "op": "CASE WHEN row_no % 10 = 0 AND ver = 1 THEN 'd' "
          "WHEN ver = 3 OR (row_no % 3 = 0 AND ver = 1) THEN 'u' "
          "WHEN row_no % 97 = 0 THEN CAST(NULL AS STRING) "
          "WHEN row_no % 2 = 0 THEN 'r' ELSE 'c' END",
    "commit_ms": "base_ms + CASE WHEN ver = 0 THEN 0 WHEN ver = 3 THEN 30000 "
                 "WHEN row_no % 10 = 0 THEN 120000 WHEN row_no % 6 = 0 THEN 0 "
                 "WHEN row_no % 3 = 0 THEN 60000 ELSE 0 END",
    "log_offset": "sequence_no * 4 + ver",
    "log_partition": "CAST(lane_no % 4 AS INT)",
    "arrived_ms": "base_ms + ver * 1000",
}


def _render(expression: str, dialect: str) -> str:
    return re.sub(
        r"\{ms:(\w+)\}", lambda m: EPOCH_MS[dialect].format(m.group(1)), expression
    ).replace("TIMESTAMP)", "TIMESTAMP_NTZ)" if dialect == "spark" else "TIMESTAMP)")


def _payload_sql(domain: str, dialect: str) -> list[tuple[str, str]]:
    """``(column, expression)``: NULL on tombstones, and but for the key on deletes."""
    feed, spec = FEEDS[domain], DOMAINS[domain]
    columns = [(spec.key, f"CASE WHEN NOT dead THEN {feed.entity} END")]
    for name in spec.source_schema.names[1:]:
        value = _render(feed.payload[name], dialect)
        columns.append((name, f"CASE WHEN NOT dead AND NOT coalesce(op = 'd', false) THEN {value} END"))
    return columns


def landing(
    spark: SparkSession, sf_dir: str, domain: str, dealt: bool = False, keyed: bool = False
) -> DataFrame:
    """Landing form of a domain's feed: upper-case columns, metadata struct.

    With ``dealt`` source rows are first spread over all cores.  With ``keyed`` they are dealt by
    the key of the changed row, as a topic is, before changes are made of them: what groups the
    feed by key then neither sorts the longer changes ahead of a shuffle nor shuffles them.
    """
    feed = FEEDS[domain]
    rows = table(spark, sf_dir, feed.table)
    if dealt:
        rows = spread(rows, rows.columns[0])
    if keyed:
        rows = rows.withColumn("entity", F.expr(feed.entity)).repartition("entity")
    numbered = rows.selectExpr(
        "*",
        f"CAST({feed.row} AS BIGINT) AS row_no",
        f"CAST({feed.position} AS BIGINT) AS sequence_no",
        f"CAST({feed.lane} AS BIGINT) AS lane_no",
        f"CAST({_render(feed.base_ms, 'spark')} AS BIGINT) AS base_ms",
        f"CAST({_render(feed.prepared, 'spark')} AS STRING) AS prepared",
    )
    stepped = numbered.selectExpr("*", f"explode(sequence(0, {_STEPS})) AS step").selectExpr(
        "*", f"CAST({_VERSION} AS BIGINT) AS ver"
    )
    controlled = stepped.selectExpr("*", *[f"{e} AS {name}" for name, e in _CONTROL.items()])
    (key, entity), *payload = _payload_sql(domain, "spark")
    rest = [
        *[f"{e} AS `{name.upper()}`" for name, e in payload],
        "CASE WHEN NOT dead THEN op END AS `__OP`",
        "CASE WHEN NOT dead THEN commit_ms END AS `__SOURCE_TS_MS`",
        "named_struct('offset', log_offset, 'partition', log_partition,"
        " 'CreateTime', arrived_ms) AS RECORD_METADATA",
    ]
    if not keyed:
        return controlled.selectExpr(f"{entity} AS `{key.upper()}`", *rest)
    # apart from tombstones the key is the column that rows are dealt by, which Spark can see
    tombstones = controlled.filter("dead").selectExpr(f"CAST(NULL AS STRING) AS `{key.upper()}`", *rest)
    return controlled.filter("NOT dead").selectExpr(f"entity AS `{key.upper()}`", *rest).unionAll(tombstones)


def landing_sql(domain: str) -> str:
    """The same feed for the SQL side, with flat metadata columns."""
    feed = FEEDS[domain]
    payload = ",\n  ".join(f'{e} AS "{name}"' for name, e in _payload_sql(domain, "duckdb"))
    control = ", ".join(f"{e} AS {name}" for name, e in _CONTROL.items())
    return f"""SELECT
  {payload},
  CASE WHEN NOT dead THEN op END AS op,
  CAST(CASE WHEN NOT dead THEN commit_ms END AS BIGINT) AS source_ts_ms,
  CAST(log_offset AS BIGINT) AS kafka_offset,
  log_partition AS kafka_partition,
  CAST(arrived_ms AS BIGINT) AS kafka_created_at
FROM (
  SELECT *, {control}
  FROM (
    SELECT *, CAST({_VERSION} AS BIGINT) AS ver
    FROM (SELECT *, unnest(range(CAST({_STEPS} + 1 AS BIGINT))) AS step FROM (
      SELECT *, CAST({feed.row} AS BIGINT) AS row_no,
        CAST({feed.position} AS BIGINT) AS sequence_no,
        CAST({feed.lane} AS BIGINT) AS lane_no,
        CAST({_render(feed.base_ms, 'duckdb')} AS BIGINT) AS base_ms,
        CAST({_render(feed.prepared, 'duckdb')} AS VARCHAR) AS prepared
      FROM {feed.table}
    ) numbered) unrolled
  ) stepped
) controlled"""


def union_all(frames: list[DataFrame]) -> DataFrame:
    """One frame out of several with the same columns."""
    return reduce(DataFrame.unionByName, frames)


def topic_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter samples: messages per topic so far on that day, one sample per minute.

    The running total works on at most 1,440 rows per topic and day.
    """
    minute = bucket_start("ts", 60)
    per_minute = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("topic"), minute.alias("sampled_at"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    so_far = Window.partitionBy("topic", F.to_date("sampled_at")).orderBy("sampled_at")
    return per_minute.select(
        "topic", "sampled_at", F.sum("_n").over(so_far).cast("double").alias("value")
    )


TOPIC_SAMPLES_SQL = """
SELECT topic, sampled_at,
  CAST(sum(n) OVER (PARTITION BY topic, CAST(sampled_at AS DATE) ORDER BY sampled_at) AS DOUBLE)
    AS value
FROM (
  SELECT event_type AS topic, date_trunc('minute', ts) AS sampled_at, count(*) AS n
  FROM events GROUP BY 1, 2
) per_minute"""
