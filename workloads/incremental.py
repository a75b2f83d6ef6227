"""Reports and counts kept up to date batch by batch, over the whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import bucket_start
from tidemark.operators import quality
from tidemark.operators.resolve import resolve_cdc
from tidemark.operators.sketches import (
    append_sketches,
    distinct_sketches,
    heavy_sketches,
    read_distinct,
    top_items,
)
from tidemark.plans import gold
from tidemark.plans.differential import PaymentsByStatus, apply_all
from tidemark.sources.workdir import shared_dir
from workloads.governance import _SPLIT_MS
from workloads.governance import ORACLES as CHECK_ORACLES
from workloads.inputs import table
from workloads.layers import history, silver
from workloads.reports import ORACLES as REPORT_ORACLES

QUERIES = {}
ORACLES = {}


def payment_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The change history of payment events in three batches, the newest third first.

    Updates and deletes are in other batches than what they change, and the last batch
    brings the first one again.
    """
    rows = history(spark, sf_dir, "payment_events")
    first, last = rows.agg(F.min("kafka_created_at"), F.max("kafka_created_at")).first()
    third = (last - first) // 3 + 1
    number = F.floor((F.col("kafka_created_at") - first) / third) + F.col("kafka_offset") % 4
    parts = [rows.filter(number % 3 == n) for n in (2, 0, 1)]
    return [parts[0], parts[1], parts[2].unionByName(parts[0])]


def payments_by_status_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after three batches of changes, from their differences only."""
    target = PaymentsByStatus(spark, shared_dir(spark, "payments-by-status"), buckets=8)
    return apply_all(target, payment_batches(spark, sf_dir)).report()


QUERIES["payments_by_status_incremental"] = payments_by_status_incremental
ORACLES["payments_by_status_incremental"] = REPORT_ORACLES["payments_by_status"]


def distinct_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders and parts per supplier, and over all, from sketches of three batches."""
    work = shared_dir(spark, "distinct-sketches")
    lines = table(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    values = ["l_orderkey", "l_partkey"]
    for batch in range(3):  # a batch repeats orders and parts of the others
        part = lines.filter(F.col("l_linenumber") % 3 == batch)
        append_sketches(distinct_sketches(part, ["l_suppkey", "day"], values), work, batch)
    exact = [F.countDistinct(v).alias(f"exact_{v}") for v in values]
    frames = []
    for by in (["l_suppkey"], []):
        near = read_distinct(spark, work, by, values)
        known = lines.groupBy(*by).agg(*exact)
        joined = near.join(known, by) if by else near.select("*", *[known.select(f"exact_{v}").scalar().alias(f"exact_{v}") for v in values])
        frames.append(joined if by else joined.withColumn("l_suppkey", F.lit(None).cast("long")))
    both = frames[0].unionByName(frames[1])
    close = [
        (F.abs(F.col(v) - F.col(f"exact_{v}")) <= 0.03 * F.col(f"exact_{v}")).alias(f"{n}_within_3_pct")
        for v, n in zip(values, ("orders", "parts"))
    ]
    return both.select(
        F.col("l_suppkey").alias("supplier"), F.col("exact_l_orderkey").alias("orders"),
        F.col("exact_l_partkey").alias("parts"), *close,
    )


QUERIES["distinct_sketches"] = distinct_by_sketch
ORACLES["distinct_sketches"] = """
SELECT l_suppkey AS supplier, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
  true AS orders_within_3_pct, true AS parts_within_3_pct FROM lineitem GROUP BY l_suppkey
UNION ALL SELECT NULL, count(DISTINCT l_orderkey), count(DISTINCT l_partkey), true, true FROM lineitem"""

#: Candidates that a sketch tracks.
TRACKED = 512


def top_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heaviest of very many topics, from one sketch an hour and an exact recount."""
    work = shared_dir(spark, "top-items")
    # few topics have much of the traffic, very many have little
    topic = F.concat(F.lit("t"), F.floor(F.col("o_custkey") / (1 + F.col("o_orderkey") % 50)))
    rows = table(spark, sf_dir, "orders").select(
        topic.alias("topic"), bucket_start("o_orderdate", 3600).alias("hour")
    )
    heavy_sketches(rows, ["hour"], "topic", TRACKED).write.parquet(work)
    return top_items(rows, spark.read.parquet(work), "topic", 5, TRACKED)


QUERIES["top_items"] = top_by_sketch
ORACLES["top_items"] = """
SELECT 't' || (o_custkey // (1 + o_orderkey % 50)) AS topic, count(*) AS n
FROM orders GROUP BY 1 ORDER BY n DESC, topic LIMIT 5"""


def reconcile_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report built from earlier arrivals, of which only parts that differ meet the facts."""
    changes = history(spark, sf_dir, "payment_events")
    earlier = changes.filter(F.col("kafka_created_at") < _SPLIT_MS)
    report = gold.payment_lifecycle(resolve_cdc(earlier, "upsert", "event_id"))
    return quality.reconcile_by_digests(silver(spark, sf_dir, "payment_events"), report)


QUERIES["reconcile_digests"] = reconcile_by_digests
ORACLES["reconcile_digests"] = CHECK_ORACLES["reconcile"]
