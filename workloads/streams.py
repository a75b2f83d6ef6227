"""Queries that run streams or write tables, over the whole driver tables.

Each call works in a fresh directory under the cluster's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions import epoch_ms, ms_to_ntz
from tidemark.operators import bronze as b
from tidemark.operators.merge import union_by_name
from tidemark.sources.changes import read_changes
from tidemark.sources.envelopes import read_landing
from tidemark.sources.tables import StoredTable
from tidemark.sources.workdir import shared_dir
from tidemark.streaming.gate import run_gate
from tidemark.streaming.landing import read_topic_rate, run_dedup, run_landing, run_topic_rate
from tidemark.streaming.live import current_state, run_resolve
from tidemark.spec import DOMAINS
from workloads.layers import _LATEST_USER, _SPLIT_MS, EVENTS_DDL, LANDED
from workloads.layers import ORACLES as LAYER_ORACLES
from workloads.layers import _split, envelope_feed, landed_rows, user_changes, user_feed

QUERIES = {}
ORACLES = {}


def run_live(
    spark: SparkSession,
    sf_dir: str,
    work: str,
    start: Callable[[DataFrame], StreamingQuery],
    again: bool = False,
) -> None:
    """The whole events table as a live feed that arrives in three parts, out of order.

    The newest third of the time comes first, then the oldest, then the middle, so most
    rows are late; ``again`` delivers the oldest third once more with the last part.
    ``start`` begins a query over the feed, which goes on from its checkpoint each time.
    """
    events = spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")
    first, last = events.agg(F.min(epoch_ms("ts")), F.max(epoch_ms("ts"))).first()
    third = (last - first) // 3
    parts = [
        events.filter(epoch_ms("ts") >= first + 2 * third),
        events.filter(epoch_ms("ts") < first + third),
        events.filter((epoch_ms("ts") >= first + third) & (epoch_ms("ts") < first + 2 * third)),
    ]
    if again:
        parts[2] = parts[2].unionByName(parts[1])
    for part in parts:
        part.write.mode("append").parquet(f"{work}/feed")
        start(read_changes(spark, f"{work}/feed", EVENTS_DDL, streaming=True)).awaitTermination()


def stream_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live current state through the version-guarded merge."""
    work = shared_dir(spark, "stream-resolve")
    target = StoredTable(spark, f"{work}/table", "user_id")
    run_live(
        spark, sf_dir, work, lambda feed: run_resolve(user_changes(feed), target, f"{work}/checkpoint")
    )
    return current_state(target)


QUERIES["stream_resolve"] = stream_resolve
ORACLES["stream_resolve"] = LAYER_ORACLES["resolve_upsert"]


def stream_resolve_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live current state with the newest version kept in stream state."""
    work = shared_dir(spark, "stream-state")
    target = StoredTable(spark, f"{work}/table", "user_id")
    run_live(
        spark,
        sf_dir,
        work,
        lambda feed: run_resolve(user_changes(feed), target, f"{work}/checkpoint", stateful=True),
    )
    return current_state(target)


QUERIES["stream_resolve_stateful"] = stream_resolve_stateful
ORACLES["stream_resolve_stateful"] = LAYER_ORACLES["resolve_upsert"]


def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending signals and rows seen per domain after one gate run."""
    work = shared_dir(spark, "stream-gate")
    run_live(
        spark, sf_dir, work, lambda feed: run_gate(feed, "event_type", work, f"{work}/checkpoint")
    )
    seen = spark.read.parquet(f"{work}/stream_consumption_log").groupBy("domain").agg(
        F.sum("rows_seen").alias("rows_seen")
    )
    pending = spark.read.parquet(f"{work}/pending_runs").select("domain", "consumed").distinct()
    return seen.join(pending, "domain")


QUERIES["stream_gate"] = stream_gate
ORACLES["stream_gate"] = (
    "SELECT event_type AS domain, CAST(count(*) AS BIGINT) AS rows_seen, false AS consumed "
    "FROM events GROUP BY 1"
)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered twice at once and again in a later batch; one of each survives."""
    work = shared_dir(spark, "stream-dedup")

    def start(feed: DataFrame) -> StreamingQuery:
        twice = feed.select(
            F.col("event_type").alias("topic"),
            (F.col("user_id") % 4).cast("int").alias("kafka_partition"),
            F.col("event_id").alias("kafka_offset"),
            "value",
            F.explode(F.array(F.lit(1), F.lit(2))).alias("_copy"),
        )
        return run_dedup(twice.drop("_copy"), f"{work}/out", f"{work}/checkpoint")

    run_live(spark, sf_dir, work, start, again=True)
    return spark.read.parquet(f"{work}/out").drop("batch")


QUERIES["stream_dedup_redelivery"] = stream_dedup
ORACLES["stream_dedup_redelivery"] = (
    "SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS kafka_partition, "
    "event_id AS kafka_offset, value FROM events"
)


def stream_topic_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute windows of a live feed, late rows and open windows included."""
    work = shared_dir(spark, "stream-rate")

    def start(feed: DataFrame) -> StreamingQuery:
        messages = feed.select(
            F.col("event_type").alias("topic"),
            F.timestamp_millis(epoch_ms("ts")).alias("ts"),
            F.length("props").cast("bigint").alias("bytes"),
        )
        return run_topic_rate(messages, f"{work}/out", f"{work}/checkpoint")

    run_live(spark, sf_dir, work, start)
    return read_topic_rate(spark, f"{work}/out").withColumn(
        "window_start", ms_to_ntz(F.unix_millis("window_start"))
    )


QUERIES["stream_topic_rate"] = stream_topic_rate
ORACLES["stream_topic_rate"] = """
SELECT event_type AS topic, date_trunc('minute', ts) AS window_start, count(*) AS messages,
  CAST(sum(length(props)) AS BIGINT) AS bytes
FROM events GROUP BY 1, 2"""


def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored batches, the newer one first, with a column that leaves and returns.

    ``mark`` is 1 in the first batch, missing in the second and 2 in the third, which is the
    second again; a returned column is NULL for rows that the third batch did not bring.
    """
    work = shared_dir(spark, "snapshot-merge")
    target = StoredTable(spark, f"{work}/table", "user_id")
    early, late = _split(b.drop_tombstones(user_feed(spark, sf_dir), "user_id"))
    target.merge(late.withColumn("mark", F.lit(1)))
    target.merge(early)
    target.merge(early.withColumn("mark", F.lit(2)))
    return target.read()


QUERIES["snapshot_merge"] = snapshot_merge
ORACLES["snapshot_merge"] = (
    f"SELECT *, CASE WHEN kafka_created_at < {_SPLIT_MS} THEN 2 END AS mark FROM ({_LATEST_USER}) l"
)


def table_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table that is replaced as a whole, then read."""
    target = StoredTable(spark, f"{shared_dir(spark, 'rebuild')}/table", "user_id")
    early, _ = _split(b.drop_tombstones(user_feed(spark, sf_dir), "user_id"))
    target.overwrite(b.dedup_latest(early, "user_id"))
    target.overwrite(b.dedup_latest(b.drop_tombstones(user_feed(spark, sf_dir), "user_id"), "user_id"))
    return target.read()


QUERIES["table_rebuild"] = table_rebuild
ORACLES["table_rebuild"] = _LATEST_USER


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed feed, arriving in two parts, landed per domain."""
    work = shared_dir(spark, "stream-landing")
    feed = envelope_feed(spark, sf_dir)
    specs = [DOMAINS[d] for d in LANDED]
    for part in (1, 0):
        feed.filter(F.col("kafka_offset") % 2 == part).write.mode("append").parquet(f"{work}/feed")
        stream = read_changes(spark, f"{work}/feed", feed.schema, streaming=True)
        run_landing(stream, specs, f"{work}/landing", f"{work}/checkpoint").awaitTermination()
    return union_by_name(
        [landed_rows(s.name, read_landing(spark, f"{work}/landing", s)) for s in specs]
    )


QUERIES["stream_landing"] = stream_landing
ORACLES["stream_landing"] = LAYER_ORACLES["land_changes"]

