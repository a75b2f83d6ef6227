"""Live monitors over the whole events table, which arrives in parts with late rows among them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions import epoch_ms, ms_to_ntz
from tidemark.sources.changes import read_changes
from tidemark.sources.workdir import shared_dir
from tidemark.streaming.monitors import read_counter_rate, run_counter_rate, run_silent_pipeline
from workloads.governance import ORACLES as BATCH_ORACLES
from workloads.inputs import table, topic_samples

QUERIES = {}
ORACLES = {}

#: Rows of the last minutes before a part ends that come with the next one.
LATE_MS = 30 * 60_000


def arrive(
    rows: DataFrame, ms: Column, work: str, start: Callable[[], StreamingQuery], beat: Callable[[int], DataFrame]
) -> None:
    """Deliver ``rows`` in three parts by time; some of each part's end come late.

    ``beat`` gives a row of a later instant that ends the feed, so that all windows close.
    """
    timed = rows.withColumn("_ms", ms)
    first, last = timed.agg(F.min("_ms"), F.max("_ms")).first()
    third = (last - first) // 3 + 1
    part = F.floor((F.col("_ms") - first) / third)
    ends = first + (part + 1) * third
    late = (ends - F.col("_ms") <= LATE_MS) & (F.floor(F.col("_ms") / 60_000) % 3 == 1)
    timed = timed.withColumn("_part", part + late.cast("int"))
    for number in range(4):
        timed.filter(F.col("_part") == number).drop("_ms", "_part").write.mode("append").parquet(f"{work}/feed")
        start().awaitTermination()
    for number in (1, 2):
        beat(last + number * 7 * 86_400_000).write.mode("append").parquet(f"{work}/feed")
        start().awaitTermination()


def stream_silent_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Busy quarters of an hour in which no run started, from two live feeds."""
    work = shared_dir(spark, "stream-silent")
    rows = table(spark, sf_dir, "events").select("event_type", F.timestamp_millis(epoch_ms("ts")).alias("ts"))

    def start() -> StreamingQuery:
        feed = read_changes(spark, f"{work}/feed", rows.schema, streaming=True)
        # the beat moves both clocks and is itself a run, so its window is not silent
        runs = read_changes(spark, f"{work}/feed", rows.schema, streaming=True).filter("event_type IN ('signup', 'beat')")
        return run_silent_pipeline(feed, runs, f"{work}/out", f"{work}/checkpoint")

    def beat(ms: int) -> DataFrame:
        return spark.range(1).select(F.lit("beat").alias("event_type"), F.timestamp_millis(F.lit(ms)).alias("ts"))

    arrive(rows, F.unix_millis("ts"), work, start, beat)
    return spark.read.parquet(f"{work}/out").withColumn("window_start", ms_to_ntz(F.unix_millis("window_start")))


QUERIES["stream_silent_pipeline"] = stream_silent_pipeline
ORACLES["stream_silent_pipeline"] = BATCH_ORACLES["silent_pipeline"]

#: Messages a second below which a topic is slow, how long, and after how long it is silent.
LEAST, HOLD, SILENCE = 0.0008, 3600, 7200


def live_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything the live counter monitor says about samples of the whole events table."""
    work = shared_dir(spark, "stream-counter")
    rows = topic_samples(spark, sf_dir).withColumn("sampled_at", F.timestamp_millis(epoch_ms("sampled_at")))

    def start() -> StreamingQuery:
        feed = read_changes(spark, f"{work}/feed", rows.schema, streaming=True)
        return run_counter_rate(feed, f"{work}/out", f"{work}/checkpoint", LEAST, HOLD, SILENCE)

    def beat(ms: int) -> DataFrame:
        return spark.range(1).select(
            F.lit("beat").alias("topic"), F.timestamp_millis(F.lit(ms)).alias("sampled_at"), F.lit(0.0).alias("value")
        )

    arrive(rows, F.unix_millis("sampled_at"), work, start, beat)
    found = read_counter_rate(spark, f"{work}/out").filter("topic <> 'beat'")
    return found.withColumn("sampled_at", ms_to_ntz(F.unix_millis("sampled_at")))


def stream_counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of the live monitor: those of the batch form."""
    return live_rates(spark, sf_dir).filter("NOT silent").select("topic", "sampled_at", "increase", "per_second")


QUERIES["stream_counter_rate"] = stream_counter_rate
ORACLES["stream_counter_rate"] = BATCH_ORACLES["counter_rate"]


def stream_rate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics that were slow for an hour, or said nothing for two hours."""
    return live_rates(spark, sf_dir).filter("firing OR silent").select(
        "topic", "sampled_at", F.when(F.col("silent"), "silent").otherwise("slow").alias("alert")
    )


QUERIES["stream_rate_alerts"] = stream_rate_alerts
ORACLES["stream_rate_alerts"] = f"""
WITH r AS ({BATCH_ORACLES["counter_rate"]}),
low AS (SELECT *, per_second < {LEAST} AS slow,
    max(CASE WHEN per_second >= {LEAST} THEN sampled_at END) OVER (PARTITION BY topic ORDER BY sampled_at) AS calm FROM r),
held AS (SELECT *, min(sampled_at) OVER (PARTITION BY topic, calm ORDER BY sampled_at
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since FROM low WHERE slow),
samples AS (SELECT event_type AS topic, date_trunc('minute', ts) AS sampled_at FROM events GROUP BY 1, 2),
next AS (SELECT *, lead(sampled_at) OVER (PARTITION BY topic ORDER BY sampled_at) AS after FROM samples)
SELECT topic, sampled_at, 'slow' AS alert FROM held WHERE sampled_at - since >= INTERVAL {HOLD} SECONDS
UNION ALL
SELECT topic, sampled_at + INTERVAL {SILENCE} SECONDS, 'silent' FROM next
WHERE after IS NULL OR after - sampled_at >= INTERVAL {SILENCE} SECONDS"""
