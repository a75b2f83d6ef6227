"""Gates, lag, freshness and traffic, computed from tables.

Inputs are ordinary tables of samples or log rows.  Every operator aggregates per
topic or domain before it compares, and nothing orders a whole topic in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import epoch_ms

# Lag above this is an alert, freshness beyond this is a breach.
LAG_LIMIT = 10_000
LAG_TIERS = (1_000, 10_000)
FRESHNESS_WARN_SECONDS = 300
FRESHNESS_SECONDS = 900


# ----------------------------------------------------------------------- gates
def gate_log(landing: DataFrame, domain: str, now: Column) -> DataFrame:
    """One row per domain that received rows: how many, and when it was noticed."""
    return (
        landing.groupBy(F.col(domain).alias("domain"))
        .agg(F.count(F.lit(1)).alias("rows_seen"))
        .withColumn("consumed_at", now)
    )


def pending_domains(pending: DataFrame) -> DataFrame:
    """Unconsumed signals per domain with the newest detection.

    There is no time cut: a slow domain stays visible however far others are ahead.
    """
    return (
        pending.filter(~F.col("consumed"))
        .groupBy("domain")
        .agg(F.count(F.lit(1)).alias("signals"), F.max("detected_at").alias("newest"))
    )


def run_request(pending: DataFrame) -> DataFrame:
    """A single request for all pending domains, or no row when there is nothing to do.

    Works on one row per domain; the number of domains is that of the registered feeds.
    """
    return (
        pending_domains(pending)
        .agg(
            F.array_join(F.sort_array(F.collect_list("domain")), ",").alias("domains"),
            F.max("newest").alias("newest"),
        )
        .filter(F.col("newest").isNotNull())
    )


def consume_pending(pending: DataFrame, read_rows: DataFrame) -> DataFrame:
    """Mark exactly the signals that were read; later arrivals stay pending."""
    seen = read_rows.select("row_id").distinct().withColumn("_seen", F.lit(True))
    return (
        pending.join(seen, "row_id", "left")
        .withColumn("consumed", F.col("consumed") | F.coalesce("_seen", F.lit(False)))
        .select(*pending.columns)
    )


def counter_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Topics whose counter moved, appeared or vanished; a reset counts as movement."""
    before = previous.select("topic", F.col("value").alias("previous"))
    after = current.select("topic", F.col("value").alias("current"))
    zero = F.lit(0.0)
    return (
        before.join(after, "topic", "full")
        .select(
            "topic",
            F.coalesce("previous", zero).alias("previous"),
            F.coalesce("current", zero).alias("current"),
        )
        .filter("previous <> current")
    )


# ----------------------------------------------------------------------- rates
def bucketed_lag(
    df: DataFrame, key: str, order: str, columns: Sequence[str], bucket: Column
) -> DataFrame:
    """Previous row's ``columns`` per key, as ``prev_<column>``, without ordering a whole
    key in one task.

    Rows are ordered inside ``(key, bucket)``; ``bucket`` must not decrease with
    ``order``.  The first row of a bucket takes the last row of the key's previous
    bucket, found on one summary row per bucket.
    """
    framed = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(key, "_bucket").orderBy(order)
    last = framed.groupBy(key, "_bucket").agg(
        F.max_by(F.struct(*columns), order).alias("_last")
    )
    carried = last.select(
        key, "_bucket", F.lag("_last").over(Window.partitionBy(key).orderBy("_bucket")).alias("_carry")
    )
    within = framed.withColumn("_prev", F.lag(F.struct(*columns)).over(inside))
    joined = within.join(carried, [key, "_bucket"], "left").withColumn(
        "_prev", F.coalesce("_prev", "_carry")
    )
    return joined.select(
        *df.columns, *[F.col(f"_prev.{name}").alias(f"prev_{name}") for name in columns]
    )


def counter_rate(samples: DataFrame) -> DataFrame:
    """Per-second rate between consecutive samples of a cumulative counter.

    A value below its predecessor means the counter restarted from zero.
    """
    paired = bucketed_lag(
        samples, "topic", "sampled_at", ["value", "sampled_at"], F.to_date("sampled_at")
    )
    restarted = F.col("value") < F.col("prev_value")
    increase = F.when(restarted, F.col("value")).otherwise(F.col("value") - F.col("prev_value"))
    elapsed = _seconds(F.col("sampled_at")) - _seconds(F.col("prev_sampled_at"))
    return (
        paired.filter(F.col("prev_value").isNotNull())
        .select(
            "topic",
            "sampled_at",
            increase.alias("increase"),
            (increase / F.nullif(elapsed, F.lit(0.0))).alias("per_second"),
        )
    )


def _seconds(ts: Column) -> Column:
    return epoch_ms(ts).cast("double") / F.lit(1000.0)


def topic_rate(
    messages: DataFrame, ts: str = "ts", topic: str = "topic", width: str = "1 minute"
) -> DataFrame:
    """Messages and bytes per topic in tumbling windows (batch or stream)."""
    return (
        messages.groupBy(F.window(ts, width).alias("_w"), F.col(topic).alias("topic"))
        .agg(F.count(F.lit(1)).alias("messages"), F.sum("bytes").alias("bytes"))
        .select(
            "topic",
            F.col("_w.start").alias("window_start"),
            "messages",
            "bytes",
        )
    )


def top_topics(volumes: DataFrame, measure: str, k: int = 5) -> DataFrame:
    """The ``k`` heaviest topics; equal volumes are ordered by name."""
    return volumes.orderBy(F.desc(measure), "topic").limit(k)


# ------------------------------------------------------------------ lag, delay
def offset_lag(landed: DataFrame, consumed: DataFrame | Column) -> DataFrame:
    """Messages not yet consumed per topic and partition, with a severity tier.

    ``consumed`` is a second feed, or a condition that tells the consumed rows of
    ``landed``, which is then read once.
    """
    place = ["topic", "kafka_partition"]
    end = F.max("kafka_offset").alias("end_offset")
    if isinstance(consumed, Column):
        done = F.max(F.when(consumed, F.col("kafka_offset"))).alias("done_offset")
        both = landed.groupBy(*place).agg(end, done)
    else:
        done = consumed.groupBy(*place).agg(F.max("kafka_offset").alias("done_offset"))
        both = landed.groupBy(*place).agg(end).join(done, place, "left")
    low, high = LAG_TIERS
    return (
        both.withColumn("lag", F.col("end_offset") - F.coalesce("done_offset", F.lit(-1)))
        .withColumn(
            "tier",
            F.when(F.col("lag") >= high, "red").when(F.col("lag") >= low, "yellow").otherwise("green"),
        )
        .withColumn("breach", F.col("lag") > LAG_LIMIT)
    )


def group_lag(lag: DataFrame) -> DataFrame:
    """Total lag per topic."""
    return lag.groupBy("topic").agg(F.sum("lag").alias("lag"))


def freshness_breach(
    landing: DataFrame, domain: str, now_ms: Column, limit_seconds: int = FRESHNESS_SECONDS
) -> DataFrame:
    """Domains whose newest arrival is older than the limit."""
    age = (now_ms - F.col("last_ms")) / F.lit(1000.0)
    return (
        landing.groupBy(F.col(domain).alias("domain"))
        .agg(F.max("kafka_created_at").alias("last_ms"))
        .withColumn("age_seconds", age)
        .filter(F.col("age_seconds") > limit_seconds)
    )


def freshness_status(
    landing: DataFrame,
    domain: str,
    now_ms: Column,
    expected: DataFrame,
    warn_seconds: int = FRESHNESS_WARN_SECONDS,
    error_seconds: int = FRESHNESS_SECONDS,
) -> DataFrame:
    """``pass``, ``warn`` or ``error`` for every domain of ``expected``.

    A domain that never landed anything has no age and is an error.
    """
    age = (now_ms - F.col("last_ms")) / F.lit(1000.0)
    last = landing.groupBy(F.col(domain).alias("domain")).agg(F.max("kafka_created_at").alias("last_ms"))
    fresh = F.col("age_seconds")
    return (
        expected.select("domain")
        .distinct()
        .join(last, "domain", "left")
        .withColumn("age_seconds", age)
        .withColumn(
            "status",
            F.when(fresh.isNull() | (fresh > error_seconds), "error")
            .when(fresh > warn_seconds, "warn")
            .otherwise("pass"),
        )
    )


def firing(samples: DataFrame, now: Column, hold_seconds: int, group: str = "topic") -> DataFrame:
    """Groups in breach at ``now`` without a break for ``hold_seconds``, and since when.

    ``samples`` has the group, ``sampled_at`` and a boolean ``breach``.  A breach begins
    with the first such sample after the last one that was in order.
    """
    past = samples.filter(F.col("sampled_at") <= now)
    calm = past.filter(~F.col("breach")).groupBy(group).agg(F.max("sampled_at").alias("_calm"))
    return (
        past.filter("breach")
        .join(calm, group, "left")
        .filter(F.col("_calm").isNull() | (F.col("sampled_at") > F.col("_calm")))
        .groupBy(group)
        .agg(F.min("sampled_at").alias("since"), F.count(F.lit(1)).alias("samples"))
        .filter(_seconds(now) - _seconds(F.col("since")) >= hold_seconds)
    )


def select_topics(df: DataFrame, pattern: str, topic: str = "topic") -> DataFrame:
    """Rows whose whole topic name matches a regular expression."""
    return df.filter(F.col(topic).rlike(f"^(?:{pattern})$"))


def silent_pipeline(activity: DataFrame, runs: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Windows with traffic in which no run started."""
    busy = (
        activity.groupBy(F.window("ts", width).alias("_w"))
        .agg(F.count(F.lit(1)).alias("messages"))
        .select(F.col("_w.start").alias("window_start"), "messages")
    )
    started = runs.select(F.window("ts", width)["start"].alias("window_start")).distinct()
    return busy.join(started, "window_start", "left_anti")
