"""Live monitors that wait for what is late, and notice what does not come."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def _append(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        frame.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def silent_windows(
    activity: DataFrame, runs: DataFrame, width: str = "15 minutes", delay: str = "1 hour"
) -> DataFrame:
    """Windows with traffic in which no run started, from two streams with an instant ``ts``.

    Both are counted together, so there is one store of state a task, with a row per open
    window; counting each and joining them would keep six, and what a batch takes is mostly
    their commits.  A window is shown when both watermarks have passed its end, so rows up to
    ``delay`` late on either side count; a run that comes later than that cannot take an alarm
    back.  A stream that stops holds its watermark back: both need a row now and then (a heartbeat).
    """
    busy, started = (
        rows.select("ts", F.lit(kind).alias("_run")).withWatermark("ts", delay)
        for rows, kind in ((activity, False), (runs, True))
    )
    counted = busy.unionAll(started).groupBy(F.window("ts", width).alias("window")).agg(
        F.count_if(~F.col("_run")).alias("messages"), F.count_if("_run").alias("runs")
    )
    return counted.filter("runs = 0").select(F.col("window.start").alias("window_start"), "messages")


def run_silent_pipeline(
    activity: DataFrame, runs: DataFrame, path: str, checkpoint: str, width: str = "15 minutes", delay: str = "1 hour"
) -> StreamingQuery:
    """Append each silent window once."""
    return _append(silent_windows(activity, runs, width, delay), path, checkpoint)


RATES = (
    "topic string, sampled_at timestamp, increase double, per_second double, "
    "firing boolean, silent boolean"
)
_STATE = (
    "last_ms bigint, last_value double, breach_ms bigint, shown_silent boolean, "
    "waiting_ms array<bigint>, waiting_values array<double>"
)


def counter_rates(
    samples: DataFrame, least: float, hold_seconds: int, silence_seconds: int, delay: str = "1 hour"
) -> DataFrame:
    """Per-second rates of cumulative counters, with alerts, from a stream of samples.

    ``samples`` has ``topic``, ``sampled_at`` (an instant) and ``value``.  A topic keeps its
    last sample from batch to batch, so the first rate of a batch is right; a value below its
    predecessor means a counter that began again.  Samples wait until the watermark has passed
    them and are then taken in order, so those up to ``delay`` late count in their place.

    ``firing``: the rate has been below ``least`` for ``hold_seconds`` without a break.
    ``silent``: ``silence_seconds`` have passed without a sample, as a timer per topic or the
    next sample shows, whichever comes first; one row per silence, dated by its event time, so
    results do not depend on how the feed is cut into batches.
    State per topic is one sample and those that wait.
    """

    silence = silence_seconds * 1000

    def advance(key: tuple, batches: Iterator, state) -> Iterator:
        import pandas as pd

        last, value, breach, shown, ms, values = (
            state.get if state.exists else (None, None, None, False, [], [])
        )
        waiting = list(zip(ms, values))
        for batch in batches if not state.hasTimedOut else ():
            waiting += zip((batch["ms"]).tolist(), batch["value"].tolist())
        # at first there is no watermark and nothing is in order yet
        watermark = state.getCurrentWatermarkMs()
        ready = sorted(w for w in waiting if w[0] <= watermark)
        waiting = [w for w in waiting if w[0] > watermark]
        rows = []
        for at, current in ready:
            if last is not None and not shown and at - last >= silence:
                rows.append((key[0], last + silence, None, None, None, True))
            if last is not None:
                increase = current if current < value else current - value
                per_second = increase / ((at - last) / 1000.0) if at > last else None
                low = per_second is not None and per_second < least
                breach = (at if breach is None else breach) if low else None
                firing = breach is not None and at - breach >= hold_seconds * 1000
                rows.append((key[0], at, increase, per_second, firing, False))
            last, value, shown = at, current, False
        if last is not None and not shown and watermark >= last + silence:
            rows.append((key[0], last + silence, None, None, None, True))
            shown = True
        state.update((last, value, breach, shown, [w[0] for w in waiting], [w[1] for w in waiting]))
        timers = [w[0] for w in waiting] + ([] if shown or last is None else [last + silence])
        if timers:
            state.setTimeoutTimestamp(max(min(timers), watermark + 1))
        if not rows:
            return
        found = pd.DataFrame(rows, columns=["topic", "sampled_at", "increase", "per_second", "firing", "silent"])
        found["sampled_at"] = pd.to_datetime(found["sampled_at"], unit="ms", utc=True)
        yield found.astype({"increase": "float64", "per_second": "float64", "firing": "boolean", "silent": "bool"})

    timed = samples.withWatermark("sampled_at", delay).select(
        "topic", "sampled_at", F.unix_millis("sampled_at").alias("ms"), F.col("value").cast("double").alias("value")
    )
    return timed.groupBy("topic").applyInPandasWithState(advance, RATES, _STATE, "append", "EventTimeTimeout")


def run_counter_rate(
    samples: DataFrame, path: str, checkpoint: str, least: float, hold_seconds: int, silence_seconds: int,
    delay: str = "1 hour",
) -> StreamingQuery:
    """Append rates and silences as they become certain; see :func:`counter_rates`."""
    return _append(counter_rates(samples, least, hold_seconds, silence_seconds, delay), path, checkpoint)


def read_counter_rate(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RATES).parquet(path)
