"""Run logs and usage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import bucket_start
from tidemark.operators.merge import union_by_name

LAYERS = ("bronze", "silver", "gold")
GRAIN_SECONDS = {"HOUR": 3_600, "DAY": 86_400}


def _layer(model: Column) -> Column:
    layer = F.lit("other")
    for name in reversed(LAYERS):
        layer = F.when(model.startswith(f"{name}_"), name).otherwise(layer)
    return layer


def processing_log(
    results: DataFrame,
    row_counts: DataFrame,
    run_id: str,
    logged_at: Column,
    message_width: int | None = None,
) -> DataFrame:
    """One audit row per model of a run.

    ``results`` has one row per result (see ``read_run_results``), ``row_counts``
    the columns ``model`` and ``rows_processed``.  Nodes that are not models are left
    out.  The error text is kept whole unless the log column has a ``message_width``.
    """
    model = F.substring_index("unique_id", ".", -1)
    table = F.col("dbt_model")
    for prefix in LAYERS:
        table = F.replace(table, F.lit(f"{prefix}_"), F.lit(""))
    execute = F.try_element_at(
        F.filter("timing", lambda t: t["name"] == F.lit("execute")), F.lit(-1)
    )
    failed = F.col("status").isin("error", "fail")
    message = F.coalesce("message", F.lit(""))
    if message_width is not None:
        message = F.substring(message, 1, message_width)
    # made before the join, which then carries no text or times that the log does not keep
    audited = results.filter(F.col("unique_id").startswith("model.")).select(
        model.alias("dbt_model"),
        F.coalesce("invocation_id", F.lit("unknown")).alias("dbt_invocation_id"),
        F.when(F.col("status") == "success", "success").otherwise("error").alias("status"),
        execute["started_at"].cast("timestamp").alias("started_at"),
        execute["completed_at"].cast("timestamp").alias("finished_at"),
        F.round(F.coalesce("execution_time", F.lit(0.0)), 3).cast("decimal(10,3)").alias("duration_seconds"),
        F.when(failed, message).alias("error_message"),
    )
    return audited.join(row_counts.withColumnRenamed("model", "dbt_model"), "dbt_model", "left").select(
        table.alias("table_name"),
        _layer(F.col("dbt_model")).alias("layer"),
        "dbt_model",
        "dbt_invocation_id",
        F.lit(run_id).alias("run_id"),
        "status",
        F.coalesce("rows_processed", F.lit(0).cast("bigint")).alias("rows_processed"),
        "started_at",
        "finished_at",
        "duration_seconds",
        "error_message",
        F.lit("sensor").alias("triggered_by"),
        logged_at.alias("logged_at"),
    )


def layer_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every built table."""
    return union_by_name(
        [
            df.agg(F.count(F.lit(1)).alias("rows_processed")).select(
                F.lit(name).alias("model"), "rows_processed"
            )
            for name, df in tables.items()
        ]
    )


def usage_rollup(
    usage: DataFrame,
    ts: str,
    by: Sequence[str],
    measures: Mapping[str, Column],
    grain: str = "DAY",
    since: Column | None = None,
) -> DataFrame:
    """Usage per time bucket and label, optionally from an instant on."""
    recent = usage if since is None else usage.filter(F.col(ts) >= since)
    if dict(usage.dtypes)[ts] == "timestamp_ntz":
        period = bucket_start(ts, GRAIN_SECONDS[grain])
    else:
        period = F.date_trunc(grain, ts)
    return recent.groupBy(period.alias("period"), *by).agg(
        *[measure.alias(name) for name, measure in measures.items()],
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
    )
