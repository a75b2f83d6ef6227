"""Landing rows -> one normalised, latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import TRACE_COLUMNS
from tidemark.spec import DomainSpec


def flatten_metadata(df: DataFrame, column: str = "RECORD_METADATA") -> DataFrame:
    """Replace the record-metadata struct by three typed columns."""
    meta = F.col(column)
    return df.withColumns(
        {
            "kafka_offset": meta["offset"].cast("bigint"),
            "kafka_partition": meta["partition"].cast("int"),
            "kafka_created_at": meta["CreateTime"].cast("bigint"),
        }
    ).drop(column)


def project_aliases(df: DataFrame, spec: DomainSpec) -> DataFrame:
    """Bronze projection of a landing table whose metadata is already flat."""
    return df.select(
        *spec.payload(),
        F.col("__OP").alias("op"),
        F.col("__SOURCE_TS_MS").cast("bigint").alias("source_ts_ms"),
        "kafka_offset",
        "kafka_partition",
        "kafka_created_at",
    )


def drop_tombstones(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows without a key are compaction artefacts, never data."""
    return present(df, key)


def present(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Rows with a value in every one of the columns.

    Plain ``IS NOT NULL`` predicates, which reach the scan; ``na.drop`` does not.
    """
    for name in [columns] if isinstance(columns, str) else columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def above_watermark(
    df: DataFrame, target: DataFrame, column: str = "kafka_created_at"
) -> DataFrame:
    """Rows that arrived strictly after everything ``target`` already holds.

    The high-water mark is a scalar subquery: one aggregated value, no join.  Strict
    comparison skips late rows that share the stamp; the streaming path relies on
    checkpointed offsets instead and has no such gap.
    """
    mark = target.agg(F.coalesce(F.max(column), F.lit(0).cast("bigint"))).scalar()
    return df.filter(F.col(column) > mark)


def dedup_latest(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str] = TRACE_COLUMNS
) -> DataFrame:
    """One row per key: the greatest ``order`` tuple, NULLs last.

    ``row_number() = 1`` lets Catalyst keep only the best row per key *before* the
    shuffle, so a key holding a large share of the rows reaches its reducer as at
    most one row per input task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest = [F.desc_nulls_last(name) for name in order if name in df.columns]
    best_first = Window.partitionBy(*keys).orderBy(*newest)
    return df.withColumn("_rank", F.row_number().over(best_first)).filter("_rank = 1").drop("_rank")


def normalise(changes: DataFrame, spec: DomainSpec) -> DataFrame:
    """Landing form -> typed change rows, tombstones removed, history kept."""
    flat = project_aliases(flatten_metadata(changes), spec)
    return drop_tombstones(flat, spec.key)


def bronze(changes: DataFrame, spec: DomainSpec, target: DataFrame | None = None) -> DataFrame:
    """Latest row per key of a landing batch, deletes included.

    With ``target`` only rows above its arrival watermark are considered.
    """
    rows = normalise(changes, spec)
    if target is not None:
        rows = above_watermark(rows, target)
    return dedup_latest(rows, spec.key)
