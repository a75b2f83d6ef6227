"""Change history -> current state, per contract strategy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import TRACE_COLUMNS, is_delete, version_struct
from tidemark.operators.bronze import dedup_latest, drop_tombstones
from tidemark.spec import STRATEGIES, Contract


def resolve_cdc(
    df: DataFrame,
    strategy: str,
    key: str,
    order: Sequence[str] = TRACE_COLUMNS,
) -> DataFrame:
    """Apply one strategy to a change history.

    ``upsert``  newest version per key, unless that version is a delete
    ``append``  every row but deletes
    ``log``     every row

    Rows without a key go away in all three.  For ``upsert`` that filter runs before
    the ranking, which cannot change a winner (the key is the ranking partition) and
    keeps tombstones from piling up in one NULL group.  The delete filter runs after
    it: filtering deletes first would bring deleted keys back.
    """
    if strategy not in STRATEGIES:
        raise ValueError(
            f"unknown cdc strategy {strategy!r}; expected one of {', '.join(STRATEGIES)}"
        )
    keyed = drop_tombstones(df, key)
    if strategy == "log":
        return keyed
    current = dedup_latest(keyed, key, order) if strategy == "upsert" else keyed
    return current.filter(~is_delete())


def silver(changes: DataFrame, contract: Contract) -> DataFrame:
    """Current state of a normalised change feed under its contract."""
    return resolve_cdc(changes, contract.cdc_strategy, contract.unique_key)


def latest_versions(
    df: DataFrame, key: str, order: Sequence[str] = TRACE_COLUMNS
) -> DataFrame:
    """Newest row per key, deletes included, as one mergeable aggregation.

    Works on batch and streaming input; a stream keeps one row of state per key.
    """
    known = [name for name in order if name in df.columns]
    return (
        drop_tombstones(df, key)
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max_by(F.struct(*df.columns), version_struct(known)).alias("_row"))
        .select("_row.*")
    )


def resolve_latest_agg(
    df: DataFrame, key: str, order: Sequence[str] = TRACE_COLUMNS
) -> DataFrame:
    """Aggregate form of the ``upsert`` strategy."""
    return latest_versions(df, key, order).filter(~is_delete())
