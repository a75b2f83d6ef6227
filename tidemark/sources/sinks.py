"""Upserts into catalog tables whose format can MERGE.

Plain Parquet cannot; for it :class:`tidemark.sources.tables.StoredTable` writes the whole
table anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import TRACE_COLUMNS
from tidemark.operators.bronze import dedup_latest


def not_older(order: Sequence[str], incoming: str = "source", stored: str = "target") -> Column:
    """Whether the incoming version is at least the stored one; NULL is the least value."""
    decided = F.lit(True)
    for name in reversed(order):
        new, old = F.col(f"{incoming}.{name}"), F.col(f"{stored}.{name}")
        newer = F.coalesce(new > old, new.isNotNull() & old.isNull())
        decided = newer | (new.eqNullSafe(old) & decided)
    return decided


def merge_into(
    updates: DataFrame, table: str, key: str | Sequence[str], order: Sequence[str] = TRACE_COLUMNS
) -> None:
    """Insert new keys and replace older versions in a catalog table.

    The batch is reduced to one row per key first; the rest is one MERGE of the table's
    own format, with its own commit and its own pruning.
    """
    keys = [key] if isinstance(key, str) else list(key)
    batch = dedup_latest(updates, keys, order) if order else updates
    same = reduce(
        lambda a, b: a & b, (F.col(f"source.{k}") == F.col(f"target.{k}") for k in keys)
    )
    versions = [name for name in order if name in updates.columns]
    (
        batch.alias("source")
        .mergeInto(f"{table} AS target" if " " not in table else table, same)
        .whenMatched(not_older(versions))
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
