"""Keyed merges as DataFrame expressions.

These return the new content of a table; :class:`tidemark.sources.tables.StoredTable`
writes it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import TRACE_COLUMNS
from tidemark.operators.bronze import dedup_latest


def sync_columns(target: DataFrame, incoming: DataFrame | StructType) -> DataFrame:
    """``target`` with exactly the columns of ``incoming``, a frame or a schema.

    New columns arrive as NULL, vanished ones are dropped.  A column that changes its
    type is an error: a silent cast could lose data.
    """
    old = {field.name: field.dataType for field in target.schema}
    wanted = incoming.schema if isinstance(incoming, DataFrame) else incoming
    for field in wanted:
        if field.name in old and old[field.name] != field.dataType:
            raise ValueError(
                f"column {field.name} changes type from "
                f"{old[field.name].simpleString()} to {field.dataType.simpleString()}"
            )
    return target.select(
        *[
            F.col(f"`{field.name}`")
            if field.name in old
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in wanted
        ]
    )


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str] = TRACE_COLUMNS,
) -> DataFrame:
    """Update matched keys, insert the others; an older version never wins.

    The batch is reduced to one row per key before it meets the target, so a key that
    dominates the batch costs one row afterwards.  On equal versions the incoming row
    wins, hence applying the same batch twice changes nothing.  With an empty
    ``order`` incoming rows always win; the batch must then hold one row per key.
    """
    batch = dedup_latest(updates, key, order) if order else updates
    both = (
        sync_columns(target, batch)
        .withColumn("_incoming", F.lit(0))
        .unionByName(batch.withColumn("_incoming", F.lit(1)))
    )
    return dedup_latest(both, key, [*order, "_incoming"]).drop("_incoming")


def merge_insert_missing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Add source rows whose key the target does not have; never touch existing rows."""
    absent = source.dropDuplicates([key]).join(target.select(key), key, "left_anti")
    return target.unionByName(absent.select(*target.columns))


def update_where(
    target: DataFrame, predicate: Column, assignments: Mapping[str, Column]
) -> DataFrame:
    """Assign columns on the rows that satisfy ``predicate``; all rows are kept."""
    types = dict(target.dtypes)
    return target.withColumns(
        {
            name: F.when(predicate, value.cast(types[name])).otherwise(F.col(name))
            for name, value in assignments.items()
        }
    )


def remove_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``target`` whose key is not listed in ``keys``."""
    return target.join(keys.select(key).distinct(), key, "left_anti")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames; columns missing on one side become NULL.

    Halves are joined pairwise, which keeps plans of many parts shallow.
    """
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    left, right = union_by_name(frames[:middle]), union_by_name(frames[middle:])
    return left.unionByName(right, allowMissingColumns=True)
