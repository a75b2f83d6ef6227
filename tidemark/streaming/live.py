"""Live current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions import TRACE_COLUMNS, is_delete
from tidemark.operators.bronze import drop_tombstones
from tidemark.operators.resolve import latest_versions
from tidemark.sources.tables import StoredTable


def stream_latest(
    stream: DataFrame, key: str, order: Sequence[str] = TRACE_COLUMNS
) -> DataFrame:
    """Newest version per key of a live feed, deletes included.

    State is one row per key and is never expired: forgetting a key would let an older
    version win later.  Use the RocksDB state store when keys outgrow executor memory.
    """
    return latest_versions(stream, key, order)


def run_resolve(
    stream: DataFrame,
    target: StoredTable,
    checkpoint: str,
    order: Sequence[str] = TRACE_COLUMNS,
    stateful: bool = False,
) -> StreamingQuery:
    """Keep ``target`` at the newest version of every key, deletes included as markers.

    Without ``stateful`` each batch merges straight into the table: the version guard
    of the merge already makes late and repeated rows harmless, and no state grows.
    With it the stream itself keeps the newest version and only changed keys reach
    the merge.
    """
    source = stream_latest(stream, target.key, order) if stateful else stream

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = drop_tombstones(batch, target.key).persist()
        target.merge(rows, order)
        rows.unpersist()

    return (
        source.writeStream.outputMode("update" if stateful else "append")
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_state(target: StoredTable) -> DataFrame:
    """Live rows of a resolved table, delete markers removed."""
    return target.read().filter(~is_delete())
