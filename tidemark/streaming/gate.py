"""Arrival gate and landing of live feeds.

Offsets live in the query checkpoint, so a gate notices every row exactly once, in
whatever order domains produce them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.monitor import gate_log
from tidemark.sources.changes import route, write_routed


def run_gate(
    stream: DataFrame, domain: str, root: str, checkpoint: str
) -> StreamingQuery:
    """For every non-empty batch write one pending and one log row per domain seen.

    ``domain`` is the column naming the domain.  Rows land under ``root/pending_runs``
    and ``root/stream_consumption_log``, in one directory per batch, so a replayed
    batch replaces its own rows instead of adding them again.
    """

    def note(batch: DataFrame, batch_id: int) -> None:
        now = F.current_timestamp()
        seen = gate_log(batch, domain, now)
        seen.write.mode("overwrite").parquet(f"{root}/stream_consumption_log/batch={batch_id}")
        noted = batch.sparkSession.read.parquet(f"{root}/stream_consumption_log/batch={batch_id}")
        pending = noted.select(
            F.concat_ws("-", F.lit(batch_id), "domain").alias("row_id"),
            "domain",
            F.col("consumed_at").alias("detected_at"),
            F.lit(False).alias("consumed"),
        )
        pending.write.mode("overwrite").parquet(f"{root}/pending_runs/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(note)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_routing(
    stream: DataFrame, tables: Mapping[str, str], root: str, checkpoint: str, topic: str = "topic"
) -> StreamingQuery:
    """Append one mixed feed to one landing directory per table.

    Delivery is at least once: a batch that fails while writing is written again.
    """

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        write_routed(route(batch, tables, topic), root)

    return (
        stream.writeStream.foreachBatch(fan_out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
