"""Landing of live feeds: every message once, however late it arrives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.monitor import topic_rate
from tidemark.sources.changes import MESSAGE
from tidemark.sources.envelopes import type_messages, write_landing
from tidemark.spec import DomainSpec

_BATCH = "batch"
#: Directory, beside the batches, of the offsets that each batch holds.
_RANGES = "_ranges"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """What earlier batches wrote; None before the first."""
    try:
        return spark.read.schema(f"{schema}, {_BATCH} long").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _unseen(rows: DataFrame, root: str, batch_id: int) -> DataFrame:
    """One row of each message that no other batch has landed; rows without offset all stay.

    The offsets of a batch are kept as one range per topic and partition.  Only batches whose
    ranges meet this one's are read, so a lagging partition opens its own past, not all.
    """
    spark, name = rows.sparkSession, [c for c in MESSAGE if c in rows.columns]
    places = [c for c in name if c != "kafka_offset"]
    kinds = dict(rows.dtypes)
    ranges = rows.groupBy(*places).agg(F.min("kafka_offset").alias("low"), F.max("kafka_offset").alias("high"))
    ranges.write.mode("overwrite").parquet(f"{root}/{_RANGES}/{_BATCH}={batch_id}")
    stored = ", ".join([*(f"{c} {kinds[c]}" for c in places), "low long", "high long"])
    ranges = _read(spark, f"{root}/{_RANGES}", stored)
    mine, others = (ranges.filter(F.col(_BATCH) == batch_id), ranges.filter(F.col(_BATCH) != batch_id))
    meet = (F.col("a.low") <= F.col("b.high")) & (F.col("b.low") <= F.col("a.high"))
    for c in places:
        meet = meet & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    met = others.alias("a").join(mine.alias("b"), meet, "left_semi").select(_BATCH).distinct()
    batches = sorted(r[0] for r in met.collect())  # one number a batch

    named = rows.filter(F.col("kafka_offset").isNotNull()).withColumns({f"_{c}": F.col(c) for c in name})
    new = named.dropDuplicates([f"_{c}" for c in name])
    if batches:
        before = _read(spark, root, ", ".join(f"{c} {kinds[c]}" for c in name))
        seen = before.filter(F.col(_BATCH).isin(batches)).select(*[F.col(c).alias(f"_seen_{c}") for c in name])
        known = F.lit(True)
        for c in name:
            known = known & F.col(f"_{c}").eqNullSafe(F.col(f"_seen_{c}"))
        new = new.join(seen, known, "left_anti")
    return new.drop(*[f"_{c}" for c in name]).unionByName(rows.filter(F.col("kafka_offset").isNull()))


def run_dedup(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each message of a feed once, in one directory per batch.

    A batch meets the messages that have landed before in an anti-join, for which only
    batches with offsets in the same ranges are read.  No state is kept and nothing
    expires, so a message that comes hours late is landed and its copies are not.  A
    batch that is written again replaces its own directory.  Rows without offset cannot be
    told apart and are all landed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _unseen(batch, path, batch_id).write.mode("overwrite").parquet(f"{path}/{_BATCH}={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_landing(
    stream: DataFrame, specs: Sequence[DomainSpec], root: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Land a mixed feed of envelopes, typed, with a directory per batch and domain.

    A batch is read, parsed and written once, whatever its domains; messages that cannot be
    landed go to the rejects.  A batch that comes again replaces what it wrote.  Landing is a
    history of deliveries, copies included; with ``once`` each message is landed once, as by
    :func:`run_dedup`.  Read it with ``read_landing`` and ``read_rejects``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _unseen(batch, root, batch_id) if once else batch
        write_landing(type_messages(rows, specs), f"{root}/{_BATCH}={batch_id}", specs)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_topic_rate(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add up messages and bytes per topic and minute, whenever they arrive.

    Counts are additive: each batch writes its own part of every window it has rows for,
    late or not, and :func:`read_topic_rate` adds the parts.  No window waits for a
    watermark, and none is closed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        topic_rate(batch).write.mode("overwrite").parquet(f"{path}/{_BATCH}={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_topic_rate(spark: SparkSession, path: str) -> DataFrame:
    """All windows so far, open ones included."""
    return (
        spark.read.parquet(path)
        .groupBy("topic", "window_start")
        .agg(F.sum("messages").alias("messages"), F.sum("bytes").alias("bytes"))
    )
