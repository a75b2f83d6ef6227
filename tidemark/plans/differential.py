"""``payments_by_status`` kept up to date by signed differences.

Each batch of changes is turned into what it takes away (-1 per row that it replaces or
deletes) and what it adds (+1 per row that is now current).  Only these differences are
stored; every number of the report is a sum over them, so updates, deletes and late rows
subtract as exactly as inserts add.

| stored per batch | rows | read back by |
|---|---|---|
| ``changes``  | a row per changed event, by bucket of its key | a batch: buckets of its keys |
| ``pairs``    | events of each changed (stage, payment)        | a batch: buckets of its payments |
| ``totals``   | events and payments per stage                  | the report |
| ``days``     | events per stage and day                       | the report |
| ``instants`` | events per stage and instant, by day           | the report: first and last days |

Counting instants, and not keeping a first and a last one, is what lets the newest event be
taken back.  A batch that is written again replaces its own part, and sees only the parts of
batches with lower numbers.
"""

from __future__ import annotations


from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import TRACE_COLUMNS, is_delete, ratio
from tidemark.operators.bronze import dedup_latest

_EVENT = (
    "event_id string, op string, source_ts_ms long, kafka_offset long, kafka_partition int, "
    "event_name string, payment_id string, event_timestamp timestamp_ntz"
)
_COUNTED = ("op", "event_name", "payment_id", "event_timestamp")
_STORED = {
    "changes": f"{_EVENT}, bucket int",
    "pairs": "event_name string, payment_id string, events long, bucket int",
    "totals": "event_name string, eventos long, pagamentos long",
    "days": "event_name string, day date, events long",
    "instants": "event_name string, event_timestamp timestamp_ntz, events long, day date",
}


class PaymentsByStatus:
    """The stored differences under ``root``; ``buckets`` is fixed for a root."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root, buckets

    def _part(self, name: str, batch: int) -> str:
        return f"{self.root}/{name}/batch={batch}"

    def _read(self, name: str, before: int | None = None) -> DataFrame:
        schema = f"{_STORED[name]}, batch long"
        try:
            stored = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = self.spark.createDataFrame([], schema)
        return stored if before is None else stored.filter(F.col("batch") < before)

    def _bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int").alias("bucket")

    def _touched(self, stored: DataFrame, rows: DataFrame, key: str) -> DataFrame:
        """Stored rows of the keys of ``rows``: other buckets are not opened."""
        numbers = [r[0] for r in rows.select("bucket").distinct().collect()]  # ``buckets`` at most
        return stored.filter(F.col("bucket").isin(numbers)).join(rows.select(key).distinct(), key, "left_semi")

    def apply(self, history: DataFrame, batch: int) -> None:
        """Take in change rows of payment events, in any order of versions."""
        names = [field.split()[0] for field in _EVENT.split(", ")]
        incoming = dedup_latest(history.filter("event_id IS NOT NULL"), "event_id")
        incoming = incoming.select(*names, self._bucket("event_id"))
        self._write(incoming, "incoming", batch)  # read three times below
        incoming = self.spark.read.schema(_STORED["changes"]).parquet(self._part("incoming", batch))
        past = self._touched(self._read("changes", batch), incoming, "event_id")
        old = dedup_latest(past, "event_id", (*TRACE_COLUMNS, "batch")).drop("batch")
        image = F.struct(*_COUNTED)
        candidates = incoming.withColumn("_new", F.lit(True)).unionByName(old.withColumn("_new", F.lit(False)))
        # of equal versions the stored one stays
        ranked = dedup_latest(candidates.withColumn("_stays", F.expr("int(NOT _new)")), "event_id", (*TRACE_COLUMNS, "_stays"))
        won = ranked.filter("_new").drop("_new", "_stays")
        self._write(won, "changes", batch, "bucket")
        won = self.spark.read.schema(_STORED["changes"]).parquet(self._part("changes", batch))

        replaced = old.join(won.select("event_id"), "event_id", "left_semi")
        signed = (
            replaced.select(F.lit(-1).alias("sign"), image.alias("row"))
            .unionByName(won.select(F.lit(1).alias("sign"), image.alias("row")))
            .select("sign", "row.*")
            .filter(~is_delete("op") & F.col("payment_id").isNotNull())
        )
        instants = _sums(signed, "event_name", "event_timestamp").withColumn("day", F.to_date("event_timestamp"))
        self._write(instants.filter("event_timestamp IS NOT NULL"), "instants", batch, "day")
        self._write(_sums(signed, "event_name", F.to_date("event_timestamp").alias("day")), "days", batch)

        pairs = _sums(signed, "event_name", "payment_id").withColumn("bucket", self._bucket("payment_id"))
        self._write(pairs, "pairs", batch, "bucket")
        pairs = self.spark.read.schema(_STORED["pairs"]).parquet(self._part("pairs", batch))
        before = self._touched(self._read("pairs", batch), pairs, "payment_id")
        both = pairs.select("event_name", "payment_id", F.lit(0).alias("_before"), "events").unionByName(
            before.select("event_name", "payment_id", F.col("events").alias("_before"), F.lit(0).alias("events"))
        )
        moved = both.groupBy("event_name", "payment_id").agg(F.sum("_before").alias("_before"), F.sum("events").alias("_change"))
        present = F.expr("int(_before + _change > 0) - int(_before > 0)").cast("long")
        totals = moved.groupBy("event_name").agg(F.sum("_change").alias("eventos"), F.sum(present).alias("pagamentos"))
        self._write(totals, "totals", batch)

    def _write(self, rows: DataFrame, name: str, batch: int, by: str | None = None) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(self._part(name, batch))

    def report(self) -> DataFrame:
        """Volume per stage and its share of all events, as :func:`payments_by_status`."""
        volume = self._read("totals").groupBy("event_name").agg(
            F.sum("eventos").alias("eventos"), F.sum("pagamentos").alias("pagamentos")
        ).filter("eventos > 0")
        total = volume.agg(F.sum("eventos")).scalar()
        days = self._read("days").groupBy("event_name", "day").agg(F.sum("events").alias("events"))
        edges = days.filter("events > 0").groupBy("event_name").agg(F.min("day").alias("_a"), F.max("day").alias("_b"))
        edges = edges.select(F.explode(F.array("_a", "_b")).alias("day")).distinct()
        # a stage's first instant lies in its first day; other stages' days change nothing
        near = self._read("instants").join(F.broadcast(edges), "day", "left_semi")  # two days a stage
        near = near.groupBy("event_name", "event_timestamp").agg(F.sum("events").alias("events")).filter("events > 0")
        ends = near.groupBy(F.col("event_name").alias("_name")).agg(
            F.min("event_timestamp").alias("primeiro_evento"), F.max("event_timestamp").alias("ultimo_evento")
        )
        return volume.join(ends, F.col("event_name").eqNullSafe(F.col("_name")), "left").select(
            "event_name", "eventos", "pagamentos", ratio(F.col("eventos"), total, 100).alias("pct_dos_eventos"),
            "primeiro_evento", "ultimo_evento",
        )


def _sums(signed: DataFrame, *by) -> DataFrame:
    """Differences per group; those that cancel out are not kept."""
    return signed.groupBy(*by).agg(F.sum("sign").alias("events")).filter("events <> 0")


def apply_all(target: PaymentsByStatus, batches: list[DataFrame]) -> PaymentsByStatus:
    for number, history in enumerate(batches):
        target.apply(history, number)
    return target
