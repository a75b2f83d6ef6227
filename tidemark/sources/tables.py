"""Keyed tables in plain Parquet.

A write is one Spark job that leaves a new directory beside the ones before::

    <path>/v00000007/part-*.parquet, _SUCCESS

Spark writes ``_SUCCESS`` last, so a reader, who takes the newest directory that has one,
sees the old or the new table, and a job that dies leaves nothing visible.  Older directories
stay for readers that began before, until someone removes them.  One writer at a time.

A merge reads and writes the whole table.  Where batches are small and tables are not, use a
format that can MERGE, by :func:`tidemark.sources.sinks.merge_into`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import TRACE_COLUMNS
from tidemark.operators.bronze import dedup_latest
from tidemark.operators.merge import merge_insert_missing, remove_keys, sync_columns


class StoredTable:
    """One keyed table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key

    # ---------------------------------------------------------------- reading
    def version(self) -> int:
        """Number of the newest complete directory; 0 for a table never written."""
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v*/_SUCCESS")
        found = done.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(done)
        return max((int(f.getPath().getParent().getName()[1:]) for f in found or ()), default=0)

    def exists(self) -> bool:
        return self.version() > 0

    def _place(self, version: int) -> str:
        return f"{self.path}/v{version:08d}"

    def read(self) -> DataFrame:
        """The whole table as it is now."""
        version = self.version()
        if not version:
            raise FileNotFoundError(f"no complete table at {self.path}")
        return self.spark.read.parquet(self._place(version))

    # ---------------------------------------------------------------- writing
    def overwrite(self, df: DataFrame) -> None:
        """Replace the whole table."""
        df.write.mode("overwrite").parquet(self._place(self.version() + 1))

    def merge(self, updates: DataFrame, order: Sequence[str] = TRACE_COLUMNS) -> None:
        """Insert new keys, replace older versions.

        Columns follow ``updates``: a new one is NULL in stored rows, one that is missing
        leaves the table.  Stored and incoming rows of a key meet in one shuffle, before which
        each task keeps its best row per key.  Applying the same batch again changes nothing,
        so a stream may replay it after a failure.  With an empty ``order`` incoming rows
        always win; they must be unique.
        """
        rows = updates.withColumn("_incoming", F.lit(1))
        if self.exists():
            stored = sync_columns(self.read(), updates).withColumn("_incoming", F.lit(0))
            rows = stored.unionByName(rows)
        self.overwrite(dedup_latest(rows, self.key, [*order, "_incoming"]).drop("_incoming"))

    def insert_missing(self, source: DataFrame) -> None:
        """Add rows whose key is absent."""
        new = source.dropDuplicates([self.key])
        self.overwrite(merge_insert_missing(sync_columns(self.read(), source), new, self.key) if self.exists() else new)

    def remove(self, keys: DataFrame) -> None:
        """Delete the listed keys."""
        if self.exists():
            self.overwrite(remove_keys(self.read(), keys, self.key))


def append_rows(df: DataFrame, path: str) -> None:
    """Append audit or log rows to a plain Parquet directory."""
    df.write.mode("append").parquet(path)
