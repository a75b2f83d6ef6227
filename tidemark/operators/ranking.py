"""Ranks over a whole table, without one task that holds it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.workdir import shared_dir


def global_rank(df: DataFrame, *order: str, name: str = "rank") -> tuple[DataFrame, int]:
    """``df`` with each row's place by ``order`` (from 1), and the number of rows.

    Rows are sorted over all tasks and written once; what each task holds is counted, and the
    counts before a task (one number a task) give where its rows begin.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
        .write.parquet(path)
    )
    placed = spark.read.parquet(path)
    counts = placed.groupBy("_task").agg(F.min("_at"), F.count(F.lit(1))).orderBy("_task").collect()
    shifts, before = [], 0
    for task, first, rows in counts:
        shifts.append((task, before - first + 1))
        before += rows
    begins = spark.createDataFrame(shifts, "_task int, _shift long")
    ranked = placed.join(F.broadcast(begins), "_task")  # a row per task
    return ranked.withColumn(name, F.col("_at") + F.col("_shift")).drop("_task", "_at", "_shift"), before
