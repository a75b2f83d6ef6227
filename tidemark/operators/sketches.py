"""Counts that are kept as small mergeable sketches, with an exact answer where one is due."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a distinct-count sketch: 2 ** LG registers, a standard error of about 0.65 percent.
LG = 14


def distinct_sketches(facts: DataFrame, by: Sequence[str], values: Sequence[str], lg: int = LG) -> DataFrame:
    """One sketch per group and value column; few distinct values make small sketches."""
    return facts.groupBy(*by).agg(*[F.hll_sketch_agg(v, lg).alias(v) for v in values])


def append_sketches(sketches: DataFrame, path: str, batch: int) -> None:
    """Store a batch's sketches; one that is written again replaces its own."""
    sketches.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_distinct(spark: SparkSession, path: str, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Estimates over all stored batches, by some or none of the stored groups.

    Merging counts what several batches, days or groups share once.  Facts that are taken
    back are not: recount their groups.
    """
    merged = spark.read.parquet(path).groupBy(*by).agg(*[F.hll_union_agg(v).alias(v) for v in values])
    return merged.select(*by, *[F.hll_sketch_estimate(v).alias(v) for v in values])


def heavy_sketches(facts: DataFrame, by: Sequence[str], item: str, tracked: int) -> DataFrame:
    """One sketch of the most frequent items per group."""
    return facts.groupBy(*by).agg(F.expr(f"approx_top_k_accumulate(`{item}`, {tracked})").alias("sketch"))


def top_items(facts: DataFrame, sketches: DataFrame, item: str, k: int, tracked: int) -> DataFrame:
    """The ``k`` most frequent items with their exact counts; equal counts go by name.

    The merged sketches name at most ``tracked`` candidates, whose rows alone are counted.  An
    item that a sketch has lost occurs in at most 3.5 / ``tracked`` of all rows; if the k-th
    candidate is no more frequent than that, all items are counted instead.
    """
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("_s"))
    found = merged.select(F.inline(F.expr(f"approx_top_k_estimate(_s, {tracked})")))
    candidates = found.select(F.col("item").alias(item))
    named = facts.filter(F.col(item).isNotNull())
    near = named.join(F.broadcast(candidates), item, "left_semi")  # ``tracked`` rows
    best = _counted(near, item, k)
    rows, least, n = named.agg(F.count(F.lit(1))).first()[0], *best.agg(F.min("n"), F.count("n")).first()
    if n == k and least > 3.5 * rows / tracked:
        return best
    return _counted(named, item, k)


def _counted(rows: DataFrame, item: str, k: int) -> DataFrame:
    return rows.groupBy(item).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), item).limit(k)
