"""Aggregation pieces shared by the reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ratio


def pivot_first(
    df: DataFrame, key: str, stage: str, ts: str, columns: Mapping[str, str]
) -> DataFrame:
    """First instant of each declared stage as a column; ``columns`` maps stage to name."""
    return df.groupBy(key).agg(
        *[
            F.min(F.when(F.col(stage) == name, F.col(ts))).alias(alias)
            for name, alias in columns.items()
        ]
    )


def share_of_total(df: DataFrame, key: str, count: str = "n", share: str = "pct") -> DataFrame:
    """Rows per group and their percentage of all rows.

    The grand total adds up the grouped counts; both read the same shuffle.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    total = counted.agg(F.sum(count)).scalar()
    return counted.withColumn(share, ratio(F.col(count), total, 100))


def changed_keys(
    facts: DataFrame,
    target: DataFrame,
    key: str,
    moment: str,
    target_count: str,
    target_moment: str,
) -> DataFrame:
    """Keys whose fact history no longer equals what ``target`` recorded.

    A key is listed when it is ``new``, when its row count differs (``count``), when
    its newest moment differs (``moment``), or when all its facts are gone
    (``vanished``).  Comparing per key, and by count first, notices events that
    arrive out of order.  Both sides are reduced to one row per key before they meet.
    """
    now = (
        facts.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.max(moment).alias("_m"))
    )
    known = target.select(
        key, F.col(target_count).alias("_tn"), F.col(target_moment).alias("_tm")
    )
    reason = change_reason(F.col("_n"), F.col("_m"), F.col("_tn"), F.col("_tm"))
    return (
        now.join(known, key, "full")
        .select(key, reason.alias("change"))
        .filter(F.col("change").isNotNull())
    )


def change_reason(
    count: Column, moment: Column, known_count: Column, known_moment: Column
) -> Column:
    """Why a key's summary differs from the stored one; NULL when it does not."""
    return (
        F.when(known_count.isNull(), "new")
        .when(count.isNull(), "vanished")
        .when(~count.eqNullSafe(known_count), "count")
        .when(~moment.eqNullSafe(known_moment), "moment")
    )
