"""Join shapes that keep fact rows whole and survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import TRACE_COLUMNS
from tidemark.operators.bronze import dedup_latest, present

#: Parts a hot join key is spread over; the small side is repeated this many times.
SALTS = 16


def dedup_dimension(
    df: DataFrame, business_key: str, order: Sequence[str] = TRACE_COLUMNS
) -> DataFrame:
    """One registry row per business key, so that a join cannot multiply facts."""
    return dedup_latest(present(df, business_key), business_key, order)


def left_join_flag(fact: DataFrame, dim: DataFrame, key: str, flag: str) -> DataFrame:
    """Keep every fact row; ``flag`` is true where the dimension has no such key."""
    marked = dim.withColumn("_known", F.lit(True))
    return (
        fact.join(marked, key, "left")
        .withColumn(flag, F.col("_known").isNull())
        .drop("_known")
    )


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    spread: Column,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join whose big side may hold a third of its rows under one key.

    Rows of ``big`` go to one of ``salts`` parts by ``spread``, and ``small`` is
    repeated once per part, so each pair still meets exactly once.
    """
    part = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", part).join(repeated, [key, "_salt"], how).drop("_salt")


def bridge_pairs(bridge: DataFrame, fact_key: str, group_key: str) -> DataFrame:
    """Distinct complete ``(group, id)`` pairs of a bridge table."""
    return present(bridge.select(group_key, fact_key), [group_key, fact_key]).distinct()


def bridge_aggregate(
    fact: DataFrame, bridge: DataFrame, fact_key: str, group_key: str, sums: Sequence[str]
) -> DataFrame:
    """Sum per-id columns per group through a many-to-many id bridge.

    ``fact`` holds one row per ``fact_key``, so the join meets pre-aggregated rows
    only.  The bridge is not reduced to one id per group: every id of a person counts.
    """
    return sum_over_pairs(fact, bridge_pairs(bridge, fact_key, group_key), fact_key, group_key, sums)


def sum_over_pairs(
    fact: DataFrame, pairs: DataFrame, fact_key: str, group_key: str, sums: Sequence[str]
) -> DataFrame:
    """:func:`bridge_aggregate` over the distinct pairs of the bridge."""
    return (
        fact.join(pairs, fact_key)
        .groupBy(group_key)
        .agg(*[F.sum(name).alias(name) for name in sums])
    )


def bridge_distinct(
    fact: DataFrame,
    bridge: DataFrame,
    fact_key: str,
    group_key: str,
    value: str,
    alias: str,
    salts: int = SALTS,
) -> DataFrame:
    """Exact distinct values per group through a many-to-many id bridge.

    Facts shrink to one row per ``(id, value)`` first.  A group with a single id takes
    that id's count; only groups with several ids have to unite the values themselves
    (:func:`united_distinct`).
    """
    pairs = bridge_pairs(bridge, fact_key, group_key)
    values = present(fact.select(fact_key, value), [fact_key, value]).distinct()
    per_id = values.groupBy(fact_key).agg(F.count(F.lit(1)).alias(alias))
    one_id = (
        pairs.groupBy(group_key)
        .agg(F.count(F.lit(1)).alias("_ids"), F.min(fact_key).alias(fact_key))
        .filter("_ids = 1")
    )
    simple = one_id.join(per_id, fact_key).select(group_key, alias)
    return simple.unionByName(
        united_distinct(values, pairs, fact_key, group_key, value, alias, salts)
    )


def united_distinct(
    values: DataFrame,
    pairs: DataFrame,
    fact_key: str,
    group_key: str,
    value: str,
    alias: str,
    salts: int = SALTS,
) -> DataFrame:
    """Distinct values of the groups that have several ids.

    ``values`` holds distinct ``(id, value)`` rows, ``pairs`` distinct ``(group, id)``
    rows.  A hot id is salted by value, and ``(group, value)`` pairs are reduced before
    they are counted, so no task receives a whole hot group.
    """
    several = (
        pairs.groupBy(group_key)
        .agg(F.count(F.lit(1)).alias("_ids"))
        .filter("_ids > 1")
        .select(group_key)
    )
    return (
        salted_join(
            values, pairs.join(several, group_key, "left_semi"), fact_key, F.col(value), salts=salts
        )
        .select(group_key, value)
        .distinct()
        .groupBy(group_key)
        .agg(F.count(F.lit(1)).alias(alias))
    )
