"""Data-quality checks.

A check returns its failing rows; an empty result passes.  Checks that look at one
row at a time can share a single pass over the table (:func:`column_suite`).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.bronze import present
from tidemark.operators.merge import union_by_name

#: Rows that a delete left without payload are outside a scoped check.
NOT_DELETED = "NOT (op <=> 'd')"


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def check_not_null(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Rows without a value, within the optional scope ``where``."""
    scoped = df if where is None else df.filter(where)
    return scoped.filter(F.col(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Non-null values outside the list, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def check_relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Non-null child values without a parent row, with their number of rows.

    Both sides shrink to one row per value before they meet.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = present(parent.select(F.col(parent_column).alias(column)), column).distinct()
    return values.join(known, column, "left_anti")


def reconcile(
    silver: DataFrame,
    gold: DataFrame,
    key: str = "payment_id",
    moment: str = "event_timestamp_ms",
    gold_count: str = "total_eventos",
    gold_moment: str = "ultimo_evento_ms",
) -> DataFrame:
    """Keys on which a report and the facts below it disagree, in both directions."""
    facts = (
        silver.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(gold_count), F.max(moment).alias(gold_moment))
    )
    return _disagreements(facts, gold, key, gold_count, gold_moment)


def _disagreements(
    facts: DataFrame, gold: DataFrame, key: str, count: str, moment: str
) -> DataFrame:
    """Keys of two summaries with the same columns that differ, and how."""
    facts = facts.select(key, F.col(count).alias("eventos_silver"), F.col(moment).alias("ultimo_ms_silver"))
    report = gold.select(
        key,
        F.col(count).alias("eventos_gold"),
        F.col(moment).alias("ultimo_ms_gold"),
        F.lit(True).alias("_reported"),
    )
    reason = (
        F.when(F.col("_reported").isNull(), "lacking")
        .when(F.col("eventos_silver").isNull(), "unfounded")
        .when(~F.col("eventos_silver").eqNullSafe(F.col("eventos_gold")), "count")
        .when(
            ~F.col("ultimo_ms_silver").eqNullSafe(F.col("ultimo_ms_gold")),
            "newest",
        )
    )
    return (
        facts.join(report, key, "full")
        .withColumn("motivo", reason)
        .filter(F.col("motivo").isNotNull())
        .drop("_reported")
    )


#: Parts of the keys whose digests are compared.
RANGES = 4096


def reconcile_by_digests(
    silver: DataFrame,
    gold: DataFrame,
    key: str = "payment_id",
    moment: str = "event_timestamp_ms",
    gold_count: str = "total_eventos",
    gold_moment: str = "ultimo_evento_ms",
    ranges: int = RANGES,
) -> DataFrame:
    """:func:`reconcile`, of which only parts of the keys that differ are joined.

    Both sides are reduced to a row per part: how many keys, and two sums of hashes of a
    key's count and newest moment, which do not depend on the order of rows.  Keys of parts
    that agree never meet; where all is well the report is not shuffled at all.
    """
    facts = (
        silver.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(gold_count), F.max(moment).alias(gold_moment))
    )
    report = gold.select(key, gold_count, gold_moment)
    part = F.pmod(F.xxhash64(key), F.lit(ranges)).alias("_part")

    def digests(rows: DataFrame, side: str) -> DataFrame:
        one = F.xxhash64(key, gold_count, gold_moment).cast("decimal(20,0)")
        two = F.xxhash64(gold_moment, gold_count, key)
        summed = F.struct(F.count(F.lit(1)).alias("n"), F.sum(one).alias("a"), F.bit_xor(two).alias("b"))
        return rows.groupBy(part).agg(summed.alias(side))

    both = digests(facts, "s").join(digests(report, "g"), "_part", "full")
    unlike = both.filter(~F.col("s").eqNullSafe(F.col("g"))).select("_part")  # ``ranges`` rows at most

    def of_unlike(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_part", part).join(F.broadcast(unlike), "_part", "left_semi").drop("_part")

    return _disagreements(of_unlike(facts), of_unlike(report), key, gold_count, gold_moment)


def check_backlog(pairs: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Domains whose distinct landed keys differ from their Bronze rows.

    ``pairs`` maps a name to ``(landing, bronze, key)``.  The keys of all domains become
    distinct in one step and are counted per domain in the next.
    """
    keys = union_by_name(
        [
            present(landing.select(F.col(key).cast("string").alias("_key")), "_key").select(
                F.lit(name).alias("dominio"), "_key"
            )
            for name, (landing, _, key) in pairs.items()
        ]
    )
    rows = union_by_name(
        [
            bronze.agg(F.count(F.lit(1)).alias("linhas_no_modelo")).select(
                F.lit(name).alias("dominio"), "linhas_no_modelo"
            )
            for name, (_, bronze, _) in pairs.items()
        ]
    )
    landed = keys.distinct().groupBy("dominio").agg(F.count(F.lit(1)).alias("chaves_no_landing"))
    joined = rows.join(landed, "dominio", "left").select(
        "dominio",
        F.coalesce("chaves_no_landing", F.lit(0).cast("bigint")).alias("chaves_no_landing"),
        "linhas_no_modelo",
    )
    backlog = F.col("chaves_no_landing") - F.col("linhas_no_modelo")
    return joined.withColumn("backlog", backlog).filter("backlog <> 0")


# ------------------------------------------------------------------- summaries
@dataclass(frozen=True)
class Check:
    """A named check with its severity and failing rows."""

    name: str
    severity: str
    failures: DataFrame

    def __post_init__(self) -> None:
        if self.severity not in ("error", "warn"):
            raise ValueError(f"unknown severity {self.severity!r}; expected error or warn")


def column_suite(
    df: DataFrame,
    table: str,
    not_null: Iterable[tuple[str, str | None]] = (),
    accepted: Iterable[tuple[str, Sequence[str], str]] = (),
) -> DataFrame:
    """All row-level checks of a table in one aggregation: ``(check, severity, failures)``.

    ``not_null`` holds ``(column, scope or None)``, ``accepted`` holds
    ``(column, values, severity)``.
    """
    measures: list[tuple[str, str, Column]] = []
    for column, scope in not_null:
        missing = F.col(column).isNull()
        failed = missing if scope is None else missing & F.expr(scope)
        measures.append((f"not_null_{table}_{column}", "error", failed))
    for column, values, severity in accepted:
        failed = F.col(column).isNotNull() & ~F.col(column).isin(*values)
        measures.append((f"accepted_values_{table}_{column}", severity, failed))
    counted = df.agg(*[F.count_if(failed).alias(f"m{i}") for i, (_, _, failed) in enumerate(measures)])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check"),
                F.lit(severity).alias("severity"),
                F.col(f"m{i}").alias("failures"),
            )
            for i, (name, severity, _) in enumerate(measures)
        ]
    )
    return counted.select(F.inline(rows))


def count_failures(checks: Sequence[Check]) -> DataFrame:
    """One ``(check, severity, failures)`` row per check."""
    return union_by_name(
        [
            check.failures.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(check.name).alias("check"),
                F.lit(check.severity).alias("severity"),
                "failures",
            )
            for check in checks
        ]
    )


def quality_summary(counted: DataFrame) -> DataFrame:
    """Add a verdict to counted checks: ``pass``, ``warn`` or ``error``."""
    verdict = F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    return counted.withColumn("status", verdict)


def enforce(summary: DataFrame) -> None:
    """Raise when a check of severity ``error`` has failures; warnings pass."""
    broken = summary.filter("status = 'error'").orderBy("check").collect()
    if broken:
        lines = ", ".join(f"{row['check']} ({row['failures']})" for row in broken)
        raise AssertionError(f"{len(broken)} checks failed: {lines}")
