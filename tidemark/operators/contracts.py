"""Contracts: which strategy resolves which table.

Subjects are rows ``(subject, doc)``; contracts are rows of the table-metadata form.
Everything is joined by table name, so the work grows with the number of subjects.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import declared_field
from tidemark.spec import DOMAINS, Contract

log = logging.getLogger(__name__)

# The fields a doc string may declare and their defaults.
DOC_DEFAULTS = {"table_type": "entity", "cdc_strategy": "upsert", "unique_key": "id"}
FIELDS = tuple(DOC_DEFAULTS)
SOURCE = "schema_registry"
CHANGED_BY = "sync_metadata"


def subjects_to_tables(subjects: DataFrame) -> DataFrame:
    """Value subjects with their topic and table name; key subjects are left out."""
    topic = F.regexp_replace("subject", "-value$", "")
    return (
        subjects.filter(F.col("subject").endswith("-value"))
        .withColumn("topic", topic)
        .withColumn("table_name", F.substring_index("topic", ".", -1))
    )


def parse_doc(df: DataFrame, column: str = "doc") -> DataFrame:
    """Add the fields a doc string declares; undeclared ones stay NULL."""
    return df.withColumns({field: declared_field(column, field) for field in FIELDS})


def effective_contracts(contracts: DataFrame, fallback: DataFrame) -> DataFrame:
    """Active contracts, completed by fallback rows for tables they do not cover."""
    columns = ["table_name", *FIELDS]
    active = contracts.filter("active").select(*columns)
    missing = fallback.select(*columns).join(active.select("table_name"), "table_name", "left_anti")
    return active.unionByName(missing)


def model_contracts(models: DataFrame, contracts: DataFrame, fallback: DataFrame) -> DataFrame:
    """Contract of every model; ``known`` is false where the defaults had to be used.

    The layer prefix of a model name leads to its table name.
    """
    table = F.col("model_name")
    for prefix in ("bronze_", "silver_", "gold_"):
        table = F.replace(table, F.lit(prefix), F.lit(""))
    found = effective_contracts(contracts, fallback).withColumn("known", F.lit(True))
    defaults = {f: F.coalesce(F.col(f), F.lit(value)) for f, value in DOC_DEFAULTS.items()}
    return (
        models.withColumn("table_name", table)
        .join(found, "table_name", "left")
        .withColumn("known", F.coalesce("known", F.lit(False)))
        .withColumns({f: F.when(F.col("known"), F.col(f)).otherwise(defaults[f]) for f in FIELDS})
        .select("model_name", "table_name", *FIELDS, "known")
    )


def _table_name(model_name: str) -> str:
    for prefix in ("bronze_", "silver_", "gold_"):
        model_name = model_name.replace(prefix, "")
    return model_name


def contracts_of(
    model_names: Sequence[str], contracts: DataFrame | None = None
) -> dict[str, Contract]:
    """Contract of each model, in one read of the stored contracts.

    Two active contracts for one table are an error.  Tables without a stored contract
    take the built-in domain's, others the defaults with a warning.
    """
    tables = {model: _table_name(model) for model in model_names}
    stored: dict[str, Contract] = {}
    if contracts is not None:
        rows = (
            contracts.filter(F.col("active") & F.col("table_name").isin(*set(tables.values())))
            .groupBy("table_name")  # at most one row per model asked for
            .agg(F.count(F.lit(1)).alias("n"), *[F.min(f).alias(f) for f in FIELDS])
            .collect()
        )
        several = sorted(row["table_name"] for row in rows if row["n"] > 1)
        if several:
            raise ValueError(f"several active contracts for {', '.join(several)}")
        stored = {
            row["table_name"]: Contract(row["table_type"], row["cdc_strategy"], row["unique_key"])
            for row in rows
        }
    found = {}
    for model, name in tables.items():
        if name in stored:
            found[model] = stored[name]
        elif name in DOMAINS:
            found[model] = DOMAINS[name].contract
        else:
            log.warning("no contract for %s, using defaults", name)
            found[model] = Contract(**DOC_DEFAULTS)
    return found


def contract_for(model_name: str, contracts: DataFrame | None = None) -> Contract:
    """Contract of one model, looked up while the plan is built."""
    return contracts_of([model_name], contracts)[model_name]


# ------------------------------------------------------------------------ sync
def _paired(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Current and incoming contract side by side with the kind of change.

    ``incoming`` is the output of :func:`subjects_to_tables` and :func:`parse_doc`.
    Fields the doc does not declare keep their value; a doc that declares nothing
    leaves the contract alone.  Tables only known to ``current`` are untouched.
    """
    old = current.select("table_name", F.struct(*current.drop("table_name").columns).alias("old"))
    # the last declared doc per table wins when a table is listed more than once
    new = incoming.groupBy("table_name").agg(
        F.max_by(F.struct("topic", *FIELDS), "subject").alias("new")
    )
    both = old.join(new, "table_name", "full")
    differs = F.lit(False)
    for field in FIELDS:
        declared, stored = F.col(f"new.{field}"), F.col(f"old.{field}")
        differs = differs | (declared.isNotNull() & ~declared.eqNullSafe(stored))
    change = (
        F.when(F.col("new").isNull(), "untouched")
        .when(F.col("old").isNull(), "insert")
        .when(differs, "update")
        .otherwise("no_change")
    )
    return both.withColumn("change_type", change)


def _effective(field: str) -> Column:
    """Declared value, else stored value, else the default of a new table."""
    return F.coalesce(
        F.col(f"new.{field}"),
        F.when(F.col("old").isNotNull(), F.col(f"old.{field}")).otherwise(
            F.lit(DOC_DEFAULTS[field])
        ),
    )


def sync_contracts(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """The contract table after applying the incoming subjects.

    New tables get defaults for what their doc leaves out.  A change of strategy
    remembers the previous one, and later unrelated updates do not forget it.
    """
    written = F.col("change_type").isin("insert", "update")
    fresh = F.col("change_type") == "insert"
    strategy_changed = (F.col("change_type") == "update") & ~F.col("new.cdc_strategy").eqNullSafe(
        F.col("old.cdc_strategy")
    ) & F.col("new.cdc_strategy").isNotNull()
    paired = _paired(current, incoming)
    result = {
        "topic": F.when(fresh, F.col("new.topic")).otherwise(F.col("old.topic")),
        **{f: _effective(f) for f in FIELDS},
        "active": F.when(fresh, F.lit(True)).otherwise(F.col("old.active")),
        "registered_at": F.when(fresh, now).otherwise(F.col("old.registered_at")),
        "updated_at": F.when(written, now).otherwise(F.col("old.updated_at")),
        "source": F.when(written, F.lit(SOURCE)).otherwise(F.col("old.source")),
        "previous_strategy": F.when(strategy_changed, F.col("old.cdc_strategy")).otherwise(
            F.col("old.previous_strategy")
        ),
        "changed_by": F.when(written, F.lit(CHANGED_BY)).otherwise(F.col("old.changed_by")),
        "notes": F.col("old.notes"),
    }
    return paired.select("table_name", *[c.alias(name) for name, c in result.items()])


def contract_history(current: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Audit rows of a sync: one per changed field, one ``all`` row per new table."""
    paired = _paired(current, incoming).filter(F.col("change_type").isin("insert", "update"))
    whole = F.struct(
        (F.col("change_type") == "insert").alias("logged"),
        F.lit("all").alias("field_changed"),
        F.lit(None).cast("string").alias("old_value"),
        F.to_json(F.struct(*[_effective(f).alias(f) for f in FIELDS])).alias("new_value"),
    )
    fields = [
        F.struct(
            (
                (F.col("change_type") == "update")
                & F.col(f"new.{f}").isNotNull()
                & ~F.col(f"new.{f}").eqNullSafe(F.col(f"old.{f}"))
            ).alias("logged"),
            F.lit(f).alias("field_changed"),
            F.col(f"old.{f}").alias("old_value"),
            F.col(f"new.{f}").alias("new_value"),
        )
        for f in FIELDS
    ]
    return (
        paired.select("table_name", "change_type", F.inline(F.array(whole, *fields)))
        .filter("logged")
        .select(
            "table_name",
            now.alias("changed_at"),
            F.lit(CHANGED_BY).alias("changed_by"),
            "change_type",
            "field_changed",
            "old_value",
            "new_value",
            F.lit(SOURCE).alias("source"),
        )
    )


def sync_summary(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Number of subjects per outcome of a sync."""
    return (
        _paired(current, incoming)
        .filter("change_type <> 'untouched'")
        .groupBy("change_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def new_subjects(subjects: DataFrame, contracts: DataFrame) -> DataFrame:
    """Value subjects whose table has no contract yet."""
    return subjects_to_tables(subjects).join(
        contracts.select("table_name"), "table_name", "left_anti"
    )


def check_contract_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Where the active contracts differ from the expected ones, and how.

    Comparison ignores case and treats NULL as a value.
    """
    wanted = expected.select(
        F.lower("table_name").alias("table_name"),
        F.lower("table_type").alias("tipo_esperado"),
        F.lower("cdc_strategy").alias("estrategia_esperada"),
        F.lower("unique_key").alias("chave_esperada"),
        F.lit(True).alias("_wanted"),
    )
    found = actual.filter("active").select(
        F.lower("table_name").alias("table_name"),
        F.lower("table_type").alias("tipo_atual"),
        F.lower("cdc_strategy").alias("estrategia_atual"),
        F.lower("unique_key").alias("chave_atual"),
        F.lit(True).alias("_found"),
    )
    same = (
        F.col("tipo_esperado").eqNullSafe(F.col("tipo_atual"))
        & F.col("estrategia_esperada").eqNullSafe(F.col("estrategia_atual"))
        & F.col("chave_esperada").eqNullSafe(F.col("chave_atual"))
    )
    reason = (
        F.when(F.col("_found").isNull(), "lacking")
        .when(F.col("_wanted").isNull(), "unasked")
        .when(~same, "differs")
    )
    return (
        wanted.join(found, "table_name", "full")
        .withColumn("motivo", reason)
        .filter(F.col("motivo").isNotNull())
        .drop("_wanted", "_found")
    )
