"""The check suites of the three layers.

Row-level checks of a table run in one aggregation; uniqueness and references are one
aggregation each.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.operators.merge import union_by_name
from tidemark.operators.quality import (
    NOT_DELETED,
    Check,
    check_relationships,
    check_unique,
    column_suite,
    count_failures,
)
from tidemark.plans.gold import FUNNEL_STAGES, STAGE_COLUMNS
from tidemark.spec import DOMAINS


@dataclass(frozen=True)
class Suite:
    """Checks of one table.

    ``unique`` holds ``(column, severity)``, ``accepted`` ``(column, values, severity)``,
    ``references`` ``(column, parent table, parent column)``; references only warn,
    because the feeds are independent and a child may arrive before its parent.
    """

    not_null: tuple[str, ...] = ()
    scoped: tuple[str, ...] = ()
    unique: tuple[tuple[str, str], ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...], str], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()


_STAGES = tuple(STAGE_COLUMNS)

# Payload columns that must be present on rows that are not deletes.
_BRONZE_SCOPED = {
    "payment_events": ("payment_id", "event_name", "event_timestamp_ms", "event_timestamp"),
    "orders": ("user_key", "restaurant_key"),
    "order_items": ("order_id",),
    "driver_shifts": ("driver_id",),
    "search_events": (),
    "recommendations": ("event_type",),
    "users_mongo": ("cpf",),
    "users_mssql": ("cpf",),
    "restaurants": ("cnpj",),
    "drivers": ("driver_id",),
}

# What Silver asserts beyond key, operation and ordering columns.
_SILVER_EXTRA = {
    "orders": Suite(
        references=(
            ("user_key", "silver_users_mongo", "cpf"),
            ("restaurant_key", "silver_restaurants", "cnpj"),
            ("driver_key", "silver_drivers", "driver_id"),
        )
    ),
    "order_items": Suite(
        not_null=("order_id",),
        references=(
            ("order_id", "silver_orders", "order_id"),
            ("restaurant_id", "silver_restaurants", "restaurant_id"),
        ),
    ),
    "payment_events": Suite(
        not_null=("payment_id", "event_name"), accepted=(("event_name", _STAGES, "warn"),)
    ),
    "recommendations": Suite(
        accepted=(
            ("event_type", ("recommendation_served", "add_to_cart", "click", "view"), "warn"),
        )
    ),
    "driver_shifts": Suite(
        not_null=("driver_id",), references=(("driver_id", "silver_drivers", "driver_id"),)
    ),
    "drivers": Suite(not_null=("driver_id",), unique=(("driver_id", "warn"),)),
    "restaurants": Suite(
        not_null=("cnpj",), unique=(("cnpj", "warn"), ("restaurant_id", "warn"))
    ),
    "users_mongo": Suite(not_null=("cpf",), unique=(("cpf", "warn"),)),
    "users_mssql": Suite(
        not_null=("cpf",),
        unique=(("cpf", "warn"),),
        references=(("cpf", "silver_users_mongo", "cpf"),),
    ),
}

# What Gold asserts on its grain and measures.
_GOLD = {
    "gold_payment_lifecycle": Suite(
        not_null=("payment_id", "total_eventos", "ultimo_evento_ms"),
        unique=(("payment_id", "error"),),
    ),
    "gold_payments_by_status": Suite(
        not_null=("event_name", "eventos", "pct_dos_eventos"),
        unique=(("event_name", "error"),),
        accepted=(("event_name", _STAGES, "error"),),
    ),
    "gold_payment_funnel": Suite(
        not_null=("ordem", "event_name", "eventos"),
        unique=(("ordem", "error"), ("event_name", "error")),
        accepted=(("event_name", FUNNEL_STAGES, "error"),),
    ),
    "gold_driver_performance": Suite(
        not_null=("driver_id", "turnos", "sem_cadastro"),
        unique=(("driver_id", "error"),),
        references=(("driver_id", "silver_drivers", "driver_id"),),
    ),
    "gold_revenue_per_restaurant": Suite(
        not_null=("restaurant_id", "receita_bruta", "itens_vendidos"),
        unique=(("restaurant_id", "error"),),
        references=(("restaurant_id", "silver_restaurants", "restaurant_id"),),
    ),
    "gold_user_behavior": Suite(
        not_null=("cpf", "pedidos", "gasto_total", "nunca_comprou"),
        unique=(("cpf", "error"),),
    ),
}


def _suites() -> dict[str, Suite]:
    suites = {}
    for name, spec in DOMAINS.items():
        suites[f"bronze_{name}"] = Suite(
            not_null=(spec.key, "op", "source_ts_ms", "kafka_offset", "kafka_created_at"),
            scoped=_BRONZE_SCOPED[name],
            unique=((spec.key, "error"),),
            accepted=(("op", ("c", "u", "d", "r"), "error"),),
        )
        extra = _SILVER_EXTRA.get(name, Suite())
        suites[f"silver_{name}"] = Suite(
            not_null=(spec.key, *extra.not_null, "source_ts_ms", "kafka_offset"),
            unique=((spec.key, "error"), *extra.unique),
            # Silver holds no deletes unless the contract is a log
            accepted=(*extra.accepted, ("op", ("c", "u", "r"), "error")),
            references=extra.references,
        )
    return {**suites, **_GOLD}


#: Table name -> its checks, 185 in all.
SUITES: dict[str, Suite] = _suites()


def layer_suite(tables: Mapping[str, DataFrame], wanted: Iterable[str] | None = None) -> DataFrame:
    """Counted checks ``(check, severity, failures)`` of the wanted tables.

    ``tables`` must hold the wanted tables and the parents their references name.
    """
    counted: list[DataFrame] = []
    for name in wanted if wanted is not None else tables:
        suite, df = SUITES[name], tables[name]
        counted.append(
            column_suite(
                df,
                name,
                [(c, None) for c in suite.not_null] + [(c, NOT_DELETED) for c in suite.scoped],
                suite.accepted,
            )
        )
        checks = [
            Check(f"unique_{name}_{column}", severity, check_unique(df, column))
            for column, severity in suite.unique
        ] + [
            Check(
                f"relationships_{name}_{column}",
                "warn",
                check_relationships(df, column, tables[parent], parent_column),
            )
            for column, parent, parent_column in suite.references
        ]
        if checks:
            counted.append(count_failures(checks))
    return union_by_name(counted)


def size(suites: Mapping[str, Suite] = SUITES) -> dict[str, int]:
    """Number of checks per layer."""
    totals: dict[str, int] = {}
    for name, suite in suites.items():
        layer = name.split("_", 1)[0]
        totals[layer] = totals.get(layer, 0) + sum(
            len(part)
            for part in (
                suite.not_null, suite.scoped, suite.unique, suite.accepted, suite.references
            )
        )
    return totals
