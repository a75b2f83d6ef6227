"""Domain and contract descriptions.

A :class:`DomainSpec` is everything Bronze needs to know about one change feed; the
ten domains share one code path.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import epoch_text_to_ms, identifier, ms_to_ntz

#: Control columns every Bronze and Silver row carries.
CONTROL_COLUMNS = ("op", "source_ts_ms", "kafka_offset", "kafka_partition", "kafka_created_at")

#: The same columns as they arrive in a landing table.
LANDING_CONTROL = (
    T.StructField("__OP", T.StringType()),
    T.StructField("__SOURCE_TS_MS", T.LongType()),
    T.StructField(
        "RECORD_METADATA",
        T.StructType(
            [
                T.StructField("offset", T.LongType()),
                T.StructField("partition", T.IntegerType()),
                T.StructField("CreateTime", T.LongType()),
            ]
        ),
    ),
)

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

STRATEGIES = ("upsert", "append", "log")


@dataclass(frozen=True)
class Contract:
    """How a table's change history is resolved."""

    table_type: str = "entity"
    cdc_strategy: str = "upsert"
    unique_key: str = "id"
    active: bool = True


@dataclass(frozen=True)
class DomainSpec:
    """One change feed: its key, typed source columns and Bronze projection."""

    name: str
    key: str
    ddl: str
    table_type: str
    export_prefix: str
    renames: Mapping[str, str] = field(default_factory=dict)
    derived: Mapping[str, Callable[[Column], list[Column]]] = field(default_factory=dict)
    required: tuple[str, ...] = ()

    @property
    def topic(self) -> str:
        return f"pg.public.{self.name}"

    @property
    def source_schema(self) -> T.StructType:
        columns = [column.split() for column in self.ddl.split(", ")]
        return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])

    @property
    def landing_schema(self) -> T.StructType:
        """Upper-case typed columns plus the control columns of the landing form."""
        columns = [T.StructField(identifier(f.name), f.dataType) for f in self.source_schema]
        return T.StructType([*columns, *LANDING_CONTROL])

    @property
    def contract(self) -> Contract:
        return Contract(self.table_type, "upsert", self.key)

    def payload(self) -> list[Column]:
        """Bronze payload columns in declared order, as expressions over the landing row."""
        columns: list[Column] = []
        for source in self.source_schema.names:
            landed = F.col(f"`{identifier(source)}`")
            if source in self.derived:
                columns.extend(self.derived[source](landed))
            else:
                columns.append(landed.alias(self.renames.get(source, source)))
        return columns


def _payment_payload(event: Column) -> list[Column]:
    instant = epoch_text_to_ms(F.get_json_object(event, "$.timestamp"))
    return [
        F.get_json_object(event, "$.event_name").alias("event_name"),
        instant.alias("event_timestamp_ms"),
        ms_to_ntz(instant).alias("event_timestamp"),
    ]


# Domain names, keys, column names and types of the ten feeds.
_SPECS = [
    DomainSpec(
        "payment_events", "event_id",
        "event_id string, payment_id string, event string, dt_current_timestamp timestamp",
        "fact", "kafka_events",
        derived={"event": _payment_payload},
        required=("event_id", "payment_id", "event", "dt_current_timestamp"),
    ),
    DomainSpec(
        "orders", "order_id",
        "order_id string, order_date timestamp, total_amount double, user_key string, "
        "restaurant_key string, driver_key string, payment_key string, rating_key string, "
        "dt_current_timestamp timestamp",
        "entity", "kafka_orders", required=("order_id",),
    ),
    DomainSpec(
        "order_items", "order_item_id",
        "order_item_id string, order_id string, product_id string, restaurant_id int, "
        "product_name string, product_type string, cuisine_type string, unit_price double, "
        "quantity int, subtotal double, discount_applied double, modifiers string, "
        "is_combo boolean, is_vegetarian boolean, dt_current_timestamp timestamp",
        "fact", "mongodb_items",
    ),
    DomainSpec(
        "driver_shifts", "shift_id",
        "shift_id string, driver_id string, city string, region string, shift_type string, "
        "login_method string, device_os string, start_time timestamp, end_time timestamp, "
        "shift_duration_min int, num_orders int, distance_covered_km double, "
        "earnings_brl double, shift_rating double, issues_reported string, "
        "available boolean, dt_current_timestamp timestamp",
        "entity", "kafka_shift",
    ),
    DomainSpec(
        "search_events", "search_id",
        "search_id string, user_id int, query_text string, filters string, "
        "result_count int, clicked_product_id string, timestamp timestamp",
        "fact", "kafka_search",
        renames={"timestamp": "search_timestamp"},
    ),
    DomainSpec(
        "recommendations", "event_id",
        "event_id string, user_id int, product_id string, event_type string, "
        "timestamp timestamp, dt_current_timestamp timestamp",
        "fact", "mongodb_recommendations",
        renames={"timestamp": "event_timestamp"},
    ),
    DomainSpec(
        "users_mongo", "uuid",
        "uuid string, user_id int, cpf string, email string, phone_number string, "
        "city string, country string, delivery_address string, "
        "dt_current_timestamp timestamp",
        "entity", "mongodb_users",
    ),
    DomainSpec(
        "users_mssql", "uuid",
        "uuid string, user_id int, cpf string, first_name string, last_name string, "
        "phone_number string, birthday date, job string, company_name string, "
        "country string, dt_current_timestamp timestamp",
        "entity", "mssql_users",
    ),
    DomainSpec(
        "restaurants", "uuid",
        "uuid string, restaurant_id int, cnpj string, name string, address string, "
        "city string, country string, phone_number string, cuisine_type string, "
        "opening_time string, closing_time string, average_rating double, "
        "num_reviews int, dt_current_timestamp timestamp",
        "entity", "mysql_restaurants",
    ),
    DomainSpec(
        "drivers", "uuid",
        "uuid string, driver_id string, first_name string, last_name string, "
        "phone_number string, city string, country string, date_birth date, "
        "license_number string, vehicle_type string, vehicle_make string, "
        "vehicle_model string, vehicle_year int, dt_current_timestamp timestamp",
        "entity", "postgres_drivers",
    ),
]

#: The ten domains by name.
DOMAINS: dict[str, DomainSpec] = {spec.name: spec for spec in _SPECS}
