"""Change feeds: reading, unwrapping, routing and landing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import identifier
from tidemark.sources.envelopes import EXTRA
from tidemark.spec import DOMAINS, DomainSpec


def read_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    streaming: bool = False,
    files_per_trigger: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """Change rows of one feed, from the earliest file on.

    The schema is always explicit: types come from the contract, not from the data.
    """
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    if streaming and files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(file_format).load(path)


def unwrap_envelope(
    df: DataFrame,
    key: str,
    before: str = "before",
    after: str = "after",
    keep: Sequence[str] = (),
    prefix: str = "__",
) -> DataFrame:
    """Flatten before/after envelopes into change rows.

    A delete keeps its key from the ``before`` image and loses its payload; a row
    without an envelope is a tombstone and becomes all NULL.  ``keep`` names further
    columns (record metadata) to carry along.
    """
    fields = df.schema[after].dataType.fieldNames()
    flat = [
        F.coalesce(F.col(f"{after}.{name}"), F.col(f"{before}.{name}")).alias(name)
        if name == key
        else F.col(f"{after}.{name}").alias(name)
        for name in fields
    ]
    return df.select(
        *flat,
        F.col("op").alias(f"{prefix}OP"),
        F.col("source.ts_ms").alias(f"{prefix}SOURCE_TS_MS"),
        *keep,
    )


def topic_tables(specs: Iterable[DomainSpec] = DOMAINS.values()) -> dict[str, str]:
    """Topic -> landing table of every registered domain."""
    return {spec.topic: identifier(spec.name) for spec in specs}


def route(df: DataFrame, tables: Mapping[str, str], topic: str = "topic") -> DataFrame:
    """Add the landing table of each row; rows of unmapped topics are left out."""
    target = None
    for name, table in tables.items():
        match = F.col(topic) == name
        target = F.when(match, table) if target is None else target.when(match, table)
    return df.withColumn("table_name", target).filter(F.col("table_name").isNotNull())


def write_routed(df: DataFrame, root: str) -> None:
    """Append a routed feed, one directory per table, in one pass without a shuffle."""
    df.write.mode("append").partitionBy("table_name").parquet(root)


def type_landing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Upper-case names and contract types; columns the row lacks become NULL.

    Columns the contract does not know are kept, as JSON text in ``_EXTRA``.
    """
    present = {identifier(name): name for name in df.columns}
    known = {*schema.names, EXTRA}
    more = [F.col(f"`{name}`") for upper, name in present.items() if upper not in known]
    if EXTRA in present:
        extra = F.col(f"`{present[EXTRA]}`")
    else:
        extra = F.nullif(F.to_json(F.struct(*more)), F.lit("{}")) if more else F.lit(None)
    return df.select(
        *[
            F.col(f"`{present[field.name]}`").cast(field.dataType).alias(field.name)
            if field.name in present
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in schema
        ],
        extra.cast("string").alias(EXTRA),
    )


def land(df: DataFrame, path: str, spec: DomainSpec) -> None:
    """Typed append to a landing table; landed rows are never changed."""
    type_landing(df, spec.landing_schema).write.mode("append").parquet(path)


#: What names a message.
MESSAGE = ("topic", "kafka_partition", "kafka_offset")


def dedup_redelivery(df: DataFrame) -> DataFrame:
    """Drop messages of a batch that were delivered more than once.

    A message is its topic, partition and offset.  A live feed uses
    :func:`tidemark.streaming.landing.run_dedup`, which forgets no message and waits
    for none.
    """
    return df.dropDuplicates([c for c in MESSAGE if c in df.columns])
