"""JSON envelopes -> typed landing rows, with every message accounted for.

A message is parsed once, into a VARIANT, whatever its domain.  It then is a landed row, a
tombstone, or a *reject*: a message that cannot be landed without losing something.  Rejects
keep their text and say why, so that ``messages = landed + tombstones + rejects`` holds for
any feed:

``broken_json``         not JSON, or a field named twice
``not_an_object[:x]``   the message, or its image ``x``, is something else than an object
``no_image``            neither image is there
``no_key``              the row's key is missing or null
``wrong_type:x``        field ``x`` has a value that its contract type does not hold
``unknown_topic``       no domain reads the topic

A value is converted only if nothing is lost: whole numbers (also as text) for integers,
numbers for floats, ``true`` and ``false``, ISO dates without a time, and ISO times with a
zone and at most microseconds; a time without a zone is not an instant and is rejected.  Text
columns take anything; other values become their JSON text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import identifier
from tidemark.spec import DomainSpec

#: JSON text of the fields a contract does not know; NULL if there are none.
EXTRA = "_EXTRA"
#: Directory of the rejects among those of the domains.
REJECTS = "_rejects"

#: What dates and instants look like when no digit is lost.
DATE = r"^\d{4}-\d\d-\d\d$"
INSTANT = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d{1,6}0*)?)?(Z|[+-]\d\d(:?\d\d)?)$"
_VARIANTS = "map<string,variant>"


def exact_text(text: Column, kind: T.DataType) -> Column:
    """``text`` as a value of ``kind``; NULL if it is none, or only nearly one."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        return F.when(text == "true", True).when(text == "false", False)
    if isinstance(kind, T.DateType):
        return F.when(text.rlike(DATE), text.try_cast("date"))
    if isinstance(kind, T.TimestampType):
        return F.when(text.rlike(INSTANT), text.try_cast("timestamp"))
    if isinstance(kind, T.IntegerType):
        number = text.try_cast("double")  # exact for 32 bits
        return F.when(
            (number == F.floor(number)) & number.between(-(2**31), 2**31 - 1), number.cast("int")
        )
    return text.try_cast(kind)


def _text(path: str) -> Column:
    return F.try_variant_get("_v", path, "string")


def _is_something(path: str) -> Column:
    """Whether there is a value at ``path``, other than null."""
    value = F.try_variant_get("_v", path, "variant")
    return value.isNotNull() & ~F.is_variant_null(value)


def landed_type(spec: DomainSpec) -> T.StructType:
    return T.StructType([*spec.landing_schema, T.StructField(EXTRA, T.StringType())])


def type_messages(feed: DataFrame, specs: Sequence[DomainSpec]) -> DataFrame:
    """Every message of a mixed feed with its ``outcome`` and, if landed, its typed row.

    ``feed`` has ``topic``, ``value`` (JSON text; NULL or JSON null is a tombstone),
    ``kafka_offset``, ``kafka_partition`` and ``kafka_created_at``.  The result adds
    ``domain``, ``outcome`` (``landed``, ``tombstone`` or ``rejected``), ``reasons`` and one
    struct column per domain, set for its own messages.  A delete has the key of the image
    before; all other columns come from the image after.
    """
    parsed = feed.withColumn("_v", F.try_parse_json("value"))
    domain = F.coalesce(*[F.when(F.col("topic") == s.topic, s.name) for s in specs], F.lit(None).cast("string"))
    dead = F.col("value").isNull() | F.coalesce(F.is_variant_null("_v"), F.lit(False))
    parsed = parsed.withColumns({"domain": domain, "_dead": dead})
    # the text of each field, then its typed value: each is worked out once
    texts = {f"_t_{s.name}": F.when(F.col("domain") == s.name, _texts(s)) for s in specs}
    typed = {}
    for spec in specs:
        of = F.col(f"_t_{spec.name}")
        values = [exact_text(of[f.name], f.dataType).alias(f.name) for f in spec.source_schema]
        values.append(exact_text(of["__ts"], T.LongType()).alias("__ts"))
        typed[f"_v_{spec.name}"] = F.when(F.col("domain") == spec.name, F.struct(*values))
    checked = parsed.withColumns(texts).withColumns(typed)
    reasons = F.coalesce(
        F.when(F.col("domain").isNull(), F.array(F.lit("unknown_topic"))),
        F.when(F.col("_dead"), F.array().cast("array<string>")),
        F.when(F.col("_v").isNull(), F.array(F.lit("broken_json"))),
        F.when(F.try_variant_get("_v", "$", _VARIANTS).isNull(), F.array(F.lit("not_an_object"))),
        *[F.when(F.col("domain") == s.name, _reasons(s)) for s in specs],
    )
    checked = checked.withColumn("reasons", reasons)
    outcome = (
        F.when(F.size("reasons") > 0, "rejected").when(F.col("_dead"), "tombstone").otherwise("landed")
    )
    checked = checked.withColumn("outcome", outcome)
    kept = F.col("outcome") != "rejected"
    return checked.select(
        *feed.columns,
        "domain",
        "outcome",
        "reasons",
        *[F.when(kept & (F.col("domain") == s.name), _row(s)).alias(s.name) for s in specs],
    )


def _texts(spec: DomainSpec) -> Column:
    fields = [
        (F.coalesce(_text(f"$.after.{f.name}"), _text(f"$.before.{f.name}")) if f.name == spec.key
         else _text(f"$.after.{f.name}")).alias(f.name)
        for f in spec.source_schema
    ]
    known = spec.source_schema.names
    more = F.map_filter(F.try_variant_get("_v", "$.after", _VARIANTS), lambda k, v: ~k.isin(known))
    return F.struct(*fields, _text("$.source.ts_ms").alias("__ts"), more.alias("__more"))


def _reasons(spec: DomainSpec) -> Column:
    text, value = F.col(f"_t_{spec.name}"), F.col(f"_v_{spec.name}")
    lost = [
        F.when(text[name].isNotNull() & value[name].isNull(), F.lit(f"wrong_type:{shown}"))
        for name, shown in [*((n, n) for n in spec.source_schema.names), ("__ts", "source.ts_ms")]
    ]
    images = []
    for image in ("after", "before"):
        is_object = F.try_variant_get("_v", f"$.{image}", _VARIANTS).isNotNull()
        images.append(F.when(_is_something(f"$.{image}") & ~is_object, F.lit(f"not_an_object:{image}")))
    shape = F.array_compact(F.array(*images))
    none = ~_is_something("$.after") & ~_is_something("$.before")
    fields = [F.when(text[spec.key].isNull(), F.lit("no_key")), *lost]
    return (
        F.when(F.size(shape) > 0, shape)
        .when(none, F.array(F.lit("no_image")))
        .otherwise(F.array_compact(F.array(*fields)))
    )


def _row(spec: DomainSpec) -> Column:
    text, value = F.col(f"_t_{spec.name}"), F.col(f"_v_{spec.name}")
    return F.struct(
        *[value[f.name].alias(identifier(f.name)) for f in spec.source_schema],
        _text("$.op").alias("__OP"),
        value["__ts"].alias("__SOURCE_TS_MS"),
        F.struct(
            F.col("kafka_offset").alias("offset"),
            F.col("kafka_partition").alias("partition"),
            F.col("kafka_created_at").alias("CreateTime"),
        ).alias("RECORD_METADATA"),
        F.when(F.size(text["__more"]) > 0, F.to_json(text["__more"])).alias(EXTRA),
    ).cast(landed_type(spec))


def land_domain(feed: DataFrame, spec: DomainSpec) -> DataFrame:
    """Typed landing rows of one domain, tombstones included; see :func:`rejected`."""
    own = type_messages(feed.filter(F.col("topic") == spec.topic), [spec])
    # unpacked rather than filtered: a filter would be pushed below and parse once more
    return own.select(F.inline(F.array_compact(F.array(spec.name))))


def rejected(messages: DataFrame) -> DataFrame:
    """Messages of :func:`type_messages` that were not landed, with their whole text."""
    kept = F.struct("topic", "kafka_partition", "kafka_offset", "kafka_created_at", "reasons", "value")
    return messages.select(F.inline(F.when(F.col("outcome") == "rejected", F.array(kept))))


def write_landing(messages: DataFrame, path: str, specs: Sequence[DomainSpec]) -> None:
    """One pass over typed messages: a directory per domain, and one for the rejects.

    Rows are told apart by a partition column, not by a read per domain.
    """
    gone = F.col("outcome") == "rejected"
    rows = messages.select(
        F.when(gone, REJECTS).otherwise(F.col("domain")).alias("domain"),
        "topic", "kafka_partition", "kafka_offset", "kafka_created_at",
        F.when(gone, F.col("reasons")).alias("reasons"),
        F.when(gone, F.col("value")).alias("value"),
        *[s.name for s in specs],
    )
    rows.write.mode("overwrite").partitionBy("domain").parquet(path)


def read_landing(spark: SparkSession, root: str, spec: DomainSpec) -> DataFrame:
    """Landing rows of one domain from all batches; other domains' files are not opened."""
    stored = T.StructType([T.StructField(spec.name, landed_type(spec)), T.StructField("domain", T.StringType())])
    return spark.read.schema(stored).parquet(root).filter(F.col("domain") == spec.name).select(f"{spec.name}.*")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    stored = (
        "topic string, kafka_partition int, kafka_offset long, kafka_created_at long, "
        "reasons array<string>, value string, domain string"
    )
    return spark.read.schema(stored).parquet(root).filter(F.col("domain") == REJECTS).drop("domain")
