"""Columns that producers have added and contracts do not know yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import identifier, ratio
from tidemark.sources.envelopes import DATE, EXTRA, INSTANT, exact_text

_VARIANTS = "map<string,variant>"


def _fields(extra: str):
    return F.try_variant_get(F.try_parse_json(extra), "$", _VARIANTS)


def discover_columns(landed: DataFrame, extra: str = EXTRA) -> DataFrame:
    """One row per unknown field: in how many rows it is, its type, and a column for it.

    ``found`` is the least type that holds every value as written, objects and lists
    included (``VARIANT`` where there is none); ``proposed`` is the column type: text that is
    always a date or an instant becomes one, values of several types stay JSON text, and a
    field that was never set gets none.  Types are merged before rows are shuffled, so a
    field that every row has costs one row a task.
    """
    marked = landed.select(F.col(extra).alias("_extra"))
    rows = marked.agg(F.count(F.lit(1))).scalar()
    each = marked.select(F.explode(_fields("_extra")).alias("field", "_value"))
    text = F.try_variant_get("_value", "$", "string")
    found = each.groupBy("field").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.is_variant_null("_value")).alias("nulls"),
        F.schema_of_variant_agg("_value").alias("found"),
        F.bool_and(text.rlike(DATE)).alias("_dates"),
        F.bool_and(text.rlike(INSTANT)).alias("_instants"),
    )
    kind = F.col("found")
    proposed = (
        F.when(kind == "VOID", None)
        .when((kind == "STRING") & F.col("_dates"), "DATE")
        .when((kind == "STRING") & F.col("_instants"), "TIMESTAMP")
        .when(kind.contains("VARIANT") | kind.contains("VOID"), "STRING")
        .otherwise(F.replace(kind, F.lit("OBJECT<"), F.lit("STRUCT<")))
    )
    return found.select(
        "field", "found", proposed.alias("proposed"), "rows", "nulls", ratio("rows", rows, 100).alias("pct_of_rows")
    )


def proposed_schema(found: DataFrame, least_pct: float = 1.0) -> T.StructType:
    """Columns for the fields that at least so many rows have.

    A row has few fields, so few can be in a hundredth of all rows; names that are data
    (one per user, say) never come to the driver.
    """
    named = found.filter((F.col("pct_of_rows") >= least_pct) & F.col("proposed").isNotNull())
    rows = named.select("field", "proposed").orderBy("field").collect()
    return T.StructType([T.StructField(field, T.DataType.fromDDL(kind)) for field, kind in rows])


def promote_columns(landed: DataFrame, new: T.StructType, extra: str = EXTRA) -> DataFrame:
    """``landed`` with ``new`` columns, taken out of the unknown fields.

    A value that its new column does not hold exactly stays where it was.
    """
    fields = landed.withColumn("_fields", _fields(extra))
    values, moved = {}, []
    for f in new:
        value = F.try_element_at("_fields", F.lit(f.name))
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.DecimalType)):
            typed = F.try_variant_get(value, "$", f.dataType.simpleString())
        else:
            typed = exact_text(F.try_variant_get(value, "$", "string"), f.dataType)
        values[identifier(f.name)] = typed
        moved.append(typed.isNotNull() | F.coalesce(F.is_variant_null(value), F.lit(False)))
    done = F.array_compact(F.array(*[F.when(m, F.lit(f.name)) for m, f in zip(moved, new)]))
    rest = F.map_filter("_fields", lambda k, _: ~F.array_contains(F.col("_done"), k))
    promoted = fields.withColumns(values).withColumn("_done", done)
    left = F.when(F.col("_fields").isNull() | F.lit(not len(new)), F.col(extra))
    left = left.when(F.size(rest) > 0, F.to_json(rest))  # text that is no object stays as it is
    return promoted.withColumn(extra, left).drop("_fields", "_done")
