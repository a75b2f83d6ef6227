"""JSON-lines exports -> typed domain rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import digits_modulo
from tidemark.operators.bronze import dedup_latest
from tidemark.operators.merge import union_by_name
from tidemark.operators.ranking import global_rank
from tidemark.sources.tables import StoredTable
from tidemark.spec import DOMAINS, DomainSpec

BATCHES = ("initial", "incremental", "all")
#: The first batch: four fifths of the files.
_INITIAL_PARTS, _PARTS = 4, 5
_BY_PREFIX = {spec.export_prefix: spec for spec in DOMAINS.values()}


def export_domain(name: Column) -> Column:
    """Domain of an export file from the first two ``_`` parts of its name."""
    prefix = F.substring_index(name, "_", 2)
    known = F.create_map(*[F.lit(x) for p, s in _BY_PREFIX.items() for x in (p, s.name)])
    return known[prefix]


def select_files(
    spark: SparkSession, directory: str, batch: str = "all", domain: str | None = None
) -> DataFrame:
    """``file`` and ``domain`` of the recognised export files of a batch.

    ``initial`` is the first 80 percent by name (rounded down), ``incremental`` the rest.
    Names are sorted and counted by many tasks; see :func:`global_rank`.
    """
    if batch not in BATCHES:
        raise ValueError(f"unknown batch {batch!r}; expected one of {', '.join(BATCHES)}")
    named = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[jJ][sS][oO][nN]")
        .load(directory)
        .select(F.substring_index("path", "/", -1).alias("file"))
        .withColumn("domain", export_domain(F.col("file")))
        .filter("domain IS NOT NULL")
    )
    if domain is not None:
        named = named.filter(F.col("domain") == domain)
    if batch == "all":
        return named
    ranked, total = global_rank(named, "file", name="export_rank")
    first = F.col("export_rank") <= int(total * _INITIAL_PARTS // _PARTS)
    return ranked.filter(first if batch == "initial" else ~first).drop("export_rank")


def read_exports(
    spark: SparkSession, directory: str, files: DataFrame, spec: DomainSpec
) -> DataFrame:
    """Rows of a domain's listed files with their position; ``_bad`` marks unusable lines.

    The files of the domain are read by their name's prefix and joined to the list by
    name.  Nested values of text columns keep their JSON text.
    """
    fields = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.StringType) else f.dataType)
        for f in spec.source_schema
    ]
    schema = T.StructType([*fields, T.StructField("_corrupt", T.StringType())])
    listed = files.filter(F.col("domain") == spec.name).select(F.col("file").alias("_file"))
    lines = (
        spark.read.schema(schema)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("pathGlobFilter", f"{spec.export_prefix}_*.[jJ][sS][oO][nN]")
        .json(directory)
        .withColumns(
            {
                "_file": F.col("_metadata.file_name"),
                "_block": F.col("_metadata.file_block_start"),
                "_line": F.monotonically_increasing_id(),
            }
        )
        .join(listed, "_file", "left_semi")
    )
    required = F.lit(True)
    for name in spec.required or (spec.key,):
        required = required & F.col(name).isNotNull()
    bad = F.col("_corrupt").isNotNull() | ~required
    return lines.withColumn("_bad", bad)


def load_exports(
    spark: SparkSession, directory: str, batch: str = "all", domain: str | None = None
) -> dict[str, DataFrame]:
    """Domain -> rows to upsert: per key the last occurrence by file name and line."""
    loaded = {}
    for name, rows in _per_domain(spark, directory, batch, domain).items():
        spec = DOMAINS[name]
        good = rows.filter("NOT _bad").drop("_corrupt", "_bad")
        if name == "orders":
            # numeric driver ids, so that orders join the driver registry
            good = good.withColumn("driver_key", digits_modulo("driver_key"))
        latest = dedup_latest(good, spec.key, ("_file", "_block", "_line"))
        loaded[name] = latest.select(*spec.source_schema.names)
    return loaded


def export_summary(
    spark: SparkSession, directory: str, batch: str = "all", domain: str | None = None
) -> DataFrame:
    """Files, records and unusable lines per domain."""
    return union_by_name(
        [
            rows.groupBy("_file")
            .agg(
                F.count_if(~F.col("_bad")).alias("_records"), F.count_if("_bad").alias("_errors")
            )
            .agg(
                F.count(F.lit(1)).alias("files"),
                F.sum("_records").alias("records"),
                F.sum("_errors").alias("errors"),
            )
            .select(F.lit(name).alias("domain"), "files", "records", "errors")
            for name, rows in _per_domain(spark, directory, batch, domain).items()
        ]
    )


def upsert_exports(
    spark: SparkSession,
    directory: str,
    targets: Mapping[str, StoredTable],
    batch: str = "all",
) -> None:
    """Load a batch into one stored table per domain; loaded rows replace older ones."""
    for name, rows in load_exports(spark, directory, batch).items():
        if name in targets:
            targets[name].merge(rows, order=())


def _per_domain(
    spark: SparkSession, directory: str, batch: str, domain: str | None
) -> dict[str, DataFrame]:
    files = select_files(spark, directory, batch, domain)
    present = [row["domain"] for row in files.select("domain").distinct().collect()]  # ten at most
    return {name: read_exports(spark, directory, files, DOMAINS[name]) for name in sorted(present)}
