"""Run artefacts: one nested JSON document per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Results as they are written; times are numbers, whatever the text says of them.
RESULTS = (
    "array<struct<unique_id:string,status:string,execution_time:string,"
    "message:string,timing:array<struct<name:string,started_at:string,completed_at:string>>>>"
)


def _seconds(result: Column) -> Column:
    return result["execution_time"].try_cast("double")


def _once(**columns: Column) -> Column:
    """``columns``, worked out once a row: predicates on them are not pushed below, where they
    would be worked out again."""
    return F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()])))


def run_documents(spark: SparkSession, path: str) -> DataFrame:
    """``file``, the run, and its results; these are NULL if any cannot be read as it is.

    A row per document; who needs both results and broken files stores it, so that no document
    is listed, read and parsed twice.
    """
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    parsed = texts.select(F.col("_metadata.file_path").alias("file"), _once(_v=F.try_parse_json("value")))
    results = parsed.select(
        "file",
        _once(
            invocation_id=F.try_variant_get("_v", "$.metadata.invocation_id", "string"),
            _results=F.try_variant_get("_v", "$.results", RESULTS),
        ),
    )
    lost = F.exists("_results", lambda r: r["execution_time"].isNotNull() & _seconds(r).isNull())
    typed = F.transform("_results", lambda r: r.withField("execution_time", _seconds(r)))
    return results.select("file", "invocation_id", F.when(~lost, typed).alias("results"))


def read_run_results(spark: SparkSession, path: str, documents: DataFrame | None = None) -> DataFrame:
    """One row per result of one or more run-result documents, those under ``path`` or given."""
    documents = run_documents(spark, path) if documents is None else documents
    return documents.select("invocation_id", F.inline("results"))


def broken_run_results(spark: SparkSession, path: str, documents: DataFrame | None = None) -> DataFrame:
    """Files of which nothing was read: cut off, or with results of other types."""
    documents = run_documents(spark, path) if documents is None else documents
    return documents.filter("results IS NULL").select("file")
