"""Queries over feeds and files that are not as their contracts say, from whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import identifier, ms_to_ntz
from tidemark.operators.audit import processing_log
from tidemark.operators.discovery import discover_columns, promote_columns, proposed_schema
from tidemark.sources.artifacts import broken_run_results, read_run_results, run_documents
from tidemark.sources.envelopes import EXTRA, land_domain, type_messages
from tidemark.sources.exports import export_summary, load_exports
from tidemark.sources.workdir import shared_dir
from tidemark.spec import DOMAINS
from workloads.governance import run_results
from workloads.inputs import landing, landing_sql, spread, table, union_all
from workloads.layers import LANDED, envelope_feed
from workloads.sql import rounded

QUERIES = {}
ORACLES = {}

#: Offsets by what happens to their messages; the others stay as they are.
DAMAGES = 17
_NUMBER = {"orders": "total_amount", "search_events": "result_count", "users_mssql": "user_id"}
_TIME = {"orders": "order_date", "search_events": "timestamp", "users_mssql": "dt_current_timestamp"}


def damaged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed feed after what real producers do to it, by offset."""
    feed = envelope_feed(spark, sf_dir)
    kind = F.col("kafka_offset") % DAMAGES
    value, key = F.col("value"), "|".join(DOMAINS[d].key for d in LANDED)
    number = "|".join(_NUMBER.values())
    changed = (
        F.when(value.isNull(), F.when(kind == 9, "null"))
        .when(kind == 1, F.expr("left(value, length(value) - 4)"))
        .when(kind == 3, F.regexp_replace(value, rf'"({number})":[-0-9.Ee]+', r'"$1":"many"'))
        .when(kind == 4, F.regexp_replace(value, r"\.\d{6}(Z|[+-]\d\d:\d\d)", "$1"))
        .when(kind == 5, F.regexp_replace(value, r"(\.\d{6})(Z|[+-]\d\d:\d\d)", "$1"))
        .when(kind == 6, F.regexp_replace(value, r'"birthday":"([0-9-]+)"', r'"birthday":"$1 00:00"'))
        .when(kind == 7, F.lit('{"before":null,"after":["x"],"op":"c","source":{"ts_ms":1}}'))
        .when(kind == 8, F.regexp_replace(value, rf'"({key})":"[^"]*"', '"other":1'))
        .when(kind == 10, F.lit("[1, 2]"))
        .when(kind == 11, F.lit('{"op":"c","source":{"ts_ms":1}}'))
        .when(kind == 12, F.regexp_replace(value, rf'"({number})":([-0-9.Ee]+)', r'"$1":"$2"'))
        .when(kind == 13, F.regexp_replace(value, r'"ts_ms":(\d+)', r'"ts_ms":$1.5'))
        .when(kind == 14, F.regexp_replace(value, r'"op":', '"op":"c","op":'))
        .otherwise(value)
    )
    topic = F.when(kind == 2, "pg.public.unheard").otherwise(F.col("topic"))
    return feed.withColumns({"value": changed, "topic": topic})


def land_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of a damaged feed: what became of it, why, and what was landed."""
    messages = type_messages(damaged_feed(spark, sf_dir), [DOMAINS[d] for d in LANDED])
    number = [F.col(f"{d}.{c.upper()}").cast("double") for d, c in _NUMBER.items()]
    time = [F.col(f"{d}.{c.upper()}").cast("timestamp_ntz") for d, c in _TIME.items()]
    key = [F.col(f"{d}.{DOMAINS[d].key.upper()}") for d in LANDED]
    return messages.select(
        "topic",
        "kafka_partition",
        "kafka_offset",
        "outcome",
        F.array_join("reasons", ",").alias("reasons"),
        (F.col("outcome") != "rejected").alias("typed"),
        F.coalesce(*key).alias("key"),
        F.coalesce(*number).alias("number"),
        F.coalesce(*time).alias("happened_at"),
    )


def _damaged_sql(domain: str) -> str:
    """What becomes of each message, from the rows the messages were made of."""
    spec, number, time = DOMAINS[domain], _NUMBER[domain], _TIME[domain]
    birthday = "birthday IS NOT NULL" if domain == "users_mssql" else "false"
    names = [f.name for f in spec.source_schema if f.dataType.typeName() == "timestamp"]
    wrong = [n for n in spec.source_schema.names if n in _NUMBER.values()]

    def listed(fields: list[str]) -> str:
        each = [f"CASE WHEN {n} IS NOT NULL THEN ',wrong_type:{n}' ELSE '' END" for n in fields]
        return f"ltrim({' || '.join(each)}, ',')"

    return f"""
SELECT CASE WHEN k = 2 THEN 'pg.public.unheard' ELSE '{spec.topic}' END AS topic, kafka_partition, kafka_offset,
  CASE WHEN reasons <> '' THEN 'rejected' WHEN dead THEN 'tombstone' ELSE 'landed' END AS outcome, reasons,
  reasons = '' AS typed,
  CASE WHEN reasons = '' THEN {spec.key} END AS key,
  CASE WHEN reasons = '' THEN CAST({number} AS DOUBLE) END AS number,
  CASE WHEN reasons <> '' THEN NULL WHEN k = 4 THEN date_trunc('second', CAST({time} AS TIMESTAMP))
       ELSE CAST({time} AS TIMESTAMP) END AS happened_at
FROM (SELECT *, CASE
    WHEN k = 2 THEN 'unknown_topic'
    WHEN dead THEN ''
    WHEN k = 1 OR (k = 14 AND op IS NOT NULL) THEN 'broken_json'
    WHEN k = 3 THEN {listed(wrong)}
    WHEN k = 5 THEN {listed(names)}
    WHEN k = 6 AND {birthday} THEN 'wrong_type:birthday'
    WHEN k = 7 THEN 'not_an_object:after'
    WHEN k = 8 THEN 'no_key'
    WHEN k = 10 THEN 'not_an_object'
    WHEN k = 11 THEN 'no_image'
    WHEN k = 13 THEN 'wrong_type:source.ts_ms'
    ELSE '' END AS reasons
  FROM (SELECT *, kafka_offset % {DAMAGES} AS k, source_ts_ms IS NULL AS dead FROM ({landing_sql(domain)}) l) m) n"""


QUERIES["land_rejects"] = land_rejects
ORACLES["land_rejects"] = " UNION ALL ".join(_damaged_sql(d) for d in LANDED)


EXPORTED = ("orders", "search_events", "users_mssql")
#: Files a domain is exported to, per version of its rows.
PARTS = 16
#: Every so many source rows one is written as a broken line.
BROKEN = 23


def export_files(spark: SparkSession, sf_dir: str) -> str:
    """JSON-lines exports of three domains, all rows, with the names exporters give them."""
    work = shared_dir(spark, "exports")
    spark.createDataFrame([("{}",)], "value string").write.text(f"{work}/files")  # and a file of no domain
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{work}/files")
    fs = files.getFileSystem(spark._jsc.hadoopConfiguration())
    for name in EXPORTED:
        spec = DOMAINS[name]
        rows = landing(spark, sf_dir, name).filter(f"{spec.key.upper()} IS NOT NULL AND NOT __OP <=> 'd'")
        offset = F.col("RECORD_METADATA.offset")
        sequence = F.floor(offset / 4)
        line = F.to_json(
            F.struct(
                *[F.col(identifier(f.name)).cast(f.dataType).alias(f.name) for f in spec.source_schema]
            ),
            {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"},
        )
        lines = rows.select((offset % 4 * PARTS + sequence % PARTS).alias("file"), sequence.alias("n"), line.alias("line"))
        cut = F.when(F.col("n") % BROKEN == 5, F.expr("left(line, length(line) - 2)")).otherwise(F.col("line"))
        # the rows of a file are one task's, so that there is one file
        lines.select("file", cut.alias("value")).repartition("file").write.partitionBy("file").text(f"{work}/{name}")
        for folder in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{work}/{name}")):
            at = folder.getPath()
            if folder.isDirectory():
                number = int(at.getName().split("=")[1])
                for part in fs.listStatus(at):
                    named = f"{work}/files/{spec.export_prefix}_{number:03d}.json"
                    fs.rename(part.getPath(), spark._jvm.org.apache.hadoop.fs.Path(named))
    return f"{work}/files"


def exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows to upsert of each batch of export files: the last one of each key."""
    place = export_files(spark, sf_dir)
    frames = []
    for batch in ("initial", "incremental"):
        for name, rows in load_exports(spark, place, batch).items():
            frames.append(
                rows.select(
                    F.lit(batch).alias("batch"),
                    F.lit(name).alias("domain"),
                    F.col(DOMAINS[name].key).alias("key"),
                    F.col(_NUMBER[name]).cast("double").alias("number"),
                    F.col(_TIME[name]).cast("timestamp_ntz").alias("happened_at"),
                )
            )
    return union_all(frames)


def _exports_sql() -> str:
    """Every exported line with its file."""
    parts = []
    for name in EXPORTED:
        spec = DOMAINS[name]
        parts.append(f"""
SELECT '{name}' AS domain, {spec.key} AS key, CAST({_NUMBER[name]} AS DOUBLE) AS number,
  CAST({_TIME[name]} AS TIMESTAMP) AS happened_at, (kafka_offset // 4) % {BROKEN} = 5 AS broken,
  '{spec.export_prefix}_' || lpad(CAST(kafka_offset % 4 * {PARTS} + kafka_offset // 4 % {PARTS} AS VARCHAR), 3, '0') AS file
FROM ({landing_sql(name)}) l_{name} WHERE {spec.key} IS NOT NULL AND op IS DISTINCT FROM 'd'""")
    return " UNION ALL ".join(parts)


QUERIES["load_exports"] = exported
ORACLES["load_exports"] = f"""
WITH lines AS ({_exports_sql()}),
files AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY file) <= floor(0.8 * count(*) OVER ())
    THEN 'initial' ELSE 'incremental' END AS batch FROM (SELECT DISTINCT file FROM lines) f)
SELECT batch, domain, key, number, happened_at FROM lines JOIN files USING (file) WHERE NOT broken
QUALIFY row_number() OVER (PARTITION BY batch, domain, key ORDER BY file DESC) = 1"""

QUERIES["export_summary"] = lambda spark, sf: export_summary(spark, export_files(spark, sf))
ORACLES["export_summary"] = f"""
SELECT domain, count(DISTINCT file) AS files, CAST(count(*) FILTER (WHERE NOT broken) AS BIGINT) AS records,
  CAST(count(*) FILTER (WHERE broken) AS BIGINT) AS errors
FROM ({_exports_sql()}) lines GROUP BY domain"""


#: Results of one run; every fifth document is cut off.
RUN = 500


def artefact_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows from run documents, one file each, and the files that cannot be read."""
    work = shared_dir(spark, "artefacts")
    results = run_results(spark, sf_dir).withColumns(
        {"message": F.substring("message", 1, 20), "_order": F.regexp_extract("unique_id", r"(\d+)$", 1).cast("long")}
    )
    runs = results.groupBy(F.floor(F.col("_order") / RUN).alias("run")).agg(  # ``RUN`` results at most
        F.collect_list(F.struct("unique_id", "status", "execution_time", "message", "timing")).alias("results")
    )
    document = F.to_json(
        F.struct(F.struct(F.concat(F.lit("i"), "run").alias("invocation_id")).alias("metadata"), "results"),
        {"pretty": "true"},
    )
    texts = runs.select("run", document.alias("value"))
    cut = F.when(F.col("run") % 5 == 2, F.expr("left(value, length(value) - 9)")).otherwise(F.col("value"))
    # each task puts its own files in place; one after the other in the driver takes long
    texts.select("run", cut.alias("value")).repartition("run").write.partitionBy("run").option(
        "mapreduce.fileoutputcommitter.algorithm.version", "2"
    ).text(work)
    read = shared_dir(spark, "artefacts-read")
    run_documents(spark, work).write.parquet(read)
    documents = spark.read.parquet(read)
    none = spark.createDataFrame([], "model string, rows_processed long")
    logged = processing_log(read_run_results(spark, work, documents), none, "r", F.lit(None).cast("timestamp"))
    broken = broken_run_results(spark, work, documents)
    return logged.select(
        F.col("dbt_invocation_id").alias("run"), "dbt_model", "status",
        F.col("duration_seconds").cast("double").alias("seconds"), "error_message",
        ms_to_ntz(F.unix_millis("started_at")).alias("started_at"),
    ).unionByName(
        broken.select(F.concat(F.lit("i"), F.regexp_extract("file", r"run=(\d+)", 1)).alias("run"), F.lit("unreadable").alias("status")),
        allowMissingColumns=True,
    )


QUERIES["read_run_results"] = artefact_log
ORACLES["read_run_results"] = f"""
SELECT 'i' || (o_orderkey // {RUN}) AS run, layer || '_t' || o_orderkey AS dbt_model,
  CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'success' END AS status,
  floor(o_totalprice + 0.5) / 1000.0 AS seconds,
  CASE WHEN o_orderstatus = 'F' THEN left(repeat(o_orderpriority, 300), 20) END AS error_message,
  date_trunc('day', o_orderdate)::TIMESTAMP + to_seconds(o_orderkey % 10) AS started_at
FROM (SELECT *, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver'
    WHEN 2 THEN 'gold' END AS layer FROM orders) o
WHERE layer IS NOT NULL AND o_orderkey // {RUN} % 5 <> 2
UNION ALL SELECT DISTINCT 'i' || (o_orderkey // {RUN}), NULL, 'unreadable', NULL, NULL, NULL
FROM orders WHERE o_orderkey // {RUN} % 5 = 2"""


def enriched_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search events whose producers have added fields, several of them of changing types."""
    n, quarter = F.col("event_id"), (F.col("event_id") % 100) * 25
    cents = F.concat(F.floor(quarter / 100), F.lit("."), F.lpad((quarter % 100).cast("string"), 2, "0"))
    fields = [
        F.concat(F.lit('"search_id":"'), n, F.lit('"')),
        F.when(n % 3 == 0, F.concat(F.lit('"tier":'), n % 5)),
        F.concat(F.lit('"score":'), F.when(n % 2 == 0, (n % 100).cast("string")).otherwise(cents)),
        F.concat(F.lit('"mixed":'), F.when(n % 2 == 0, (n % 7).cast("string")).otherwise(F.lit('"x"'))),
        F.when(n % 4 == 0, F.lit('"seen":"2024-01-01T00:00:00Z"')),
        F.when(n % 4 == 1, F.lit('"day":"2024-01-02"')),
        F.when(n % 10 == 0, F.concat(F.lit('"tags":[1,'), n % 3, F.lit("]"))),
        F.when(n % 10 == 1, F.lit('"box":{"w":1,"h":2.5}')),
        F.concat(F.lit('"only_'), n, F.lit('":1')),
        F.lit('"never":null'),
    ]
    value = F.concat(F.lit('{"after":{'), F.concat_ws(",", *fields), F.lit('},"op":"c","source":{"ts_ms":1}}'))
    return spread(table(spark, sf_dir, "events"), "event_id").select(
        F.lit(DOMAINS["search_events"].topic).alias("topic"),
        value.alias("value"),
        n.alias("kafka_offset"),
        F.lit(0).alias("kafka_partition"),
        F.lit(0).cast("long").alias("kafka_created_at"),
    )


def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landed rows hold beyond their contract; names that are data are added up."""
    found = discover_columns(land_domain(enriched_feed(spark, sf_dir), DOMAINS["search_events"]))
    single = F.col("field").startswith("only_")
    return found.groupBy(F.when(single, "only_*").otherwise(F.col("field")).alias("field"), "found", "proposed").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.max("pct_of_rows").alias("pct_of_rows")
    )


_ENRICHED = (  # field, type found, column proposed, rows that have it
    ("tier", "BIGINT", "BIGINT", "event_id % 3 = 0"),
    ("score", "DECIMAL(22,2)", "DECIMAL(22,2)", "true"),
    ("mixed", "VARIANT", "STRING", "true"),
    ("seen", "STRING", "TIMESTAMP", "event_id % 4 = 0"),
    ("day", "STRING", "DATE", "event_id % 4 = 1"),
    ("tags", "ARRAY<BIGINT>", "ARRAY<BIGINT>", "event_id % 10 = 0"),
    ("box", "OBJECT<h: DECIMAL(2,1), w: BIGINT>", "STRUCT<h: DECIMAL(2,1), w: BIGINT>", "event_id % 10 = 1"),
    ("never", "VOID", None, "true"),
    ("only_*", "BIGINT", "BIGINT", "true"),
)


def _found_sql(field: str, found: str, proposed: str | None, rows: str) -> str:
    shown = f"'{proposed}'" if proposed else "CAST(NULL AS VARCHAR)"
    share = "1" if field == "only_*" else f"count(*) FILTER (WHERE {rows})"
    nulls = "count(*)" if field == "never" else "0"
    return (
        f"SELECT '{field}' AS field, '{found}' AS found, {shown} AS proposed, "
        f"CAST(count(*) FILTER (WHERE {rows}) AS BIGINT) AS rows, CAST({nulls} AS BIGINT) AS nulls, "
        f"{rounded(share, 'count(*)', 100)} AS pct_of_rows FROM events"
    )


QUERIES["discover_columns"] = discovered
ORACLES["discover_columns"] = " UNION ALL ".join(_found_sql(*x) for x in _ENRICHED)


def promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows with a column for each field that a hundredth of them have."""
    landed = land_domain(enriched_feed(spark, sf_dir), DOMAINS["search_events"])
    whole = promote_columns(landed, proposed_schema(discover_columns(landed)))
    return whole.select(
        F.col("SEARCH_ID").alias("search_id"),
        F.col("TIER").alias("tier"),
        F.col("SCORE").cast("double").alias("score"),
        F.col("MIXED").alias("mixed"),
        ms_to_ntz(F.unix_millis("SEEN")).alias("seen"),
        F.col("DAY").cast("string").alias("day"),
        F.element_at("TAGS", -1).alias("last_tag"),
        F.col("BOX.h").cast("double").alias("height"),
        F.col(EXTRA).alias("extra"),
    )


QUERIES["promote_columns"] = promoted
ORACLES["promote_columns"] = """
SELECT CAST(event_id AS VARCHAR) AS search_id, CASE WHEN event_id % 3 = 0 THEN event_id % 5 END AS tier,
  CASE WHEN event_id % 2 = 0 THEN event_id % 100 ELSE event_id % 100 * 25 / 100.0 END AS score,
  CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 7 AS VARCHAR) ELSE 'x' END AS mixed,
  CASE WHEN event_id % 4 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS seen,
  CASE WHEN event_id % 4 = 1 THEN '2024-01-02' END AS day,
  CASE WHEN event_id % 10 = 0 THEN event_id % 3 END AS last_tag,
  CASE WHEN event_id % 10 = 1 THEN 2.5::DOUBLE END AS height,
  '{"never":null,"only_' || event_id || '":1}' AS extra FROM events"""
