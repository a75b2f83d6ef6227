"""SQL text shared by the oracle queries."""

from __future__ import annotations

from tidemark.spec import DOMAINS
from workloads.inputs import landing_sql

CONTROL = "op, source_ts_ms, kafka_offset, kafka_partition, kafka_created_at"
NEWEST = "source_ts_ms DESC NULLS LAST, kafka_offset DESC NULLS LAST, kafka_partition DESC NULLS LAST"


def projection(domain: str) -> str:
    """Bronze column list of a domain over its landing columns."""
    columns = []
    for name in DOMAINS[domain].source_schema.names:
        if domain == "payment_events" and name == "event":
            ms = (
                "CAST(floor(CAST(json_extract_string(event, '$.timestamp') AS DOUBLE) + 0.5)"
                " AS BIGINT)"
            )
            columns += [
                "json_extract_string(event, '$.event_name') AS event_name",
                f"{ms} AS event_timestamp_ms",
                f"make_timestamp({ms} * 1000) AS event_timestamp",
            ]
        elif domain == "search_events" and name == "timestamp":
            columns.append('"timestamp" AS search_timestamp')
        elif domain == "recommendations" and name == "timestamp":
            columns.append('"timestamp" AS event_timestamp')
        else:
            columns.append(name)
    return ", ".join(columns + [CONTROL])


def history_sql(domain: str) -> str:
    """Normalised change history: Bronze columns, tombstones gone, all versions."""
    return (
        f"SELECT {projection(domain)} FROM ({landing_sql(domain)}) landed "
        f"WHERE {DOMAINS[domain].key} IS NOT NULL"
    )


def bronze_sql(domain: str) -> str:
    """Latest row per key, deletes included."""
    key = DOMAINS[domain].key
    return (
        f"SELECT * FROM ({history_sql(domain)}) history "
        f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {NEWEST}) = 1"
    )


def silver_sql(domain: str) -> str:
    """Current state: latest row per key, then deletes out."""
    return f"SELECT * FROM ({bronze_sql(domain)}) latest WHERE op IS DISTINCT FROM 'd'"


def with_silver(*domains: str) -> str:
    """``WITH`` clause defining one ``s_<domain>`` per Silver table."""
    return "WITH " + ",\n".join(f"s_{d} AS ({silver_sql(d)})" for d in domains)


def cents(column: str) -> str:
    return f"CAST(floor(CAST({column} AS DOUBLE) * 100.0 + 0.5) AS BIGINT)"


def half_up(top: str, bottom: str) -> str:
    """Rounded integer quotient, halves away from zero; NULL for a zero bottom."""
    top, bottom = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)"
    return (
        f"(CASE WHEN {bottom} <> 0 THEN sign({top}) * sign({bottom}) * "
        f"((2 * abs({top}) + abs({bottom})) // (2 * abs({bottom}))) END)"
    )


def rounded(top: str, bottom: str, scale: int = 1) -> str:
    """``round(scale * top / bottom, 2)`` on integers."""
    return f"CAST({half_up(f'({top}) * {100 * scale}', bottom)} AS DOUBLE) / 100.0"


def mean(total: str, count: str) -> str:
    """``round(avg, 2)`` from a sum of cents."""
    return f"CAST({half_up(total, count)} AS DOUBLE) / 100.0"


def money(total: str) -> str:
    return f"CAST({total} AS DOUBLE) / 100.0"
