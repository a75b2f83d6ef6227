"""Run registered queries against their SQL counterparts in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """A value both engines' clients agree on."""
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in data), key=lambda r: tuple(map(repr, r))
    )


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def compare(df, con, sql) -> str | None:
    """None when both sides agree, else a description of the first difference."""
    described = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in df.dtypes:
        if name in described and SAME_TYPE.get(kind) != described[name]:
            return f"{name} is {kind}, expected {described[name]}"
    got_columns = df.columns
    got = rows(got_columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = rows(want_columns, result.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(set(got_columns) ^ set(want_columns))} differ"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for left, right in zip(got, want):
        if left != right or [type(v) for v in left] != [type(v) for v in right]:
            return f"{sorted(got_columns)}\n  got  {left}\n  want {right}"
    return None if got else "EMPTY"
