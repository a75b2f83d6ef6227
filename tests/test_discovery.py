"""Unknown fields of landed rows: their types, the columns proposed, and what stays behind."""

import json

from pyspark.sql import types as T

from tidemark.operators.discovery import discover_columns, promote_columns, proposed_schema
from tidemark.operators.merge import sync_columns


def landed(spark, *extras):
    rows = [(i, e if e is None or isinstance(e, str) else json.dumps(e)) for i, e in enumerate(extras)]
    return spark.createDataFrame(rows, "ID int, _EXTRA string")


def test_types_are_the_least_that_hold_all(spark):
    df = landed(spark, {"a": 1, "d": "2024-01-01", "t": "2024-01-01T00:00Z", "o": {"x": 1}},
                {"a": 2.5, "d": "2024-02-30x", "t": "2024-01-01 10:00:00+02:00", "o": {"y": None}},
                {"a": None, "m": [1, "x"], "n": None, "b": True}, None)
    found = {r["field"]: r for r in discover_columns(df).collect()}
    assert {k: r["proposed"] for k, r in found.items()} == {
        "a": "DECIMAL(21,1)", "d": "STRING", "t": "TIMESTAMP", "o": "STRING", "m": "STRING", "n": None, "b": "BOOLEAN"}
    assert (found["a"]["rows"], found["a"]["nulls"], found["a"]["pct_of_rows"]) == (3, 1, 75.0)
    assert found["o"]["found"] == "OBJECT<x: BIGINT, y: VOID>"


def test_only_frequent_fields_are_proposed(spark):
    df = landed(spark, *[{"all": i, f"user_{i}": i} for i in range(200)])
    schema = proposed_schema(discover_columns(df), 1.0)
    assert schema == T.StructType([T.StructField("all", T.LongType())])


def test_a_value_that_does_not_fit_stays(spark):
    df = landed(spark, {"n": 5, "k": "v"}, {"n": "many"}, {"n": None, "k": 1}, {"n": 2.5}, None, "broken")
    new = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("k", T.StringType())])
    rows = promote_columns(df, new).orderBy("ID").collect()
    assert [(r["N"], r["K"], r["_EXTRA"]) for r in rows] == [
        (5, "v", None), (None, None, '{"n":"many"}'), (None, "1", None), (None, None, '{"n":2.5}'),
        (None, None, None), (None, None, "broken")]
    assert promote_columns(df, T.StructType([])).collect() == df.collect()


def test_the_table_takes_the_new_columns(spark):
    stored = spark.createDataFrame([(7,)], "ID int").selectExpr("ID", "CAST(NULL AS STRING) AS _EXTRA")
    batch = landed(spark, {"n": 5})
    promoted = promote_columns(batch, proposed_schema(discover_columns(batch)))
    synced = sync_columns(stored, promoted)
    assert synced.unionByName(promoted).count() == 2 and dict(synced.dtypes)["N"] == "bigint"
