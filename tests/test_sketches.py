"""Mergeable sketches against exact counts, and reconciliation by digests."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import reconcile, reconcile_by_digests
from tidemark.operators.sketches import (
    append_sketches,
    distinct_sketches,
    heavy_sketches,
    read_distinct,
    top_items,
)


def test_batches_and_days_are_merged(spark, work):
    """What several batches and days share is counted once; a batch written again counts once."""
    facts = spark.range(60_000).selectExpr(
        "id % 3 AS g", "date_add(date'2024-01-01', int(id % 5)) AS day", "id % 20000 AS v", "CAST(NULL AS INT) AS w")
    for batch, part in ((0, "id < 30000"), (1, "id >= 20000"), (1, "id >= 20000")):
        rows = spark.range(60_000).filter(part).selectExpr(
            "id % 3 AS g", "date_add(date'2024-01-01', int(id % 5)) AS day", "id % 20000 AS v", "CAST(NULL AS INT) AS w")
        append_sketches(distinct_sketches(rows, ["g", "day"], ["v", "w"]), work, batch)
    whole = read_distinct(spark, work, [], ["v", "w"]).first()
    assert abs(whole["v"] - 20_000) <= 600 and whole["w"] == 0
    exact = {r["g"]: r["n"] for r in facts.groupBy("g").agg(F.countDistinct("v").alias("n")).collect()}
    for r in read_distinct(spark, work, ["g"], ["v"]).collect():
        assert abs(r["v"] - exact[r["g"]]) <= 0.03 * exact[r["g"]]


@pytest.mark.parametrize("shape", ["skewed", "even", "few", "none"])
def test_top_items_are_exact(spark, work, shape):
    """Also where nothing is frequent, where sketches lose items, and where there are fewer than k."""
    item = {
        "skewed": "CAST(CASE WHEN id % 4 = 0 THEN id % 3 ELSE id END AS STRING)",
        "even": "CAST(id % 997 AS STRING)", "few": "CAST(id % 2 AS STRING)", "none": "CAST(NULL AS STRING)",
    }[shape]
    rows = spark.range(20_000).selectExpr(f"{item} AS item", "id % 24 AS hour")
    heavy_sketches(rows, ["hour"], "item", 64).write.parquet(work)
    got = top_items(rows, spark.read.parquet(work), "item", 3, 64).collect()
    want = rows.filter("item IS NOT NULL").groupBy("item").count().orderBy(F.desc("count"), "item").limit(3).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def sides(spark, changes):
    facts = spark.range(3000).selectExpr("CAST(id % 1000 AS STRING) AS payment_id", "id AS event_timestamp_ms")
    report = facts.groupBy("payment_id").agg(
        F.count(F.lit(1)).alias("total_eventos"), F.max("event_timestamp_ms").alias("ultimo_evento_ms"))
    for change in changes:
        report = change(report)
    return facts, report


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("ranges", [1, 16, 4096])
def test_digests_find_what_the_full_join_finds(spark, ranges):
    changes = [
        lambda r: r.filter("payment_id <> '7'"),
        lambda r: r.withColumn("total_eventos", F.expr("total_eventos + int(payment_id = '8')")),
        lambda r: r.withColumn("ultimo_evento_ms", F.expr("CASE WHEN payment_id = '9' THEN NULL ELSE ultimo_evento_ms END")),
        lambda r: r.unionByName(r.limit(1).withColumn("payment_id", F.lit("new"))),
    ]
    facts, report = sides(spark, changes)
    got = reconcile_by_digests(facts, report, ranges=ranges)
    assert rows(got) == rows(reconcile(facts, report))
    assert {r["motivo"] for r in got.collect()} == {"lacking", "count", "newest", "unfounded"}


def test_counts_that_make_up_for_each_other_are_seen(spark):
    swap = F.expr("total_eventos + CASE payment_id WHEN '1' THEN 1 WHEN '2' THEN -1 ELSE 0 END")
    facts, report = sides(spark, [lambda r: r.withColumn("total_eventos", swap)])
    assert reconcile_by_digests(facts, report, ranges=1).count() == 2


def joined_rows(df):
    """Rows that reach the full outer join, from both sides."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan


def test_keys_of_parts_that_agree_never_meet(spark):
    """The filter by parts is below the full join, and the facts are grouped once."""
    facts, report = sides(spark, [lambda r: r.filter("payment_id <> '7'")])
    df = reconcile_by_digests(facts, report)
    plan = joined_rows(df)
    assert "LeftSemi" in plan and "FullOuter" in plan
    part = F.pmod(F.xxhash64(F.lit("7")), F.lit(4096))
    same = report.filter(F.pmod(F.xxhash64("payment_id"), F.lit(4096)) == part).count()
    assert df.count() == 1 and same <= 5  # of a thousand keys, few share the part that is joined
