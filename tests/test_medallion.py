"""The layered run from landing tables to checked reports."""

import pytest
from support import SF
from pyspark.sql import functions as F

from tidemark.operators.quality import enforce
from tidemark.plans import gold
from tidemark.plans.medallion import Medallion
from tidemark.spec import DOMAINS
from workloads.inputs import landing
from workloads.layers import silver


@pytest.fixture(scope="module")
def feeds(spark):
    """Landing history of every domain and the two batches it arrives in."""
    whole = {name: landing(spark, SF, name) for name in DOMAINS}
    arrived = F.col("RECORD_METADATA.CreateTime")
    middle = {n: df.agg(F.percentile_approx(arrived, 0.6)).first()[0] for n, df in whole.items()}
    first = {n: df.filter(arrived <= middle[n]) for n, df in whole.items()}
    second = {n: df.filter(arrived > middle[n]) for n, df in whole.items()}
    return whole, first, second


def rows(df):
    return sorted(map(repr, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


def test_two_batches_equal_one_history(spark, feeds, work):
    whole, first, second = feeds
    layers = Medallion(spark, work)
    layers.run(first, first)
    assert layers.gold_table("payment_lifecycle").version() == 1
    layers.run(second, whole)
    for name in DOMAINS:
        assert rows(layers.read_silver(name)) == rows(silver(spark, SF, name)), name
    for name, (report, inputs) in gold.REPORTS.items():
        want = report(*[silver(spark, SF, d) for d in inputs])
        assert rows(layers.gold_table(name).read()) == rows(want), name

    log = layers.log("run-2")
    assert log.count() == 26 and {r["status"] for r in log.collect()} == {"success"}
    assert spark.read.parquet(f"{work}/processing_log").count() == 26

    verdicts = layers.check().cache()
    assert verdicts.count() == 185
    broken = {r["check"] for r in verdicts.filter("status = 'error'").collect()}
    # the feeds carry rows without an operation on purpose
    assert broken == {f"not_null_bronze_{n}_op" for n in DOMAINS if n != "drivers"}
    with pytest.raises(AssertionError, match="9 checks failed"):
        enforce(verdicts)


def test_log_contract_keeps_history(spark, feeds, work):
    whole, _, _ = feeds
    contracts = spark.createDataFrame(
        [("orders", "fact", "log", "order_id", True)],
        "table_name string, table_type string, cdc_strategy string, unique_key string, active boolean",
    )
    layers = Medallion(spark, work, contracts=contracts, domains=("orders",),
                       materialise_silver=True)
    layers.run(whole, whole)
    history = layers.read_silver("orders")
    assert history.filter("op = 'd'").count() > 0
    assert history.count() == whole["orders"].filter("ORDER_ID IS NOT NULL").count()

    # back under the default contract, the copy of the history must not be served
    again = Medallion(spark, work, domains=("orders",))
    assert again.read_silver("orders").filter("op = 'd'").count() == 0


def test_failed_model_is_named(spark, feeds, work):
    whole, _, _ = feeds
    layers = Medallion(spark, work, domains=("drivers",))
    with pytest.raises(RuntimeError, match="bronze_drivers"):
        layers.run({"drivers": whole["drivers"].drop("UUID")}, whole)
    assert layers.results[0][1] == "error" and layers.results[0][2]
