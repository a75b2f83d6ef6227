"""Reports on hand-written Silver tables."""

import random
from collections import defaultdict

import pytest

from tidemark.operators.aggregates import changed_keys
from tidemark.operators.joins import bridge_distinct, salted_join
from tidemark.plans import gold

PAYMENTS = "event_id int, payment_id string, event_name string, event_timestamp_ms long"


def payments(spark, rows):
    from tidemark.functions import ms_to_ntz

    df = spark.createDataFrame(
        [(i, p, name, ms) for i, (p, name, ms) in enumerate(rows)], PAYMENTS
    )
    return df.withColumn("event_timestamp", ms_to_ntz("event_timestamp_ms"))


def by_key(df, key):
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r.asDict() for r in rows}


FIRST = [("p1", "created", 1000), ("p1", "authorized", 61_000), ("p2", "created", 500_000)]


def test_closed_event_alone_keeps_earlier_stages(spark):
    target = gold.payment_lifecycle(payments(spark, FIRST))
    now = payments(spark, FIRST + [("p1", "closed", 121_500)])
    rows = by_key(gold.payment_lifecycle_changes(now, target), "payment_id")
    assert set(rows) == {"p1"} and rows["p1"]["change"] == "count"
    assert rows["p1"]["criado_em"] is not None and rows["p1"]["autorizado_em"] is not None
    assert rows["p1"]["segundos_ate_fechamento"] == 120 and rows["p1"]["foi_fechado"]


def test_event_older_than_other_payments_is_noticed(spark):
    target = gold.payment_lifecycle(payments(spark, FIRST))
    now = payments(spark, FIRST + [("p1", "captured", 30_000)])
    keys = changed_keys(
        now, target, "payment_id", "event_timestamp_ms", "total_eventos", "ultimo_evento_ms"
    )
    assert [tuple(r) for r in keys.collect()] == [("p1", "count")]


def test_vanished_payment(spark):
    target = gold.payment_lifecycle(payments(spark, FIRST))
    changes = gold.payment_lifecycle_changes(payments(spark, FIRST[:2]), target)
    assert [(r["payment_id"], r["change"]) for r in changes.collect()] == [("p2", "vanished")]


@pytest.mark.parametrize("seed", range(3))
def test_incremental_equals_full(spark, seed):
    """Any two-batch split, with removed and re-timed events, ends in the full report."""
    rng = random.Random(seed)
    stages = list(gold.STAGE_COLUMNS)
    events = [(f"p{rng.randrange(6)}", rng.choice(stages), rng.randrange(10**6)) for _ in range(60)]
    before = rng.sample(events, 35) + [("gone", "created", 5)]
    target = gold.payment_lifecycle(payments(spark, before))
    now = payments(spark, events)
    got = gold.payment_lifecycle_incremental(now, target)
    assert by_key(got, "payment_id") == by_key(gold.payment_lifecycle(now), "payment_id")


def test_status_and_funnel(spark):
    df = payments(spark, [("a", "created", 1), ("a", "created", 2), ("b", "created", 3),
                          ("a", "captured", 4), ("a", "refunded", 5), (None, "created", 6)])
    status = by_key(gold.payments_by_status(df), "event_name")
    assert status["created"]["eventos"] == 3 and status["created"]["pagamentos"] == 2
    assert status["created"]["pct_dos_eventos"] == 60.0
    funnel = [r.asDict() for r in gold.payment_funnel(df).collect()]
    assert [r["event_name"] for r in funnel] == list(gold.FUNNEL_STAGES)
    assert [r["eventos"] for r in funnel] == [3, 0, 1, 0, 0, 0]
    assert funnel[1]["pct_da_etapa_anterior"] == 0.0
    assert funnel[2]["pct_da_etapa_anterior"] is None  # nothing in the stage before
    assert funnel[2]["pct_do_topo"] == 33.33
    assert {r["eventos_reembolso"] for r in funnel} == {1}


def test_funnel_without_events(spark):
    funnel = gold.payment_funnel(payments(spark, []).limit(0)).collect()
    assert [r["eventos"] for r in funnel] == [0] * 6
    assert {r["pct_do_topo"] for r in funnel} == {None}
    assert {r["eventos_reembolso"] for r in funnel} == {0}


TRACE = "source_ts_ms long, kafka_offset long"


def test_driver_report(spark):
    shifts = spark.createDataFrame(
        [("7", 3, 10.0, 100.5, 60, 4.5, "None", True), ("7", 2, 5.5, 50.0, 30, None, "Late Start", False),
         ("8", 1, 0.0, 10.0, 0, 5.0, None, None)],
        "driver_id string, num_orders int, distance_covered_km double, earnings_brl double, "
        "shift_duration_min int, shift_rating double, issues_reported string, available boolean",
    ).selectExpr("*", "timestamp_ntz'2024-01-01 08:00:00' AS start_time",
                 "timestamp_ntz'2024-01-01 09:00:00' AS end_time")
    # two registry rows for one driver must not double the sums
    drivers = spark.createDataFrame(
        [("u1", "7", "Old", 1, 1), ("u2", "7", "New", 2, 2)],
        f"uuid string, driver_id string, first_name string, {TRACE}",
    ).selectExpr("*", "'L' AS last_name", "'C' AS city", "'B' AS country", "'car' AS vehicle_type")
    rows = by_key(gold.driver_performance(shifts, drivers), "driver_id")
    seven, eight = rows["7"], rows["8"]
    assert seven["turnos"] == 2 and seven["first_name"] == "New" and not seven["sem_cadastro"]
    assert seven["ganhos_brl"] == 150.5 and seven["ganho_por_km"] == 9.71
    assert seven["ganho_por_hora"] == 100.33 and seven["rating_medio"] == 4.5
    assert seven["turnos_com_problema"] == 1 and seven["pct_turnos_com_problema"] == 50.0
    assert eight["sem_cadastro"] and eight["turnos_com_problema"] == 0
    assert eight["ganho_por_km"] is None and eight["ganho_por_hora"] is None


def test_user_report(spark):
    profiles = spark.createDataFrame(
        [("m1", 1, "111", 1, 1), ("m2", 2, "111", 2, 2), ("m3", 3, "333", 1, 3), ("m4", 4, None, 1, 4)],
        f"uuid string, user_id int, cpf string, {TRACE}",
    ).selectExpr("*", "'e' AS email", "'c' AS city", "'b' AS country")
    extended = spark.createDataFrame(
        [("q1", "111", "Ann", 1, 1)], f"uuid string, cpf string, first_name string, {TRACE}"
    ).selectExpr("*", "'L' AS last_name", "'J' AS job", "'K' AS company_name")
    orders = spark.createDataFrame(
        [("111", 10.25, "r1"), ("111", 20.0, "r2"), ("111", None, "r2"), ("999", 1.0, "r1")],
        "user_key string, total_amount double, restaurant_key string",
    ).selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' AS order_date")
    searches = spark.createDataFrame(
        [(1, "pizza", 3, "x"), (2, "pizza", 4, None), (2, "sushi", None, None), (9, "zzz", 1, None),
         (3, None, 1, None)],
        "user_id int, query_text string, result_count int, clicked_product_id string",
    )
    recommendations = spark.createDataFrame(
        [(1, "view"), (2, "click"), (2, "click"), (3, "add_to_cart")], "user_id int, event_type string"
    )
    rows = by_key(gold.user_behavior(profiles, extended, orders, searches, recommendations), "cpf")
    assert set(rows) == {"111", "333"}
    ann, other = rows["111"], rows["333"]
    assert ann["user_uuid"] == "m2" and ann["first_name"] == "Ann"
    # both ids of the person count, each order once
    assert (ann["pedidos"], ann["gasto_total"], ann["ticket_medio"]) == (3, 30.25, 15.13)
    assert ann["restaurantes_distintos"] == 2
    assert (ann["buscas"], ann["termos_distintos"], ann["buscas_com_clique"]) == (3, 2, 1)
    assert ann["resultados_medios"] == 3.5 and ann["pct_busca_com_clique"] == 33.33
    assert ann["recomendacoes"] == 3 and ann["pct_clique_recomendacao"] == 66.67
    assert not ann["nunca_comprou"] and not ann["sem_perfil_estendido"]
    assert other["nunca_comprou"] and other["sem_perfil_estendido"]
    assert (other["pedidos"], other["gasto_total"], other["ticket_medio"]) == (0, 0.0, None)
    assert (other["buscas"], other["termos_distintos"]) == (1, 0)


def test_bridge_distinct_against_brute_force(spark):
    rng = random.Random(5)
    # one id holds most facts and belongs to several groups
    facts = [(0 if rng.random() < 0.7 else rng.randrange(1, 12), f"t{rng.randrange(40)}")
             for _ in range(2_000)]
    bridge = [(f"g{rng.randrange(8)}", rng.randrange(12)) for _ in range(20)] + [("solo", 0)]
    want = defaultdict(set)
    for group, ident in bridge:
        want[group] |= {t for i, t in facts if i == ident}
    got = bridge_distinct(
        spark.createDataFrame(facts, "user_id int, term string"),
        spark.createDataFrame(bridge, "cpf string, user_id int"),
        "user_id", "cpf", "term", "n",
    )
    assert {r["cpf"]: r["n"] for r in got.collect()} == {g: len(t) for g, t in want.items() if t}


def test_salted_join_keeps_every_pair_once(spark):
    big = spark.range(1000).selectExpr("CASE WHEN id < 900 THEN 0 ELSE id END AS k", "id AS row")
    small = spark.createDataFrame([(0, "a"), (0, "b"), (950, "c")], "k long, tag string")
    from pyspark.sql import functions as F

    joined = salted_join(big, small, "k", F.col("row"))
    assert joined.count() == 900 * 2 + 1
    assert joined.select("row", "tag").distinct().count() == 1801


def test_approximate_distinct_is_optional(spark):
    items = spark.range(300).selectExpr(
        "1 AS restaurant_id", "CAST(id AS STRING) AS order_id", "CAST(id % 7 AS STRING) AS product_id",
        "1 AS quantity", "2.5D AS subtotal", "0.5D AS discount_applied", "2.5D AS unit_price",
        "id % 2 = 0 AS is_combo", "false AS is_vegetarian",
    )
    registry = spark.createDataFrame(
        [], f"uuid string, restaurant_id int, cnpj string, name string, city string, country string, "
            f"cuisine_type string, average_rating double, num_reviews int, {TRACE}")
    exact = gold.revenue_per_restaurant(items, registry).collect()[0]
    rough = gold.revenue_per_restaurant(items, registry, approximate_distinct=True).collect()[0]
    assert exact["pedidos"] == 300 and exact["produtos_distintos"] == 7
    assert abs(rough["pedidos"] - 300) < 45
    assert exact["receita_liquida"] == 600.0 and exact["sem_cadastro"] and exact["pct_combo"] == 50.0
