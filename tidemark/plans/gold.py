"""The six reports.

Every report has a grain of its own.  Facts are aggregated before any join and
dimensions are reduced to one row per business key, so joins meet at one row per key
on both sides.  Distinct counts aggregate the distinct value first and the group
second; no step ever needs a whole group in one task.

Report and column names are the public schema of the reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import amount, average, cents, ratio, seconds_between
from tidemark.operators.aggregates import change_reason
from tidemark.operators.joins import (
    SALTS,
    bridge_pairs,
    dedup_dimension,
    left_join_flag,
    sum_over_pairs,
    united_distinct,
)

# Payment stages and the report column holding each first instant.
STAGE_COLUMNS = {
    "created": "criado_em",
    "authorized": "autorizado_em",
    "captured": "capturado_em",
    "succeeded": "aprovado_em",
    "settled": "liquidado_em",
    "closed": "fechado_em",
    "refunded": "reembolsado_em",
}

# The funnel stages in declared order.
FUNNEL_STAGES = ("created", "authorized", "captured", "succeeded", "settled", "closed")


# -------------------------------------------------------------------- payments
def payment_lifecycle(payments: DataFrame) -> DataFrame:
    """One row per payment: volume, stage instants, outcome flags, time to close.

    Two levels: ``(payment, stage)`` first, then payment.  The first level combines
    map-side, so a payment with a third of all events arrives as a handful of rows,
    and the second level gets its distinct-stage count by counting those rows.
    """
    per_stage = (
        payments.filter(F.col("payment_id").isNotNull())
        .groupBy("payment_id", "event_name")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("event_timestamp").alias("_first"),
            F.max("event_timestamp").alias("_last"),
            F.max("event_timestamp_ms").alias("_last_ms"),
        )
    )
    stage = F.col("event_name")
    firsts = [
        F.min(F.when(stage == name, F.col("_first"))).alias(alias)
        for name, alias in STAGE_COLUMNS.items()
    ]
    per_payment = per_stage.groupBy("payment_id").agg(
        F.sum("_n").alias("total_eventos"),
        F.count("event_name").alias("etapas_distintas"),
        F.min("_first").alias("primeiro_evento"),
        F.max("_last").alias("ultimo_evento"),
        F.max("_last_ms").alias("ultimo_evento_ms"),
        *firsts,
        (F.count_if(stage == "refunded") > 0).alias("teve_reembolso"),
        (F.count_if(stage == "closed") > 0).alias("foi_fechado"),
    )
    return per_payment.withColumn(
        "segundos_ate_fechamento", seconds_between("criado_em", "fechado_em")
    )


def _lifecycle_comparison(payments: DataFrame, target: DataFrame) -> DataFrame:
    """``(payment_id, _new, _old, change)``, one row per payment known to either side."""
    fresh = payment_lifecycle(payments)
    columns = [name for name in fresh.columns if name != "payment_id"]
    rebuilt = fresh.select("payment_id", F.struct(*columns).alias("_new"))
    stored = target.select("payment_id", F.struct(*columns).alias("_old"))
    return rebuilt.join(stored, "payment_id", "full").withColumn(
        "change",
        change_reason(
            F.col("_new.total_eventos"),
            F.col("_new.ultimo_evento_ms"),
            F.col("_old.total_eventos"),
            F.col("_old.ultimo_evento_ms"),
        ),
    )


def payment_lifecycle_changes(payments: DataFrame, target: DataFrame) -> DataFrame:
    """Rows that bring an existing lifecycle table up to date, each with its ``change``.

    ``new``, ``count`` and ``moment`` rows are to be merged; a ``vanished`` row holds
    only its key, which is to be removed.  Finding the changed payments needs a pass
    over all payment events anyway, so that pass computes the complete row of every
    payment and keeps those that differ: each changed payment is rebuilt from its full
    history, without a second scan or a join back to the events.
    """
    return (
        _lifecycle_comparison(payments, target)
        .filter(F.col("change").isNotNull())
        .select("payment_id", "change", "_new.*")
    )


def payment_lifecycle_incremental(payments: DataFrame, target: DataFrame) -> DataFrame:
    """``target`` brought up to date: changed payments replaced, vanished ones removed.

    Equals :func:`payment_lifecycle` over the same events; unchanged payments keep
    their stored row.
    """
    row = F.when(F.col("change").isNull(), F.col("_old")).otherwise(F.col("_new"))
    return (
        _lifecycle_comparison(payments, target)
        .filter(~F.col("change").eqNullSafe("vanished"))
        .select("payment_id", row.alias("_row"))
        .select("payment_id", "_row.*")
    )


def _stage_volume(payments: DataFrame) -> DataFrame:
    """Events and distinct payments per stage, distinct payments counted first."""
    return (
        payments.filter(F.col("payment_id").isNotNull())
        .groupBy("event_name", "payment_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("event_timestamp").alias("_first"),
            F.max("event_timestamp").alias("_last"),
        )
        .groupBy("event_name")
        .agg(
            F.sum("_n").alias("eventos"),
            F.count(F.lit(1)).alias("pagamentos"),
            F.min("_first").alias("primeiro_evento"),
            F.max("_last").alias("ultimo_evento"),
        )
    )


def payments_by_status(payments: DataFrame) -> DataFrame:
    """Volume per stage and its share of all events."""
    volume = _stage_volume(payments)
    # The total reads every column of the volume, so that Spark recognises the same
    # exchange on both sides and computes it once.
    total = volume.agg(
        F.struct(
            F.sum("eventos").alias("eventos"),
            *[F.max(name) for name in volume.columns if name not in ("event_name", "eventos")],
        )
    ).scalar()["eventos"]
    return volume.select(
        "event_name",
        "eventos",
        "pagamentos",
        ratio(F.col("eventos"), total, 100).alias("pct_dos_eventos"),
        "primeiro_evento",
        "ultimo_evento",
    )


def payment_funnel(payments: DataFrame) -> DataFrame:
    """Conversion per declared stage against the top and the previous stage.

    Stages without events stay as zero rows; refunds are a side column, not a stage.
    The window runs over exactly one row per declared stage.
    """
    spark = payments.sparkSession
    names = [*FUNNEL_STAGES, "refunded"]
    declared = ", ".join(f"('{name}', {i})" for i, name in enumerate(names, 1))
    stages = spark.sql(f"SELECT * FROM VALUES {declared} AS stages(event_name, ordem)")
    volume = _stage_volume(payments.filter(F.col("event_name").isin(names)))
    # At most one row per declared stage on either side of this join and in the window.
    zero = F.lit(0).cast("bigint")
    filled = stages.join(volume, "event_name", "left").select(
        "ordem",
        "event_name",
        F.coalesce("eventos", zero).alias("eventos"),
        F.coalesce("pagamentos", zero).alias("pagamentos"),
    )
    order = Window.orderBy("ordem")
    refunds = F.max(F.when(F.col("event_name") == "refunded", F.col("eventos")))
    return (
        filled.withColumn("eventos_no_topo", F.first_value("eventos").over(order))
        .withColumn("eventos_etapa_anterior", F.lag("eventos").over(order))
        .withColumn("pct_do_topo", ratio("eventos", "eventos_no_topo", 100))
        .withColumn("pct_da_etapa_anterior", ratio("eventos", "eventos_etapa_anterior", 100))
        .withColumn("eventos_reembolso", refunds.over(Window.partitionBy()))
        .filter(F.col("event_name") != "refunded")
        .orderBy("ordem")
    )


# --------------------------------------------------------------------- drivers
def driver_performance(shifts: DataFrame, drivers: DataFrame) -> DataFrame:
    """Cumulative measures per driver; drivers without a registry row are kept."""
    issue = F.col("issues_reported")
    per_driver = (
        shifts.filter(F.col("driver_id").isNotNull())
        .groupBy("driver_id")
        .agg(
            F.count(F.lit(1)).alias("turnos"),
            F.sum(F.col("num_orders").cast("bigint")).alias("pedidos"),
            F.sum(cents("distance_covered_km")).alias("_km"),
            F.sum(cents("earnings_brl")).alias("_earned"),
            F.sum(F.col("shift_duration_min").cast("bigint")).alias("minutos_trabalhados"),
            F.sum(cents("shift_rating")).alias("_rating"),
            F.count("shift_rating").alias("_rated"),
            # the text 'None' means that nothing was reported
            F.count_if(issue.isNotNull() & (issue != "None")).alias("turnos_com_problema"),
            F.count_if(F.col("available")).alias("turnos_disponivel"),
            F.min("start_time").alias("primeiro_turno"),
            F.max("end_time").alias("ultimo_turno"),
        )
    )
    registry = dedup_dimension(drivers, "driver_id").select(
        "driver_id", F.col("uuid").alias("driver_uuid"),
        "first_name", "last_name", "city", "country", "vehicle_type",
    )
    return left_join_flag(per_driver, registry, "driver_id", "sem_cadastro").select(
        "driver_id", "driver_uuid", "first_name", "last_name", "city", "country", "vehicle_type",
        "turnos",
        "pedidos",
        amount("_km").alias("km_percorridos"),
        amount("_earned").alias("ganhos_brl"),
        "minutos_trabalhados",
        average("_rating", "_rated").alias("rating_medio"),
        "turnos_com_problema",
        "turnos_disponivel",
        ratio("_earned", "_km").alias("ganho_por_km"),
        # cents per minute * 60 / 100 = currency per hour
        ratio(F.col("_earned") * 60, F.col("minutos_trabalhados") * 100).alias("ganho_por_hora"),
        ratio("pedidos", "turnos").alias("pedidos_por_turno"),
        ratio("turnos_com_problema", "turnos", 100).alias("pct_turnos_com_problema"),
        "primeiro_turno",
        "ultimo_turno",
        "sem_cadastro",
    )


# ----------------------------------------------------------------- restaurants
def revenue_per_restaurant(
    items: DataFrame, restaurants: DataFrame, approximate_distinct: bool = False
) -> DataFrame:
    """Revenue and product mix per restaurant; unknown restaurants are kept.

    ``approximate_distinct`` swaps the two exact distinct counts for sketches; it
    trades exactness for one shuffle less and is off by default.
    """
    distinct = F.approx_count_distinct if approximate_distinct else F.count_distinct
    per_restaurant = (
        items.filter(F.col("restaurant_id").isNotNull())
        .groupBy("restaurant_id")
        .agg(
            F.count(F.lit(1)).alias("itens_vendidos"),
            distinct("order_id").alias("pedidos"),
            distinct("product_id").alias("produtos_distintos"),
            F.sum(F.col("quantity").cast("bigint")).alias("unidades"),
            F.sum(cents("subtotal")).alias("_gross"),
            F.sum(cents("discount_applied")).alias("_discount"),
            F.sum(cents("unit_price")).alias("_price"),
            F.count("unit_price").alias("_priced"),
            F.count_if(F.col("is_combo")).alias("itens_combo"),
            F.count_if(F.col("is_vegetarian")).alias("itens_vegetarianos"),
        )
        .withColumn("_net", F.col("_gross") - F.col("_discount"))
    )
    registry = dedup_dimension(restaurants, "restaurant_id").select(
        "restaurant_id", F.col("uuid").alias("restaurant_uuid"), "cnpj",
        F.col("name").alias("restaurante"), "city", "country", "cuisine_type",
        "average_rating", "num_reviews",
    )
    return left_join_flag(per_restaurant, registry, "restaurant_id", "sem_cadastro").select(
        "restaurant_id", "restaurant_uuid", "cnpj", "restaurante", "city", "country",
        "cuisine_type", "average_rating", "num_reviews",
        "itens_vendidos",
        "pedidos",
        "produtos_distintos",
        "unidades",
        amount("_gross").alias("receita_bruta"),
        amount("_discount").alias("descontos"),
        amount("_net").alias("receita_liquida"),
        average("_price", "_priced").alias("preco_medio_unitario"),
        "itens_combo",
        "itens_vegetarianos",
        average("_net", "pedidos").alias("receita_por_pedido"),
        ratio("itens_vendidos", "pedidos").alias("itens_por_pedido"),
        ratio("_discount", "_gross", 100).alias("pct_desconto"),
        ratio("itens_combo", "itens_vendidos", 100).alias("pct_combo"),
        "sem_cadastro",
    )


# ----------------------------------------------------------------------- users
def user_behavior(
    profiles: DataFrame,
    extended: DataFrame,
    orders: DataFrame,
    searches: DataFrame,
    recommendations: DataFrame,
    salts: int = SALTS,
) -> DataFrame:
    """Orders, searches and recommendation activity per person.

    Orders join on the tax number, searches and recommendations on the numeric id.
    The id bridge keeps every id of a person; the two profile registries are reduced
    to one row per tax number.  Searches and recommendations shrink to one row per
    id before they cross the bridge; a hot id's terms are dealt over ``salts`` parts.
    """
    zero = F.lit(0).cast("bigint")
    profile = dedup_dimension(profiles, "cpf").select(
        "cpf", "user_id", F.col("uuid").alias("user_uuid"), "email", "city", "country"
    )
    more = dedup_dimension(extended, "cpf").select(
        "cpf", "first_name", "last_name", "job", "company_name"
    )
    bought = (
        orders.filter(F.col("user_key").isNotNull())
        .groupBy(F.col("user_key").alias("cpf"))
        .agg(
            F.count(F.lit(1)).alias("_orders"),
            F.sum(cents("total_amount")).alias("_spent"),
            F.count("total_amount").alias("_amounts"),
            F.min("order_date").alias("primeiro_pedido"),
            F.max("order_date").alias("ultimo_pedido"),
            F.count_distinct("restaurant_key").alias("_restaurants"),
        )
    )

    # One row per id.  The three parts are grouped by the same id, so putting them side
    # by side and sending them over the bridge costs one shuffle, not three.
    # Searches are read once: first per id and term, then per id.
    per_term = searches.filter(F.col("user_id").isNotNull()).groupBy("user_id", "query_text").agg(
        F.count(F.lit(1)).alias("_searches"),
        F.sum(F.col("result_count").cast("bigint")).alias("_results"),
        F.count("result_count").alias("_counted"),
        F.count("clicked_product_id").alias("_clicked"),
    )
    measured = ("_searches", "_results", "_counted", "_clicked")
    searched = per_term.groupBy("user_id").agg(
        *[F.sum(name).alias(name) for name in measured],
        F.nullif(F.count("query_text"), F.lit(0)).alias("_id_terms"),
    )
    values = per_term.filter(F.col("query_text").isNotNull()).select("user_id", "query_text")
    kind = F.col("event_type")
    viewed = recommendations.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_recs"),
        F.count_if(kind == "recommendation_served").alias("_served"),
        F.count_if(kind == "view").alias("_viewed"),
        F.count_if(kind == "click").alias("_rec_clicks"),
        F.count_if(kind == "add_to_cart").alias("_carted"),
    )
    per_id = searched.join(viewed, "user_id", "full")

    pairs = bridge_pairs(profiles, "user_id", "cpf")
    measures = [name for name in per_id.columns if name != "user_id"]
    active = sum_over_pairs(per_id, pairs, "user_id", "cpf", measures)
    # Terms of a person with several ids overlap: their union replaces the sum.
    united = united_distinct(values, pairs, "user_id", "cpf", "query_text", "_united", salts)

    joined = left_join_flag(profile, more, "cpf", "sem_perfil_estendido")
    for part in (bought, active, united):
        joined = joined.join(part, "cpf", "left")
    return joined.select(
        "cpf", "user_id", "user_uuid", "first_name", "last_name", "email", "city", "country",
        "job", "company_name",
        F.coalesce("_orders", zero).alias("pedidos"),
        amount(F.coalesce("_spent", zero)).alias("gasto_total"),
        average("_spent", "_amounts").alias("ticket_medio"),
        "primeiro_pedido",
        "ultimo_pedido",
        F.coalesce("_restaurants", zero).alias("restaurantes_distintos"),
        F.coalesce("_searches", zero).alias("buscas"),
        F.coalesce("_united", "_id_terms", zero).alias("termos_distintos"),
        ratio("_results", "_counted").alias("resultados_medios"),
        F.coalesce("_clicked", zero).alias("buscas_com_clique"),
        F.coalesce("_recs", zero).alias("recomendacoes"),
        F.coalesce("_served", zero).alias("rec_exibidas"),
        F.coalesce("_viewed", zero).alias("rec_vistas"),
        F.coalesce("_rec_clicks", zero).alias("rec_clicadas"),
        F.coalesce("_carted", zero).alias("rec_no_carrinho"),
        ratio("_rec_clicks", "_recs", 100).alias("pct_clique_recomendacao"),
        ratio("_clicked", "_searches", 100).alias("pct_busca_com_clique"),
        (F.coalesce("_orders", zero) == 0).alias("nunca_comprou"),
        "sem_perfil_estendido",
    )


#: Report name -> function over Silver tables, with the Silver tables it reads.
REPORTS = {
    "payment_lifecycle": (payment_lifecycle, ("payment_events",)),
    "payments_by_status": (payments_by_status, ("payment_events",)),
    "payment_funnel": (payment_funnel, ("payment_events",)),
    "driver_performance": (driver_performance, ("driver_shifts", "drivers")),
    "revenue_per_restaurant": (revenue_per_restaurant, ("order_items", "restaurants")),
    "user_behavior": (
        user_behavior,
        ("users_mongo", "users_mssql", "orders", "search_events", "recommendations"),
    ),
}

__all__ = [
    "FUNNEL_STAGES",
    "REPORTS",
    "STAGE_COLUMNS",
    "driver_performance",
    "payment_funnel",
    "payment_lifecycle",
    "payment_lifecycle_changes",
    "payment_lifecycle_incremental",
    "payments_by_status",
    "revenue_per_restaurant",
    "user_behavior",
]
