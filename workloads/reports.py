"""Queries for the reports and their building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import changed_keys, pivot_first, share_of_total
from tidemark.operators.joins import (
    bridge_aggregate,
    bridge_distinct,
    dedup_dimension,
    left_join_flag,
)
from tidemark.plans import gold
from workloads.inputs import table
from workloads.layers import silver
from workloads.sql import cents, mean, money, rounded, with_silver

QUERIES = {}
ORACLES = {}


def _report(name: str):
    report, inputs = gold.REPORTS[name]
    return lambda spark, sf: report(*[silver(spark, sf, d) for d in inputs])


for _name in gold.REPORTS:
    QUERIES[_name] = _report(_name)

_FIRSTS = ",\n  ".join(
    f"min(event_timestamp) FILTER (event_name = '{stage}') AS {column}"
    for stage, column in gold.STAGE_COLUMNS.items()
)
LIFECYCLE = f"""
SELECT payment_id, count(*) AS total_eventos, count(DISTINCT event_name) AS etapas_distintas,
  min(event_timestamp) AS primeiro_evento, max(event_timestamp) AS ultimo_evento,
  max(event_timestamp_ms) AS ultimo_evento_ms,
  {_FIRSTS},
  bool_or(event_name = 'refunded') AS teve_reembolso,
  bool_or(event_name = 'closed') AS foi_fechado,
  date_diff('second', min(event_timestamp) FILTER (event_name = 'created'),
    min(event_timestamp) FILTER (event_name = 'closed')) AS segundos_ate_fechamento
FROM s_payment_events WHERE payment_id IS NOT NULL GROUP BY payment_id"""
ORACLES["payment_lifecycle"] = with_silver("payment_events") + LIFECYCLE

ORACLES["payments_by_status"] = with_silver("payment_events") + f"""
SELECT event_name, eventos, pagamentos,
  {rounded('eventos', '(SELECT count(*) FROM s_payment_events WHERE payment_id IS NOT NULL)', 100)}
    AS pct_dos_eventos, primeiro_evento, ultimo_evento
FROM (
  SELECT event_name, count(*) AS eventos, count(DISTINCT payment_id) AS pagamentos,
    min(event_timestamp) AS primeiro_evento, max(event_timestamp) AS ultimo_evento
  FROM s_payment_events WHERE payment_id IS NOT NULL GROUP BY event_name) v"""

_STAGES = ", ".join(f"({i}, '{s}')" for i, s in enumerate(gold.FUNNEL_STAGES, 1))
ORACLES["payment_funnel"] = with_silver("payment_events") + f""",
declared(ordem, event_name) AS (VALUES {_STAGES}),
volume AS (
  SELECT ordem, d.event_name, count(p.payment_id) AS eventos,
    count(DISTINCT p.payment_id) AS pagamentos
  FROM declared d LEFT JOIN s_payment_events p
    ON p.event_name = d.event_name AND p.payment_id IS NOT NULL
  GROUP BY 1, 2),
placed AS (
  SELECT v.*, (SELECT eventos FROM volume WHERE ordem = 1) AS eventos_no_topo,
    prior.eventos AS eventos_etapa_anterior
  FROM volume v LEFT JOIN volume prior ON prior.ordem = v.ordem - 1)
SELECT ordem, event_name, eventos, pagamentos, eventos_no_topo, eventos_etapa_anterior,
  {rounded('eventos', 'eventos_no_topo', 100)} AS pct_do_topo,
  {rounded('eventos', 'eventos_etapa_anterior', 100)} AS pct_da_etapa_anterior,
  (SELECT count(*) FROM s_payment_events WHERE event_name = 'refunded'
    AND payment_id IS NOT NULL) AS eventos_reembolso
FROM placed"""

_NEWEST = "source_ts_ms DESC NULLS LAST, kafka_offset DESC NULLS LAST, kafka_partition DESC NULLS LAST"


def _one_per(domain: str, key: str) -> str:
    return (
        f"(SELECT * FROM s_{domain} WHERE {key} IS NOT NULL QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {_NEWEST}) = 1)"
    )


ORACLES["driver_performance"] = with_silver("driver_shifts", "drivers") + f""",
t AS (
  SELECT driver_id, count(*) AS turnos, CAST(sum(num_orders) AS BIGINT) AS pedidos,
    sum({cents('distance_covered_km')}) AS km, sum({cents('earnings_brl')}) AS earned,
    CAST(sum(shift_duration_min) AS BIGINT) AS minutos_trabalhados,
    sum({cents('shift_rating')}) AS rating, count(shift_rating) AS rated,
    count(*) FILTER (issues_reported <> 'None') AS turnos_com_problema,
    count(*) FILTER (available) AS turnos_disponivel,
    min(start_time) AS primeiro_turno, max(end_time) AS ultimo_turno
  FROM s_driver_shifts WHERE driver_id IS NOT NULL GROUP BY driver_id)
SELECT t.driver_id, d.uuid AS driver_uuid, d.first_name, d.last_name, d.city, d.country,
  d.vehicle_type, turnos, pedidos, {money('km')} AS km_percorridos, {money('earned')} AS ganhos_brl,
  minutos_trabalhados, {mean('rating', 'rated')} AS rating_medio, turnos_com_problema,
  turnos_disponivel, {rounded('earned', 'km')} AS ganho_por_km,
  {rounded('earned * 60', 'minutos_trabalhados * 100')} AS ganho_por_hora,
  {rounded('pedidos', 'turnos')} AS pedidos_por_turno,
  {rounded('turnos_com_problema', 'turnos', 100)} AS pct_turnos_com_problema,
  primeiro_turno, ultimo_turno, d.driver_id IS NULL AS sem_cadastro
FROM t LEFT JOIN {_one_per('drivers', 'driver_id')} d ON d.driver_id = t.driver_id"""

_REVENUE = with_silver("order_items", "restaurants") + f""",
i AS (
  SELECT restaurant_id, count(*) AS itens_vendidos, count(DISTINCT order_id) AS pedidos,
    count(DISTINCT product_id) AS produtos_distintos, CAST(sum(quantity) AS BIGINT) AS unidades,
    sum({cents('subtotal')}) AS gross, sum({cents('discount_applied')}) AS discount,
    sum({cents('unit_price')}) AS price, count(unit_price) AS priced,
    count(*) FILTER (is_combo) AS itens_combo,
    count(*) FILTER (is_vegetarian) AS itens_vegetarianos
  FROM s_order_items WHERE restaurant_id IS NOT NULL GROUP BY restaurant_id)
SELECT i.restaurant_id, r.uuid AS restaurant_uuid, r.cnpj, r.name AS restaurante, r.city,
  r.country, r.cuisine_type, r.average_rating, r.num_reviews, itens_vendidos, pedidos,
  produtos_distintos, unidades, {money('gross')} AS receita_bruta, {money('discount')} AS descontos,
  {money('gross - discount')} AS receita_liquida, {mean('price', 'priced')} AS preco_medio_unitario,
  itens_combo, itens_vegetarianos, {mean('gross - discount', 'pedidos')} AS receita_por_pedido,
  {rounded('itens_vendidos', 'pedidos')} AS itens_por_pedido,
  {rounded('discount', 'gross', 100)} AS pct_desconto,
  {rounded('itens_combo', 'itens_vendidos', 100)} AS pct_combo,
  r.restaurant_id IS NULL AS sem_cadastro
FROM i LEFT JOIN {_one_per('restaurants', 'restaurant_id')} r
  ON r.restaurant_id = i.restaurant_id"""
ORACLES["revenue_per_restaurant"] = _REVENUE

ORACLES["user_behavior"] = with_silver(
    "users_mongo", "users_mssql", "orders", "search_events", "recommendations"
) + f""",
pairs AS (SELECT DISTINCT cpf, user_id FROM s_users_mongo
  WHERE cpf IS NOT NULL AND user_id IS NOT NULL),
o AS (
  SELECT user_key, count(*) AS n, sum({cents('total_amount')}) AS spent,
    count(total_amount) AS amounts, min(order_date) AS a, max(order_date) AS z,
    count(DISTINCT restaurant_key) AS places
  FROM s_orders WHERE user_key IS NOT NULL GROUP BY user_key),
s AS (
  SELECT cpf, count(*) AS n, count(DISTINCT query_text) AS terms, sum(result_count) AS results,
    count(result_count) AS counted, count(clicked_product_id) AS clicked
  FROM s_search_events JOIN pairs USING (user_id) GROUP BY cpf),
r AS (
  SELECT cpf, count(*) AS n, count(*) FILTER (event_type = 'recommendation_served') AS served,
    count(*) FILTER (event_type = 'view') AS viewed,
    count(*) FILTER (event_type = 'click') AS clicks,
    count(*) FILTER (event_type = 'add_to_cart') AS carted
  FROM s_recommendations JOIN pairs USING (user_id) GROUP BY cpf)
SELECT p.cpf, p.user_id, p.uuid AS user_uuid, e.first_name, e.last_name, p.email, p.city,
  p.country, e.job, e.company_name,
  coalesce(o.n, 0) AS pedidos, {money('coalesce(o.spent, 0)')} AS gasto_total,
  {mean('o.spent', 'o.amounts')} AS ticket_medio, o.a AS primeiro_pedido, o.z AS ultimo_pedido,
  coalesce(o.places, 0) AS restaurantes_distintos,
  coalesce(s.n, 0) AS buscas, coalesce(s.terms, 0) AS termos_distintos,
  {rounded('s.results', 's.counted')} AS resultados_medios,
  coalesce(s.clicked, 0) AS buscas_com_clique,
  coalesce(r.n, 0) AS recomendacoes, coalesce(r.served, 0) AS rec_exibidas,
  coalesce(r.viewed, 0) AS rec_vistas, coalesce(r.clicks, 0) AS rec_clicadas,
  coalesce(r.carted, 0) AS rec_no_carrinho,
  {rounded('r.clicks', 'r.n', 100)} AS pct_clique_recomendacao,
  {rounded('s.clicked', 's.n', 100)} AS pct_busca_com_clique,
  o.n IS NULL AS nunca_comprou, e.cpf IS NULL AS sem_perfil_estendido
FROM {_one_per('users_mongo', 'cpf')} p
LEFT JOIN {_one_per('users_mssql', 'cpf')} e ON e.cpf = p.cpf
LEFT JOIN o ON o.user_key = p.cpf LEFT JOIN s ON s.cpf = p.cpf LEFT JOIN r ON r.cpf = p.cpf"""


# ----------------------------------------------------------- incremental report
_SPLIT_MS = 1705363200000


def _before_split(payments: DataFrame) -> DataFrame:
    """What an earlier run saw: arrivals before the split, of which late ones are missing."""
    return payments.filter(
        (F.col("kafka_created_at") < _SPLIT_MS) & ~F.col("event_name").eqNullSafe("captured")
    )


_BEFORE_SQL = (
    f"kafka_created_at < {_SPLIT_MS} AND event_name IS DISTINCT FROM 'captured'"
)


def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = silver(spark, sf_dir, "payment_events")
    target = gold.payment_lifecycle(_before_split(payments))
    return changed_keys(
        payments, target, "payment_id", "event_timestamp_ms", "total_eventos", "ultimo_evento_ms"
    )


QUERIES["changed_keys"] = changed
ORACLES["changed_keys"] = with_silver("payment_events") + f""",
now AS (SELECT payment_id, count(*) AS n, max(event_timestamp_ms) AS m FROM s_payment_events
  WHERE payment_id IS NOT NULL GROUP BY 1),
old AS (SELECT payment_id, count(*) AS n, max(event_timestamp_ms) AS m FROM s_payment_events
  WHERE payment_id IS NOT NULL AND {_BEFORE_SQL} GROUP BY 1)
SELECT now.payment_id, CASE WHEN old.n IS NULL THEN 'new' WHEN old.n <> now.n THEN 'count'
  ELSE 'moment' END AS change
FROM now LEFT JOIN old USING (payment_id)
WHERE old.n IS NULL OR old.n <> now.n OR old.m <> now.m"""


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = silver(spark, sf_dir, "payment_events")
    target = gold.payment_lifecycle(_before_split(payments))
    return gold.payment_lifecycle_incremental(payments, target)


QUERIES["payment_lifecycle_incremental"] = incremental
ORACLES["payment_lifecycle_incremental"] = ORACLES["payment_lifecycle"]


# ------------------------------------------------------------------ components
QUERIES["dedup_dimension"] = lambda spark, sf: dedup_dimension(
    silver(spark, sf, "restaurants"), "restaurant_id"
).select("restaurant_id", "uuid", "name", "source_ts_ms", "kafka_offset")
ORACLES["dedup_dimension"] = with_silver("restaurants") + (
    " SELECT restaurant_id, uuid, name, source_ts_ms, kafka_offset FROM "
    + _one_per("restaurants", "restaurant_id") + " d"
)


def orphan_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifts per driver, flagged where the registry has no such driver."""
    shifts = (
        silver(spark, sf_dir, "driver_shifts")
        .filter(F.col("driver_id").isNotNull())
        .groupBy("driver_id")
        .agg(F.count(F.lit(1)).alias("turnos"))
    )
    registry = dedup_dimension(silver(spark, sf_dir, "drivers"), "driver_id").select(
        "driver_id", "license_number"
    )
    return left_join_flag(shifts, registry, "driver_id", "sem_cadastro")


QUERIES["orphan_flag"] = orphan_flag
ORACLES["orphan_flag"] = with_silver("driver_shifts", "drivers") + f"""
SELECT t.driver_id, t.turnos, d.license_number, d.driver_id IS NULL AS sem_cadastro
FROM (SELECT driver_id, count(*) AS turnos FROM s_driver_shifts WHERE driver_id IS NOT NULL
  GROUP BY 1) t LEFT JOIN {_one_per('drivers', 'driver_id')} d USING (driver_id)"""


def bridged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches and distinct terms per person through the many-to-many id bridge."""
    bridge = silver(spark, sf_dir, "users_mongo").select("cpf", "user_id")
    searches = silver(spark, sf_dir, "search_events")
    # one first level serves both counts, so the searches are read once
    per_term = searches.groupBy("user_id", "query_text").agg(F.count(F.lit(1)).alias("buscas"))
    per_id = per_term.groupBy("user_id").agg(F.sum("buscas").alias("buscas"))
    counted = bridge_aggregate(per_id, bridge, "user_id", "cpf", ["buscas"])
    terms = bridge_distinct(per_term, bridge, "user_id", "cpf", "query_text", "termos_distintos")
    return counted.join(terms, "cpf", "left")


QUERIES["bridge_aggregate"] = bridged
ORACLES["bridge_aggregate"] = with_silver("users_mongo", "search_events") + """
SELECT cpf, count(*) AS buscas, count(DISTINCT query_text) AS termos_distintos
FROM s_search_events JOIN (SELECT DISTINCT cpf, user_id FROM s_users_mongo
  WHERE cpf IS NOT NULL AND user_id IS NOT NULL) pairs USING (user_id)
GROUP BY cpf"""

QUERIES["pivot_first"] = lambda spark, sf: pivot_first(
    table(spark, sf, "events"), "user_id", "event_type", "ts",
    {k: f"first_{k}" for k in ("signup", "view", "click", "purchase", "error")},
)
ORACLES["pivot_first"] = "SELECT user_id, " + ", ".join(
    f"min(CASE WHEN event_type = '{k}' THEN ts END) AS first_{k}"
    for k in ("signup", "view", "click", "purchase", "error")
) + " FROM events GROUP BY user_id"

QUERIES["share_of_total"] = lambda spark, sf: share_of_total(table(spark, sf, "lineitem"), "l_suppkey")
ORACLES["share_of_total"] = (
    f"SELECT l_suppkey, n, {rounded('n', '(SELECT count(*) FROM lineitem)', 100)} AS pct "
    "FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) v"
)
