"""The sample questions of each case as parameterised queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.functions.columns import count_where, month_of, settle, share, total
from auriga.operators import procurement
from auriga.operators.audit import OPEN
from auriga.operators.joins import first_by
from auriga.plans.kpis import closed, latest_month


def spend_in_last_months(
    orders: DataFrame, months: int = 6, category: str | None = None, site: str | None = None
) -> DataFrame:
    """Spend per category and site over the newest months, the current one included."""
    chosen = orders.filter(month_of("data_pedido") >= F.add_months(latest_month(orders), 1 - months))
    if category is not None:
        chosen = chosen.filter(F.col("categoria_nome") == category)
    if site is not None:
        chosen = chosen.filter(F.col("centro") == site)
    return chosen.groupBy("categoria_nome", "centro").agg(
        total("valor_total").alias("gasto"), F.count("*").alias("qtd_pedidos")
    )


def suppliers_below_otif(delivery: DataFrame, level: float = 80.0) -> DataFrame:
    return delivery.filter(F.col("otif_pct") < level).select(
        "id_fornecedor", "razao_social", "otif_pct", "qtd_pedidos_recebidos"
    )


def saving_by_category(lines: DataFrame, orders: DataFrame) -> DataFrame:
    placed = orders.select("id_pedido", "categoria_nome")
    return (
        procurement.order_savings(lines)
        .join(placed, "id_pedido")
        .groupBy("categoria_nome")
        .agg(total("saving").alias("saving_total"), share(F.sum("saving"), F.sum("baseline")).alias("saving_pct"))
    )


def spend_outside_contracts(orders: DataFrame) -> DataFrame:
    return procurement.contract_coverage(orders).select("centro", "gasto_fora_contrato", "pct_fora_contrato")


def worst_account_per_center(variance: DataFrame) -> DataFrame:
    """For each cost centre, the expense account furthest over budget."""
    over = variance.filter((F.col("tipo") == "Despesa") & (F.col("variancia") > 0))
    worst = first_by([-F.col("variancia"), F.col("id_conta")], "conta_nome", "variancia", "variancia_pct")
    return over.groupBy("id_centro", "centro_nome").agg(worst.alias("_w")).select("id_centro", "centro_nome", "_w.*")


def base_of_year(base: DataFrame, year: int | None = None) -> DataFrame:
    """The base table of one year; by default the newest with actuals."""
    chosen = closed(base).agg(F.year(F.max("mes"))).scalar() if year is None else F.lit(year)
    return base.filter(F.year("mes") == chosen)


def actual_against_budget_by_month(revenue: DataFrame) -> DataFrame:
    return revenue.filter(F.col("receita_realizada").isNotNull()).select(
        "mes", "receita_orcada", "receita_realizada", "variancia_pct"
    )


def critical_assets(health: DataFrame) -> DataFrame:
    return health.filter(F.col("categoria_risco") == "Crítico").select(
        "id_ativo", "tag", "tipo", "site", "score_risco", "vibracao_recente"
    )


def mtbf_by_type(mtbf: DataFrame) -> DataFrame:
    return mtbf.groupBy("tipo_ativo").agg(
        settle(F.avg("mtbf_dias"), 1).alias("mtbf_medio_dias"), F.sum("n_falhas").alias("n_falhas")
    )


def corrective_cost_by_site(cost: DataFrame) -> DataFrame:
    return (
        cost.filter(F.col("tipo_ordem") == "Corretiva")
        .groupBy("site")
        .agg(total("custo_total").alias("custo_corretivo"), F.sum("n_ordens").alias("n_ordens"))
    )


def rising_vibration(daily: DataFrame, days: int = 7) -> DataFrame:
    """Assets whose daily mean vibration climbs over the last days of the data."""
    newest = daily.agg(F.max("dia")).scalar()
    slope = F.regr_slope("vib_media", F.unix_date("dia").cast("double"))
    return (
        daily.filter(F.col("dia") > F.date_sub(newest, days))
        .groupBy("id_ativo", "tag")
        .agg(settle(slope, 4).alias("inclinacao"), F.count("*").alias("dias"))
        .filter(F.col("inclinacao") > 0)
    )


def open_high_severity(findings: DataFrame) -> DataFrame:
    still_open = F.col("status_achado").isin(OPEN)
    return findings.filter(F.col("severidade") == "Alta").agg(
        count_where(still_open).alias("alta_em_aberto"),
        total(F.when(still_open, F.col("valor_em_risco"))).alias("valor_em_risco"),
    )


def risk_by_rule(by_rule: DataFrame) -> DataFrame:
    return by_rule.select("id_regra", "regra_nome", "severidade", "valor_em_risco").orderBy(
        F.col("valor_em_risco").desc(), "id_regra"
    )


def violations_of_last_quarter(violations: DataFrame, payments: DataFrame) -> DataFrame:
    """Over-limit payments of the calendar quarter of the newest payment."""
    start = payments.agg(F.trunc(F.max("data_transacao"), "quarter")).scalar()
    return violations.filter(F.col("data_transacao") >= start)


def conformity_by_area(compliance: DataFrame) -> DataFrame:
    newest = compliance.agg(F.max("mes")).scalar()
    return compliance.filter(F.col("mes") == newest).select("area", "mes", "qtd_transacoes", "pct_conformidade")
