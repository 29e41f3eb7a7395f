"""KPI cards, rankings and month summaries of the four cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auriga.functions.columns import (
    TOTAL, brazilian, count_where, month_of, settle, share, share_true, total, total_where,
)
from auriga.operators import procurement
from auriga.operators.audit import OPEN
from auriga.operators.forecast import forecast
from auriga.operators.oneline import side_by_side

MISSING = "n/d"


def _reais(value: Column) -> Column:
    return F.concat(F.lit("R$ "), F.coalesce(brazilian(value), F.lit(MISSING)))


def _percent(value: Column) -> Column:
    return F.concat(F.coalesce(brazilian(value, 1), F.lit(MISSING)), F.lit("%"))


# --- procurement -------------------------------------------------------------


def procurement_cards(orders: DataFrame, lines: DataFrame, receipts: DataFrame) -> DataFrame:
    """One row: spend, saving, OTIF over received orders and spend outside contracts."""
    spend = orders.agg(
        total("valor_total").alias("gasto_total"),
        total_where(~F.col("tem_contrato"), "valor_total").alias("gasto_fora_contrato"),
        share(
            F.sum(F.when(~F.col("tem_contrato"), F.col("valor_total"))), F.sum("valor_total")
        ).alias("pct_fora_contrato"),
    )
    baseline = F.col("preco_baseline") * F.col("qtd")
    saving = lines.agg(
        total("saving_item").alias("saving_total"),
        share(F.sum("saving_item"), F.sum(baseline)).alias("saving_pct"),
    )
    delivered = receipts.filter(F.col("data_recebida").isNotNull()).agg(
        F.count("*").alias("pedidos_recebidos"),
        count_where(F.col("dias_atraso") > 0).alias("pedidos_atrasados"),
        share_true(F.col("otif")).alias("otif_pct"),
    )
    return side_by_side(spend, saving, delivered)


def spend_by(orders: DataFrame, *columns: str) -> DataFrame:
    """Spend and order count by any silver columns; `mes` is the order month."""
    return (
        orders.withColumn("mes", month_of("data_pedido"))
        .groupBy(*columns)
        .agg(total("valor_total").alias("gasto"), F.count("*").alias("qtd_pedidos"))
    )


def latest_month(orders: DataFrame) -> Column:
    return orders.agg(month_of(F.max("data_pedido"))).scalar()


def orders_of_latest_month(orders: DataFrame) -> DataFrame:
    return orders.filter(month_of("data_pedido") == latest_month(orders))


def procurement_month(orders: DataFrame, lines: DataFrame, receipts: DataFrame) -> DataFrame:
    """The cards over the orders of the newest month."""
    recent = orders_of_latest_month(orders)
    keys = recent.select("id_pedido")
    cards = procurement_cards(
        recent, lines.join(keys, "id_pedido", "left_semi"), receipts.join(keys, "id_pedido", "left_semi")
    )
    return side_by_side(cards, orders.agg(month_of(F.max("data_pedido")).alias("mes")))


def procurement_sentence(summary: DataFrame) -> DataFrame:
    text = F.format_string(
        "Em %s, o gasto foi de %s, com economia de %s e OTIF de %s; %d pedidos recebidos com atraso.",
        F.date_format("mes", "yyyy-MM"),
        _reais(F.col("gasto_total")),
        _percent(F.col("saving_pct")),
        _percent(F.col("otif_pct")),
        F.col("pedidos_atrasados"),
    )
    return summary.select("mes", text.alias("resumo"))


def top_categories_of_month(orders: DataFrame) -> DataFrame:
    return (
        orders_of_latest_month(orders)
        .groupBy("categoria_nome")
        .agg(total("valor_total").alias("gasto"), F.count("*").alias("qtd_pedidos"))
        .orderBy(F.col("gasto").desc(), "categoria_nome")
    )


def worst_delays(orders: DataFrame, receipts: DataFrame, n: int = 5) -> DataFrame:
    """The longest delays among the orders of the newest month; none if no receipt of it is late."""
    late = receipts.filter(F.col("dias_atraso") > 0).select("id_pedido", "data_prometida", "dias_atraso")
    placed = orders.select(
        "id_pedido", "razao_social", "categoria_nome", "valor_total", month_of("data_pedido").alias("mes")
    )
    recent = placed.filter(F.col("mes") == latest_month(orders))
    return recent.join(late, "id_pedido").orderBy(F.col("dias_atraso").desc(), "id_pedido").limit(n)


def top_suppliers(orders: DataFrame, receipts: DataFrame, n: int = 10) -> DataFrame:
    """The n biggest suppliers by spend with OTIF and lead time.

    n rows are broadcast, so only their orders go on to meet the receipts.
    """
    biggest = (
        orders.groupBy("id_fornecedor", "razao_social")
        .agg(total("valor_total").alias("gasto_total"), F.count("*").alias("qtd_pedidos"))
        .orderBy(F.col("gasto_total").desc(), "id_fornecedor")
        .limit(n)
    )
    theirs = orders.join(F.broadcast(biggest.select("id_fornecedor")), "id_fornecedor", "left_semi")
    delivery = procurement.supplier_delivery(receipts, theirs)
    return biggest.join(
        delivery.select("id_fornecedor", "lead_time_medio_dias", "otif_pct"), "id_fornecedor", "left"
    ).orderBy(F.col("gasto_total").desc(), "id_fornecedor")


def overdue_orders(orders: DataFrame, receipts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Orders not received whose promise has passed; by default as of the newest order date."""
    today = orders.agg(F.max("data_pedido")).scalar() if as_of is None else as_of
    waiting = receipts.filter(F.col("data_recebida").isNull()).select("id_pedido", "data_prometida")
    active = orders.filter(F.col("status") != "Cancelado").select(
        "id_pedido", "razao_social", "categoria_nome", "centro", "status", "valor_total"
    )
    return (
        waiting.withColumn("dias_vencidos", F.datediff(today, "data_prometida").cast("bigint"))
        .filter(F.col("dias_vencidos") > 0)
        .join(active, "id_pedido")
    )


# --- finance -----------------------------------------------------------------


def closed(base: DataFrame) -> DataFrame:
    return base.filter(F.col("valor_realizado").isNotNull())


def _sums() -> list[Column]:
    revenue, expense = F.col("tipo") == "Receita", F.col("tipo") == "Despesa"
    income = total_where(revenue, F.col("valor_realizado"))
    spent = total_where(expense, F.col("valor_realizado"))
    return [
        income.alias("receita"),
        spent.alias("despesa"),
        (income - spent).cast(TOTAL).alias("resultado"),
        total_where(expense, F.col("variancia")).alias("variancia_despesa"),
    ]


def finance_cards(base: DataFrame) -> DataFrame:
    expense = F.col("tipo") == "Despesa"
    return closed(base).agg(
        *_sums(),
        share(
            F.sum(F.when(expense, F.col("variancia"))), F.sum(F.when(expense, F.col("valor_orcado")))
        ).alias("variancia_despesa_pct"),
    )


def closed_month_summary(base: DataFrame) -> DataFrame:
    """Newest month with actuals: result, expense variance and its biggest overrun.

    Months are few once grouped, so the newest is picked after grouping and the base is read once.
    """
    over = (F.col("tipo") == "Despesa") & (F.col("variancia") > 0)
    order = F.when(over, F.struct(-F.col("variancia"), "id_conta", "id_centro"))
    worst = F.min_by(F.struct("conta_nome", "centro_nome", "variancia"), order)
    return (
        closed(base)
        .groupBy("mes")
        .agg(*_sums(), worst.alias("_worst"))
        .orderBy(F.col("mes").desc())
        .limit(1)
        .select(
            "mes", "receita", "despesa", "resultado", "variancia_despesa",
            F.col("_worst.conta_nome").alias("maior_estouro_conta"),
            F.col("_worst.centro_nome").alias("maior_estouro_centro"),
            F.col("_worst.variancia").alias("maior_estouro"),
        )
    )


def finance_sentence(summary: DataFrame) -> DataFrame:
    text = F.format_string(
        "Em %s, a receita realizada foi de %s e a despesa de %s, com resultado de %s. "
        "A despesa variou %s contra o orçado; o maior estouro foi %s em %s (%s).",
        F.date_format("mes", "yyyy-MM"),
        _reais(F.col("receita")),
        _reais(F.col("despesa")),
        _reais(F.col("resultado")),
        _reais(F.col("variancia_despesa")),
        F.coalesce("maior_estouro_conta", F.lit(MISSING)),
        F.coalesce("maior_estouro_centro", F.lit(MISSING)),
        _reais(F.col("maior_estouro")),
    )
    return summary.select("mes", text.alias("resumo"))


def type_series(base: DataFrame) -> DataFrame:
    """Monthly actual and budget of revenue and expense."""
    return (
        base.filter(F.col("tipo").isin("Receita", "Despesa"))
        .groupBy("tipo", "mes")
        .agg(total("valor_orcado").alias("orcado"), total("valor_realizado").alias("realizado"))
    )


def forecast_against_budget(base: DataFrame, horizon: str) -> DataFrame:
    """Forecast of the open months next to their budget, for revenue and expense."""
    series = type_series(base)
    ahead = forecast(series, horizon, "mes", "realizado", ["tipo"])
    gap = F.col("realizado_forecast") - F.col("orcado").cast("double")
    return ahead.join(series.select("tipo", "mes", "orcado"), ["tipo", "mes"]).select(
        "tipo", "mes", "orcado", "realizado_forecast",
        F.round(gap, 2).alias("diferenca"),
        share(gap, F.col("orcado")).alias("diferenca_pct"),
        (F.col("realizado_forecast") >= F.col("orcado").cast("double")).alias("atinge_orcado"),
    )


def revenue_with_forecast(revenue: DataFrame, horizon: str) -> DataFrame:
    """History and projection as one series."""
    ahead = forecast(revenue, horizon, "mes", "receita_realizada")
    nothing = F.lit(None).cast("double")
    history = revenue.filter(F.col("receita_realizada").isNotNull()).select(
        "mes", F.lit("historico").alias("serie"), F.col("receita_realizada").cast("double").alias("valor"),
        nothing.alias("superior"), nothing.alias("inferior"),
    )
    projection = ahead.select(
        "mes", F.lit("projecao").alias("serie"), F.col("receita_realizada_forecast").alias("valor"),
        F.col("receita_realizada_upper").alias("superior"), F.col("receita_realizada_lower").alias("inferior"),
    )
    return history.unionByName(projection)


def variance_by_center(base: DataFrame) -> DataFrame:
    """Expense variance per cost centre, given any selection of the base table."""
    return (
        closed(base)
        .filter(F.col("tipo") == "Despesa")
        .groupBy("id_centro", "centro_nome")
        .agg(
            total("valor_orcado").alias("orcado_total"),
            total("valor_realizado").alias("realizado_total"),
            total("variancia").alias("variancia"),
            share(F.sum("variancia"), F.sum("valor_orcado")).alias("variancia_pct"),
        )
    )


# --- maintenance -------------------------------------------------------------


def maintenance_cards(health: DataFrame, mtbf: DataFrame, work_orders: DataFrame) -> DataFrame:
    labels = health.agg(
        count_where(F.col("categoria_risco") == "Crítico").alias("ativos_criticos"),
        count_where(F.col("categoria_risco") == "Atenção").alias("ativos_atencao"),
    )
    gaps = mtbf.agg(settle(F.avg("mtbf_dias"), 1).alias("mtbf_medio_dias"))
    spent = work_orders.agg(
        total("custo").alias("custo_total"), settle(F.sum("downtime_horas"), 1).alias("downtime_total_horas")
    )
    return side_by_side(labels, gaps, spent)


def assets_by_label(health: DataFrame) -> DataFrame:
    return health.groupBy("categoria_risco").agg(F.count("*").alias("ativos"))


def cost_by_asset_type(cost: DataFrame) -> DataFrame:
    """Corrective and preventive cost side by side; the two kinds are named, so no pass to find them."""
    return (
        cost.groupBy("tipo_ativo")
        .pivot("tipo_ordem", ["Corretiva", "Preventiva"])
        .agg(total("custo_total"))
        .select("tipo_ativo", F.col("Corretiva").alias("corretiva"), F.col("Preventiva").alias("preventiva"))
    )


def risky_vibration(daily: DataFrame, health: DataFrame) -> DataFrame:
    risky = health.filter(F.col("categoria_risco") != "Saudável").select("id_ativo")
    return daily.join(risky, "id_ativo", "left_semi").select("id_ativo", "tag", "dia", "vib_media", "vib_max")


# --- audit -------------------------------------------------------------------


def audit_cards(findings: DataFrame, compliance: DataFrame) -> DataFrame:
    newest = compliance.agg(F.max("mes")).scalar()
    counts = findings.agg(
        F.count("*").alias("total_achados"),
        count_where((F.col("severidade") == "Alta") & F.col("status_achado").isin(OPEN)).alias("alta_em_aberto"),
        total("valor_em_risco").alias("valor_em_risco"),
    )
    latest = compliance.filter(F.col("mes") == newest).agg(
        F.max("mes").alias("mes"), _conformity().alias("pct_conformidade")
    )
    return side_by_side(counts, latest)


def _conformity() -> Column:
    payments = F.sum("qtd_transacoes")
    return share(payments - F.sum("qtd_transacoes_com_achado"), payments)


def monthly_compliance(compliance: DataFrame) -> DataFrame:
    return compliance.groupBy("mes").agg(
        F.sum("qtd_achados").alias("qtd_achados"),
        total("valor_em_risco").alias("valor_em_risco"),
        _conformity().alias("pct_conformidade"),
    )


def uncontracted_by_area(uncontracted: DataFrame) -> DataFrame:
    return uncontracted.groupBy("area").agg(
        F.sum("qtd_transacoes").alias("qtd_transacoes"),
        total("valor_total").alias("valor_total"),
        total("valor_acima_limite").alias("valor_acima_limite"),
    )


def uncontracted_ranking(uncontracted: DataFrame, n: int = 10) -> DataFrame:
    return (
        uncontracted.groupBy("id_fornecedor", "razao_social")
        .agg(F.sum("qtd_transacoes").alias("qtd_transacoes"), total("valor_total").alias("valor_total"))
        .orderBy(F.col("valor_total").desc(), "id_fornecedor")
        .limit(n)
    )
