"""Procurement gold tables over the silver orders, lines and receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.functions.columns import month_of, settle, share, share_true, total, total_where


def category_spend(orders: DataFrame, skip_status: list[str] | None = None) -> DataFrame:
    """Spend per category, site and month; every status counts unless skipped."""
    if skip_status:
        orders = orders.filter(~F.col("status").isin(skip_status))
    return orders.groupBy(
        "categoria_nome", "categoria_tipo", "centro", month_of("data_pedido").alias("mes")
    ).agg(total("valor_total").alias("gasto"), F.count("*").alias("qtd_pedidos"))


def supplier_delivery(receipts: DataFrame, orders: DataFrame) -> DataFrame:
    """Lead time, punctuality and OTIF per supplier, over received orders only."""
    received = receipts.filter(F.col("data_recebida").isNotNull()).select(
        "id_pedido", "data_recebida", "no_prazo", "otif"
    )
    placed = orders.select("id_pedido", "data_pedido", "id_fornecedor", "razao_social", "criticidade")
    return (
        received.join(placed, "id_pedido")
        .groupBy("id_fornecedor", "razao_social", "criticidade")
        .agg(
            F.count("*").alias("qtd_pedidos_recebidos"),
            settle(F.avg(F.datediff("data_recebida", "data_pedido")), 1).alias("lead_time_medio_dias"),
            share_true(F.col("no_prazo")).alias("pct_no_prazo"),
            share_true(F.col("otif")).alias("otif_pct"),
        )
    )


def order_savings(lines: DataFrame) -> DataFrame:
    """Lines folded to one row per order before any join."""
    return lines.groupBy("id_pedido").agg(
        F.sum("saving_item").alias("saving"),
        F.sum(F.col("preco_baseline") * F.col("qtd")).alias("baseline"),
    )


def category_saving(lines: DataFrame, orders: DataFrame) -> DataFrame:
    placed = orders.select("id_pedido", "data_pedido", "categoria_nome", "categoria_tipo")
    saving, baseline = F.sum("saving"), F.sum("baseline")
    return (
        order_savings(lines)
        .join(placed, "id_pedido")
        .groupBy("categoria_nome", "categoria_tipo", month_of("data_pedido").alias("mes"))
        .agg(
            total("saving").alias("saving_total"),
            total("baseline").alias("baseline_total"),
            share(saving, baseline).alias("saving_pct"),
        )
    )


def contract_coverage(orders: DataFrame) -> DataFrame:
    sums = orders.groupBy("centro").agg(
        total_where(F.col("tem_contrato"), "valor_total").alias("gasto_em_contrato"),
        total_where(~F.col("tem_contrato"), "valor_total").alias("gasto_fora_contrato"),
        total("valor_total").alias("gasto_total"),
    )
    return sums.withColumns(
        {
            "pct_em_contrato": share(F.col("gasto_em_contrato"), F.col("gasto_total")),
            "pct_fora_contrato": share(F.col("gasto_fora_contrato"), F.col("gasto_total")),
        }
    )


def sole_source_spend(orders: DataFrame) -> DataFrame:
    return (
        orders.filter("fornecedor_unico")
        .groupBy("id_fornecedor", "razao_social", "uf", "criticidade")
        .agg(F.count("*").alias("qtd_pedidos"), total("valor_total").alias("gasto_total"))
    )
