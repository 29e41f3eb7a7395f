"""Table-level checks: references, duplicates, reconciliations, rates and readiness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.functions.columns import TOTAL, count_where, share, share_true, total, total_where
from auriga.operators.oneline import side_by_side


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def orphan_count(table: str, fact: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Rows of the fact whose key is missing from the dimension; a NULL key counts.

    The fact folds to one row per key before the anti join, so a hot key costs one row.
    """
    keys = fact.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    known = dimension.select(F.col(dimension_key).alias("_key"))
    return keys.join(known, "_key", "left_anti").agg(
        F.lit(table).alias("tabela"), F.lit(key).alias("chave"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("orfaos")
    )


def duplicate_count(table: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    repeated = df.groupBy(*keys).agg((F.count("*") - 1).alias("_extra"))
    return repeated.agg(
        F.lit(table).alias("tabela"),
        F.lit(", ".join(keys)).alias("chave"),
        F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicadas"),
    )


def header_against_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order total against the sum of its lines, for orders that have lines."""
    sums = lines.groupBy("id_pedido").agg(F.sum("valor_item").alias("_lines"))
    gap = F.abs(F.col("valor_total") - F.col("_lines")).cast(TOTAL)
    return (
        orders.select("id_pedido", "valor_total")
        .join(sums, "id_pedido", "left")
        .agg(
            F.count("*").alias("pedidos"),
            count_where(F.col("_lines").isNull()).alias("pedidos_sem_itens"),
            count_where(gap >= 0.01).alias("pedidos_divergentes"),
            F.max(gap).alias("maior_diferenca"),
        )
    )


def procurement_rates(orders: DataFrame, lines: DataFrame, receipts: DataFrame, category: str) -> DataFrame:
    delivered = receipts.filter(F.col("data_recebida").isNotNull()).agg(
        share_true(F.col("dias_atraso") > 0).alias("pct_atraso"), share_true(F.col("otif")).alias("pct_otif")
    )
    saved = lines.agg(share_true(F.col("preco_unitario") < F.col("preco_baseline")).alias("pct_itens_com_saving"))
    placed = orders.agg(
        share_true(~F.col("tem_contrato")).alias("pct_pedidos_fora_contrato"),
        share(F.sum(F.when(F.col("fornecedor_unico"), F.col("valor_total"))), F.sum("valor_total")).alias(
            "pct_gasto_fonte_unica"
        ),
        share(F.sum(F.when(F.col("categoria_nome") == category, F.col("valor_total"))), F.sum("valor_total")).alias(
            "pct_gasto_categoria"
        ),
    )
    return side_by_side(delivered, saved, placed)


def finance_signals(base: DataFrame) -> DataFrame:
    """Totals by type, result, variance of expense and revenue, and how many expense pairs overran."""
    done = base.filter(F.col("valor_realizado").isNotNull())

    def spent(kind: str):
        return total_where(F.col("tipo") == kind, "valor_realizado")

    def off(kind: str):
        mine = F.col("tipo") == kind
        return share(F.sum(F.when(mine, F.col("variancia"))), F.sum(F.when(mine, F.col("valor_orcado"))))

    totals = done.agg(
        spent("Receita").alias("receita"),
        spent("Despesa").alias("despesa"),
        spent("CAPEX").alias("capex"),
        (spent("Receita") - spent("Despesa")).cast(TOTAL).alias("resultado"),
        off("Despesa").alias("variancia_despesa_pct"),
        off("Receita").alias("variancia_receita_pct"),
    )
    pairs = (
        done.filter(F.col("tipo") == "Despesa")
        .groupBy("id_conta", "id_centro")
        .agg(F.sum("variancia").alias("_gap"))
        .agg(F.count("*").alias("pares_despesa"), count_where(F.col("_gap") > 0).alias("pares_com_estouro"))
    )
    return side_by_side(totals, pairs)


def actuals_without_budget(actuals: DataFrame, budget: DataFrame) -> DataFrame:
    keys = ["id_centro", "id_conta", "mes"]
    return actuals.join(budget.select(*keys), keys, "left_anti").agg(F.count("*").alias("sem_orcamento"))


def series_readiness(observed: DataFrame, time_col: str, value_col: str, needed: int = 24) -> DataFrame:
    """Enough points for a forecast?"""
    return (
        observed.filter(F.col(value_col).isNotNull())
        .agg(
            F.count_distinct(time_col).alias("pontos"),
            F.min(time_col).alias("primeiro"),
            F.max(time_col).alias("ultimo"),
        )
        .withColumn("pronta", F.col("pontos") >= needed)
    )


def maintenance_coverage(assets: DataFrame, failures: DataFrame, work_orders: DataFrame) -> DataFrame:
    """One row: assets and their kinds, failures and the assets that failed, orders by kind and their cost."""
    known = assets.agg(
        F.count("*").alias("ativos"),
        F.count_distinct("tipo").alias("tipos"),
        count_where(F.col("criticidade") == "Alta").alias("ativos_criticidade_alta"),
    )
    failed = failures.groupBy("id_ativo").agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("falhas"),
        F.count("*").alias("ativos_com_falha"),
        count_where(F.col("_n") == 2).alias("ativos_com_duas_falhas"),
    )
    orders = work_orders.agg(
        count_where(F.col("tipo_ordem") == "Corretiva").alias("ordens_corretivas"),
        count_where(F.col("tipo_ordem") == "Preventiva").alias("ordens_preventivas"),
        total("custo").alias("custo_total"),
    )
    return side_by_side(known, failed, orders)


def audit_signals(payments: DataFrame, vendors: DataFrame) -> DataFrame:
    """One row: how often payments break a rule, and how many vendors are of each kind."""
    flags = {
        "acima_alcada": F.col("acima_alcada"),
        "sod": F.col("sod_violado"),
        "sem_categoria": F.col("sem_categoria"),
        "sem_contrato": ~F.col("fornecedor_possui_contrato"),
    }
    broken = payments.agg(
        F.count("*").alias("transacoes"),
        *[count_where(flag).alias(f"qtd_{name}") for name, flag in flags.items()],
        *[share_true(flag).alias(f"pct_{name}") for name, flag in flags.items()],
    )
    kinds = vendors.agg(
        count_where(~F.col("possui_contrato")).alias("fornecedores_sem_contrato"),
        count_where(F.col("situacao_cadastral") == "Irregular").alias("fornecedores_irregulares"),
        count_where(F.col("parte_relacionada")).alias("fornecedores_parte_relacionada"),
    )
    return side_by_side(broken, kinds)


def findings_by_severity(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severidade").agg(
        F.count("*").alias("qtd_achados"), total("valor_em_risco").alias("valor_em_risco")
    )


def failures_per_asset(failures: DataFrame) -> DataFrame:
    """How many assets have one failure, two failures, and so on."""
    return (
        failures.groupBy("id_ativo")
        .agg(F.count("*").alias("n_falhas"))
        .groupBy("n_falhas")
        .agg(F.count("*").alias("ativos"))
    )


def layer_check(table: str, raw: DataFrame, typed: DataFrame, keys: list[str]) -> DataFrame:
    """Row counts of a raw table and its typed form, and NULL keys in the latter."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    counted = typed.agg(F.count("*").alias("linhas_silver"), count_where(missing).alias("chaves_nulas"))
    return side_by_side(
        counted.select(F.lit(table).alias("tabela"), "*"), raw.agg(F.count("*").alias("linhas_bronze"))
    )


def row_counts(layer: str, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table of a layer."""
    return stack(
        [
            df.agg(F.lit(layer).alias("camada"), F.lit(name).alias("tabela"), F.count("*").alias("linhas"))
            for name, df in tables.items()
        ]
    )
