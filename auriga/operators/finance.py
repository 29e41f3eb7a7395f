"""Budgeting gold tables. Variance is actual minus budget; open months have no actual."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.functions.columns import amount, share, total
from auriga.operators.joins import global_rank

LEDGER_KEY = ["id_centro", "id_conta", "mes"]
PAIR = ["id_conta", "conta_nome", "grupo", "id_centro", "centro_nome", "area"]


def budget_vs_actual(budget: DataFrame, actuals: DataFrame) -> DataFrame:
    spent = actuals.select(*LEDGER_KEY, "valor_realizado")
    gap = F.col("valor_realizado") - F.col("valor_orcado")
    return budget.join(spent, LEDGER_KEY, "left").select(
        "mes", "id_centro", "centro_nome", "area", "regiao", "id_conta", "conta_nome", "tipo", "grupo",
        "valor_orcado",
        "valor_realizado",
        amount(gap).alias("variancia"),
        share(gap, F.col("valor_orcado")).alias("variancia_pct"),
    )


def budget_variance(base: DataFrame) -> DataFrame:
    """Accumulated variance per account and cost centre over closed months."""
    return (
        base.filter(F.col("valor_realizado").isNotNull())
        .groupBy("id_conta", "conta_nome", "tipo", "grupo", "id_centro", "centro_nome", "area")
        .agg(
            total("valor_orcado").alias("orcado_total"),
            total("valor_realizado").alias("realizado_total"),
            total("variancia").alias("variancia"),
            share(F.sum("variancia"), F.sum("valor_orcado")).alias("variancia_pct"),
            F.count("*").alias("meses"),
        )
    )


def expense_by_group(base: DataFrame) -> DataFrame:
    """Open months keep their budget in the denominator and add nothing to the numerator."""
    return (
        base.filter(F.col("tipo") == "Despesa")
        .groupBy("grupo", "mes")
        .agg(
            total("valor_orcado").alias("orcado"),
            total("valor_realizado").alias("realizado"),
            share(F.sum("variancia"), F.sum("valor_orcado")).alias("variancia_pct"),
        )
    )


def monthly_revenue(base: DataFrame) -> DataFrame:
    return (
        base.filter(F.col("tipo") == "Receita")
        .groupBy("mes")
        .agg(
            total("valor_orcado").alias("receita_orcada"),
            total("valor_realizado").alias("receita_realizada"),
            share(F.sum("variancia"), F.sum("valor_orcado")).alias("variancia_pct"),
        )
    )


def top_overruns(base: DataFrame) -> DataFrame:
    """Expense pairs over budget in closed months, ranked; equal overruns share a place."""
    pairs = (
        base.filter((F.col("tipo") == "Despesa") & F.col("valor_realizado").isNotNull())
        .groupBy(*PAIR)
        .agg(
            total("valor_orcado").alias("orcado_total"),
            total("valor_realizado").alias("realizado_total"),
            total("variancia").alias("estouro_total"),
        )
        .filter(F.col("estouro_total") > 0)
        .withColumn("variancia_pct", share(F.col("estouro_total"), F.col("orcado_total")))
    )
    return global_rank(pairs, "estouro_total", "posicao")
