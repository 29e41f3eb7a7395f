"""Audit gold tables over flagged payments and enriched findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.functions.columns import TOTAL, amount, count_where, share_true, total, total_where

OPEN = ["Aberto", "Em análise"]
RULE = ["id_regra", "regra_nome", "severidade", "regra_categoria", "politica_referencia"]


def findings_by_rule(findings: DataFrame) -> DataFrame:
    return findings.groupBy(*RULE).agg(
        F.count("*").alias("qtd_achados"),
        count_where(F.col("status_achado").isin(OPEN)).alias("qtd_em_aberto"),
        count_where(F.col("status_achado") == "Resolvido").alias("qtd_resolvidos"),
        total("valor_em_risco").alias("valor_em_risco"),
    )


def limit_violations(payments: DataFrame) -> DataFrame:
    return payments.filter("acima_alcada").select(
        "id_transacao", "data_transacao", "area", "aprovador_nome", "aprovador_cargo", "alcada_limite", "valor",
        amount(F.col("valor") - F.col("alcada_limite")).alias("valor_excedente"),
        F.col("razao_social").alias("fornecedor"),
        "status",
    )


def uncontracted_spend(payments: DataFrame) -> DataFrame:
    return (
        payments.filter(~F.col("fornecedor_possui_contrato"))
        .groupBy("area", "id_fornecedor", "razao_social", "situacao_cadastral")
        .agg(
            F.count("*").alias("qtd_transacoes"),
            total("valor").alias("valor_total"),
            total_where(F.col("sem_contrato_relevante"), "valor").alias("valor_acima_limite"),
        )
    )


def compliance_summary(payments: DataFrame, findings: DataFrame) -> DataFrame:
    """Area and month. Findings fold to one row per payment before they meet the payments."""
    per_payment = findings.groupBy("id_transacao").agg(
        F.count("*").alias("_found"), F.sum("valor_em_risco").alias("_risk")
    )
    joined = payments.select("id_transacao", "area", "mes", "valor").join(per_payment, "id_transacao", "left")
    return joined.groupBy("area", "mes").agg(
        F.count("*").alias("qtd_transacoes"),
        total("valor").alias("valor_transacionado"),
        F.count("_found").alias("qtd_transacoes_com_achado"),
        F.coalesce(F.sum("_found"), F.lit(0)).cast("bigint").alias("qtd_achados"),
        F.coalesce(F.sum("_risk"), F.lit(0)).cast(TOTAL).alias("valor_em_risco"),
        share_true(F.col("_found").isNull()).alias("pct_conformidade"),
    )


def reconcile_flags(payments: DataFrame, findings: DataFrame) -> DataFrame:
    """Flags re-derived from the payments against the stored findings.

    One row per (payment, rule) that differs in presence, for the rules that have a flag.
    """
    flags = {
        "R001": "acima_alcada",
        "R002": "sem_contrato_relevante",
        "R003": "sod_violado",
        "R004": "dia_nao_util",
        "R005": "fornecedor_irregular",
        "R008": "sem_categoria",
        "R010": "parte_relacionada",
    }
    raised = F.array_compact(F.array(*[F.when(F.col(flag), F.lit(rule)) for rule, flag in flags.items()]))
    derived = payments.select("id_transacao", F.explode(raised).alias("id_regra"), F.lit(True).alias("sinalizado"))
    stored = (
        findings.filter(F.col("id_regra").isin(list(flags)))
        .select("id_transacao", "id_regra", F.lit(True).alias("registrado"))
        .distinct()
    )
    return (
        derived.join(stored, ["id_transacao", "id_regra"], "full_outer")
        .select(
            "id_transacao",
            "id_regra",
            F.when(F.col("registrado").isNull(), "sem achado")
            .when(F.col("sinalizado").isNull(), "sem sinal")
            .otherwise("conforme")
            .alias("situacao"),
        )
    )
