"""Typed, cleaned and enriched tables. Inputs may hold strings (bronze) or typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auriga.functions.columns import amount, blank_to_null, month_of
from auriga.operators.joins import join_dimension

CONTRACT_FLOOR = 50_000


def enriched_orders(orders: DataFrame, suppliers: DataFrame, categories: DataFrame) -> DataFrame:
    facts = orders.select(
        "id_pedido",
        "id_fornecedor",
        "id_categoria",
        blank_to_null("contrato_id").alias("contrato_id"),
        F.col("data_pedido").cast("date").alias("data_pedido"),
        "centro",
        amount("valor_total").alias("valor_total"),
        "status",
    )
    supplier = suppliers.select(
        "id_fornecedor",
        "razao_social",
        "criticidade",
        F.col("fornecedor_unico").cast("boolean").alias("fornecedor_unico"),
        "uf",
    )
    category = categories.select(
        "id_categoria", F.col("nome").alias("categoria_nome"), F.col("tipo").alias("categoria_tipo")
    )
    joined = join_dimension(join_dimension(facts, supplier, "id_fornecedor"), category, "id_categoria")
    return joined.withColumn("tem_contrato", F.col("contrato_id").isNotNull())


def priced_lines(lines: DataFrame) -> DataFrame:
    typed = lines.select(
        "id_pedido",
        F.col("id_item").cast("int").alias("id_item"),
        "descricao",
        *[amount(c).alias(c) for c in ("qtd", "preco_unitario", "preco_baseline")],
    )
    price, base, quantity = F.col("preco_unitario"), F.col("preco_baseline"), F.col("qtd")
    return typed.withColumns(
        {"valor_item": amount(price * quantity), "saving_item": amount((base - price) * quantity)}
    )


def timed_receipts(receipts: DataFrame) -> DataFrame:
    """No receipt date leaves delay and flags NULL; otif follows three-valued AND."""
    typed = receipts.select(
        "id_pedido",
        F.col("data_prometida").cast("date").alias("data_prometida"),
        F.col("data_recebida").cast("date").alias("data_recebida"),
        amount("qtd_recebida").alias("qtd_recebida"),
        F.col("ok_qualidade").cast("boolean").alias("ok_qualidade"),
    )
    return (
        typed.withColumn("dias_atraso", F.datediff("data_recebida", "data_prometida").cast("bigint"))
        .withColumn("no_prazo", F.col("dias_atraso") <= 0)
        .withColumn("otif", F.col("no_prazo") & F.col("ok_qualidade"))
    )


def clean_centers(centers: DataFrame) -> DataFrame:
    return centers.select(
        _clean_key(centers, "id_centro"),
        F.trim("nome").alias("centro_nome"),
        *[F.trim(c).alias(c) for c in ("area", "responsavel", "regiao")],
    )


def clean_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        _clean_key(accounts, "id_conta"),
        F.trim("nome").alias("conta_nome"),
        *[F.trim(c).alias(c) for c in ("tipo", "grupo")],
    )


def enriched_ledger(
    facts: DataFrame, key: str, value: str, centers: DataFrame, accounts: DataFrame
) -> DataFrame:
    """One monthly fact (budget or actuals) with its cost centre and account."""
    typed = facts.select(
        key, "id_centro", "id_conta", F.col("mes").cast("date").alias("mes"), amount(value).alias(value)
    )
    center = centers.select("id_centro", "centro_nome", "area", "regiao")
    account = accounts.select("id_conta", "conta_nome", "tipo", "grupo")
    return join_dimension(join_dimension(typed, center, "id_centro"), account, "id_conta")


def typed_assets(assets: DataFrame) -> DataFrame:
    return assets.select(
        "id_ativo", "tag", "tipo", "fabricante", "modelo", "site", "criticidade",
        F.col("data_instalacao").cast("date").alias("data_instalacao"),
        F.col("potencia_kw").cast("int").alias("potencia_kw"),
    )


def enriched_readings(readings: DataFrame, assets: DataFrame) -> DataFrame:
    typed = readings.select(
        "id_leitura",
        "id_ativo",
        F.col("data_hora").cast("timestamp_ntz").alias("data_hora"),
        *[F.col(c).cast("double").alias(c) for c in ("temperatura", "vibracao", "pressao")],
        F.col("rpm").cast("int").alias("rpm"),
    )
    return join_dimension(typed, assets.select("id_ativo", "tag", "tipo", "site", "criticidade"), "id_ativo")


def typed_failures(failures: DataFrame) -> DataFrame:
    return failures.select(
        "id_falha", "id_ativo", F.col("data_falha").cast("date").alias("data_falha"),
        "causa", "componente", "severidade",
    )


def typed_work_orders(work_orders: DataFrame) -> DataFrame:
    return work_orders.select(
        "id_ordem",
        "id_ativo",
        F.col("tipo").alias("tipo_ordem"),
        F.col("data_abertura").cast("date").alias("data_abertura"),
        F.col("data_fechamento").cast("date").alias("data_fechamento"),
        amount("custo").alias("custo"),
        F.col("downtime_horas").cast("double").alias("downtime_horas"),
        "descricao",
    )


def flagged_payments(payments: DataFrame, vendors: DataFrame, approvers: DataFrame) -> DataFrame:
    """Payments with vendor, approver and the seven non-conformity flags."""
    day = F.col("data_transacao").cast("date")
    facts = payments.select(
        "id_transacao",
        day.alias("data_transacao"),
        month_of(day).alias("mes"),
        "id_fornecedor",
        "id_solicitante",
        "id_aprovador",
        "area",
        blank_to_null("categoria_despesa").alias("categoria_despesa"),
        amount("valor").alias("valor"),
        "metodo_pagamento",
        blank_to_null("contrato_id").alias("contrato_id"),
        "status",
    )
    vendor = vendors.select(
        "id_fornecedor", "razao_social", "uf",
        F.col("possui_contrato").cast("boolean").alias("fornecedor_possui_contrato"),
        "situacao_cadastral",
        F.col("parte_relacionada").cast("boolean").alias("fornecedor_parte_relacionada"),
    )
    approver = approvers.select(
        "id_aprovador",
        F.col("nome").alias("aprovador_nome"),
        F.col("cargo").alias("aprovador_cargo"),
        amount("alcada_limite").alias("alcada_limite"),
    )
    joined = join_dimension(join_dimension(facts, vendor, "id_fornecedor"), approver, "id_aprovador")
    return joined.withColumns(payment_flags())


def payment_flags() -> dict[str, Column]:
    """Flags over the enriched payment; NULL inputs leave a NULL flag."""
    value = F.col("valor")
    return {
        "acima_alcada": value > F.col("alcada_limite"),
        "sem_contrato_relevante": ~F.col("fornecedor_possui_contrato") & (value >= CONTRACT_FLOOR),
        "sod_violado": F.col("id_solicitante") == F.col("id_aprovador"),
        "fornecedor_irregular": F.col("situacao_cadastral") == "Irregular",
        "parte_relacionada": F.col("fornecedor_parte_relacionada"),
        "dia_nao_util": F.dayofweek("data_transacao").isin(1, 7),
        "sem_categoria": F.col("categoria_despesa").isNull(),
    }


# What a finding tells of its payment.
OF_PAYMENT = ["area", "id_fornecedor", "razao_social", "valor"]


def ruled_findings(findings: DataFrame, rules: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Findings with the rule's own severity, and the columns of their payment that they carry."""
    detected = F.col("data_deteccao").cast("date")
    facts = findings.select(
        "id_achado",
        "id_transacao",
        "id_regra",
        detected.alias("data_deteccao"),
        month_of(detected).alias("mes"),
        "status_achado",
        amount("valor_em_risco").alias("valor_em_risco"),
        "descricao",
        *carried,
    )
    rule = rules.select(
        "id_regra",
        F.col("nome").alias("regra_nome"),
        "severidade",
        F.col("categoria").alias("regra_categoria"),
        "politica_referencia",
    )
    return join_dimension(facts, rule, "id_regra")


def enriched_findings(findings: DataFrame, rules: DataFrame, payments: DataFrame | None = None) -> DataFrame:
    """Findings with the rule's own severity and the payment they point at.

    Without `payments` the findings carry OF_PAYMENT themselves, as fresh ones can; stored ones are joined.
    """
    if payments is None:
        found = ruled_findings(findings, rules, OF_PAYMENT)
    else:
        found = ruled_findings(findings, rules).join(payments.select("id_transacao", *OF_PAYMENT), "id_transacao", "left")
    return found.withColumnRenamed("valor", "valor_transacao")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the one that sorts first on `order`.

    A partial aggregate, so a key holding much of the table is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def _clean_key(df: DataFrame, key: str) -> Column:
    """Trim a string key; leave a numeric one as it is."""
    return (F.trim(key) if dict(df.dtypes)[key] == "string" else F.col(key)).alias(key)
