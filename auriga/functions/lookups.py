"""Parameterised lookups: a table of arguments joined with a gold table, or a SQL table function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.functions.columns import share, total


def supplier_otif(names: DataFrame, delivery: DataFrame) -> DataFrame:
    """names(razao_social) -> OTIF of each supplier of that name."""
    return names.join(delivery.select("razao_social", "id_fornecedor", "otif_pct"), "razao_social")


def account_variance(accounts: DataFrame, variance: DataFrame) -> DataFrame:
    """accounts(conta_nome) -> budget, actual and variance, summed over cost centres."""
    sums = variance.groupBy("conta_nome").agg(
        total("orcado_total").alias("orcado"),
        total("realizado_total").alias("realizado"),
        total("variancia").alias("variancia"),
        share(F.sum("variancia"), F.sum("orcado_total")).alias("variancia_pct"),
    )
    return accounts.join(sums, "conta_nome")


def asset_status(keys: DataFrame, health: DataFrame) -> DataFrame:
    """keys(ativo) -> health of the asset with that id or tag.

    Each asset offers both of its names, so the lookup stays an equality join.
    """
    named = health.select(
        F.explode(F.array_distinct(F.array(F.col("id_ativo").cast("string"), "tag"))).alias("ativo"),
        "id_ativo", "score_risco", "categoria_risco", "vibracao_recente",
    )
    return keys.join(named, "ativo")


def vendor_findings(vendors: DataFrame, findings: DataFrame) -> DataFrame:
    """vendors(razao_social) -> findings and value at risk; findings fold per vendor first."""
    sums = findings.groupBy("razao_social").agg(
        F.count("*").alias("qtd_achados"), total("valor_em_risco").alias("valor_em_risco")
    )
    return vendors.join(sums, "razao_social")


_FUNCTIONS = {
    "sup_otif_fornecedor": (
        "nome STRING", "id_fornecedor {id_fornecedor}, otif_pct DOUBLE",
        "SELECT id_fornecedor, otif_pct FROM {table} WHERE razao_social = nome",
    ),
    "fin_variancia_conta": (
        "nome STRING",
        "orcado DECIMAL(28,2), realizado DECIMAL(28,2), variancia DECIMAL(28,2), variancia_pct DOUBLE",
        """SELECT CAST(sum(orcado_total) AS DECIMAL(28,2)), CAST(sum(realizado_total) AS DECIMAL(28,2)),
                  CAST(sum(v.variancia) AS DECIMAL(28,2)),
                  round(100 * CAST(sum(v.variancia) AS DOUBLE) / nullif(CAST(sum(orcado_total) AS DOUBLE), 0), 1)
           FROM {table} v WHERE conta_nome = nome""",
    ),
    "mnt_saude_ativo": (
        "ativo STRING", "id_ativo {id_ativo}, score_risco INT, categoria_risco STRING, vibracao_recente DOUBLE",
        """SELECT id_ativo, score_risco, categoria_risco, vibracao_recente FROM {table}
           WHERE CAST(id_ativo AS STRING) = ativo OR tag = ativo""",
    ),
    "aud_achados_fornecedor": (
        "nome STRING", "qtd_achados BIGINT, valor_em_risco DECIMAL(28,2)",
        """SELECT count(*), CAST(coalesce(sum(valor_em_risco), 0) AS DECIMAL(28,2))
           FROM {table} WHERE razao_social = nome""",
    ),
}


def register_functions(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Create the SQL table functions; `tables` maps each function to the table it reads. Ids keep its types."""
    for name, table in tables.items():
        arguments, columns, body = _FUNCTIONS[name]
        columns = columns.format_map(dict(table.dtypes))
        view = f"{name}_origem"
        table.createOrReplaceTempView(view)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({columns}) "
            f"RETURN {body.format(table=view)}"
        )
