"""Adapters from the lake tables to the raw case tables (see FIXTURES.md).

Every adapter is deterministic and reads its tables whole. Column names are the
public contract of the case tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.functions.columns import AMOUNT, month_of
from auriga.operators.audit_rules import RULES

# Actuals are known up to this day; the months after it are open, as a budget runs ahead of them.
ACTUALS_END = "2001-02-01"

# Approval limits per position.
POSITIONS = ["Analista", "Coordenador", "Gerente", "Diretor", "Vice-Presidente"]
LIMITS = [10_000, 50_000, 200_000, 1_000_000, 5_000_000]
PAYMENT_METHODS = ["Transferência", "Boleto", "Cartão corporativo", "Pix"]
LEVELS = ["Alta", "Média", "Baixa"]
ASSET_TYPES = ["Bomba", "Motor", "Britador", "Moinho"]
CAUSES = ["Desgaste", "Sobrecarga", "Lubrificação"]
PARTS = ["Mancal", "Selo", "Rotor", "Acoplamento"]


def pick(values: list, index: Column) -> Column:
    """values[index mod len(values)] as a column."""
    choices = F.array(*[F.lit(v) for v in values])
    return F.get(choices, F.pmod(index, F.lit(len(values))).cast("int"))


class Lake:
    """The parquet tables of one folder and the case tables derived from them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Each file's footer is read for its schema once per lake, not at every use."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._tables[name]

    def _supplier_of(self, customer: str) -> Column:
        suppliers = self.table("supplier").agg(F.count("*")).scalar()
        return F.pmod(F.col(customer), suppliers)

    def _orders_with_place(self) -> DataFrame:
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .withColumn("day", F.col("o_orderdate").cast("date"))
        )

    # --- procurement ---------------------------------------------------------

    def suppliers(self) -> DataFrame:
        slot = F.col("s_suppkey") % 10
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("id_fornecedor"),
                F.col("s_name").alias("razao_social"),
                F.col("n_name").alias("uf"),
                pick(LEVELS, F.col("s_suppkey")).alias("criticidade"),
                (slot == 0).alias("fornecedor_unico"),
                (slot >= 3).alias("possui_contrato"),
                F.when(slot == 5, "Irregular").otherwise("Regular").alias("situacao_cadastral"),
                (slot == 7).alias("parte_relacionada"),
            )
        )

    def purchase_categories(self) -> DataFrame:
        code = F.col("o_orderpriority")
        first = F.substring(code, 1, 1)
        return (
            self.table("orders")
            .select("o_orderpriority")
            .distinct()
            .select(
                code.alias("id_categoria"),
                F.substr(code, F.lit(3)).alias("nome"),
                F.when(first == "1", "CAPEX").when(first == "5", "Serviço").otherwise("MRO").alias("tipo"),
            )
        )

    def contracts(self) -> DataFrame:
        return (
            self.table("orders")
            .filter(F.col("o_orderkey") % 10 < 7)
            .groupBy(F.concat(F.lit("CT"), (F.col("o_orderkey") % 30).cast("string")).alias("contrato_id"))
            .agg(
                F.min(self._supplier_of("o_custkey")).alias("id_fornecedor"),
                F.sum(F.col("o_totalprice").cast(AMOUNT)).alias("valor_contratado"),
                F.min(F.col("o_orderdate").cast("date")).alias("vigencia_inicio"),
                F.max(F.col("o_orderdate").cast("date")).alias("vigencia_fim"),
            )
        )

    def _contract(self) -> Column:
        key = F.col("o_orderkey")
        return F.when(key % 10 < 7, F.concat(F.lit("CT"), (key % 30).cast("string"))).otherwise(" ")

    def purchase_orders(self) -> DataFrame:
        return self._orders_with_place().select(
            F.col("o_orderkey").alias("id_pedido"),
            self._supplier_of("o_custkey").alias("id_fornecedor"),
            F.col("o_orderpriority").alias("id_categoria"),
            F.col("day").alias("data_pedido"),
            F.col("r_name").alias("centro"),
            F.col("o_totalprice").cast(AMOUNT).alias("valor_total"),
            F.when(F.col("o_orderstatus") == "F", "Recebido")
            .when(F.col("o_orderstatus") == "P", "Aprovado")
            .otherwise("Aberto")
            .alias("status"),
            self._contract().alias("contrato_id"),
        )

    def order_lines(self) -> DataFrame:
        unit = F.col("l_extendedprice") / F.col("l_quantity")
        factor = F.lit(0.95) + F.col("l_discount")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("id_pedido"),
            F.col("l_linenumber").alias("id_item"),
            F.concat(F.lit("Item "), F.col("l_partkey").cast("string")).alias("descricao"),
            F.col("l_quantity").cast(AMOUNT).alias("qtd"),
            (F.floor(unit * 100) / 100).cast(AMOUNT).alias("preco_unitario"),
            (F.floor(unit * factor * 100) / 100).cast(AMOUNT).alias("preco_baseline"),
        )

    def receipts(self) -> DataFrame:
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        promised = F.date_add(F.col("o_orderdate").cast("date"), (30 + customer % 50).cast("int"))
        received = F.date_add(promised, (key * 7 % 38 - 26).cast("int"))
        return self.table("orders").select(
            key.alias("id_pedido"),
            promised.alias("data_prometida"),
            F.when(F.col("o_orderstatus") == "F", received).alias("data_recebida"),
            (customer % 50 + 1).cast(AMOUNT).alias("qtd_recebida"),
            (key % 10 != 0).alias("ok_qualidade"),
        )

    # --- finance -------------------------------------------------------------

    def cost_centers(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("id_centro"),
                F.col("n_name").alias("nome"),
                F.col("r_name").alias("area"),
                F.concat(F.lit("Resp "), F.col("n_nationkey").cast("string")).alias("responsavel"),
                F.col("r_name").alias("regiao"),
            )
        )

    def accounts(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return (
            self.table("customer")
            .select("c_mktsegment")
            .distinct()
            .select(
                segment.alias("id_conta"),
                F.concat(F.lit("Conta "), segment).alias("nome"),
                F.when(segment.isin("AUTOMOBILE", "MACHINERY"), "Receita")
                .when(segment == "BUILDING", "CAPEX")
                .otherwise("Despesa")
                .alias("tipo"),
                segment.alias("grupo"),
            )
        )

    def _ledger(self, end: str | None = None) -> DataFrame:
        orders = self.table("orders")
        if end:
            orders = orders.filter(F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz"))
        return (
            orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(
                F.col("c_nationkey").alias("id_centro"),
                F.col("c_mktsegment").alias("id_conta"),
                month_of(F.col("o_orderdate").cast("date")).alias("mes"),
            )
            .agg(F.sum(F.col("o_totalprice").cast(AMOUNT)).cast(AMOUNT).alias("v"))
        )

    def budget(self) -> DataFrame:
        weight = 90 + F.pmod(F.col("id_centro"), F.lit(5)) * 5
        planned = F.round(F.col("v").cast("double") * weight / 10000) * 100
        return self._ledger().select(
            self._ledger_key().alias("id_orcamento"),
            "id_centro",
            "id_conta",
            "mes",
            planned.cast(AMOUNT).alias("valor_orcado"),
        )

    def actuals(self, end: str = ACTUALS_END) -> DataFrame:
        return self._ledger(end).select(
            self._ledger_key().alias("id_lancamento"),
            "id_centro",
            "id_conta",
            "mes",
            F.col("v").alias("valor_realizado"),
        )

    def _ledger_key(self) -> Column:
        return F.concat_ws("-", F.col("id_centro").cast("string"), "id_conta", F.date_format("mes", "yyyyMM"))

    # --- maintenance ---------------------------------------------------------

    def assets(self) -> DataFrame:
        key = F.col("user_id")
        return (
            self.table("events")
            .select("user_id")
            .distinct()
            .select(
                key.alias("id_ativo"),
                F.concat(F.lit("AT-"), key.cast("string")).alias("tag"),
                pick(ASSET_TYPES, key).alias("tipo"),
                F.concat(F.lit("Fab "), (key % 5).cast("string")).alias("fabricante"),
                F.concat(F.lit("M"), (key % 7).cast("string")).alias("modelo"),
                F.concat(F.lit("Site "), (key % 6).cast("string")).alias("site"),
                pick(LEVELS, key).alias("criticidade"),
                F.date_add(F.lit("2015-01-01").cast("date"), (key % 3000).cast("int")).alias("data_instalacao"),
                (50 + key % 10 * 50).cast("int").alias("potencia_kw"),
            )
        )

    def readings(self) -> DataFrame:
        value = F.col("value")
        return (
            self.table("events")
            .filter(F.col("event_type").isin("view", "click", "signup"))
            .select(
                F.col("event_id").alias("id_leitura"),
                F.col("user_id").alias("id_ativo"),
                F.col("ts").alias("data_hora"),
                (40 + value / 10).alias("temperatura"),
                value.alias("vibracao"),
                (1 + value / 100).alias("pressao"),
                (F.get_json_object("props", "$.k").cast("int") * 10).alias("rpm"),
            )
        )

    def failures(self) -> DataFrame:
        key, value = F.col("event_id"), F.col("value")
        return (
            self.table("events")
            .filter(F.col("event_type") == "error")
            .select(
                key.alias("id_falha"),
                F.col("user_id").alias("id_ativo"),
                F.col("ts").cast("date").alias("data_falha"),
                pick(CAUSES, key).alias("causa"),
                pick(PARTS, key).alias("componente"),
                F.when(value >= 200, "Alta").when(value >= 150, "Média").otherwise("Baixa").alias("severidade"),
            )
        )

    def work_orders(self) -> DataFrame:
        key, value, day = F.col("event_id"), F.col("value"), F.col("ts").cast("date")
        return (
            self.table("events")
            .filter(F.col("event_type") == "purchase")
            .select(
                key.alias("id_ordem"),
                F.col("user_id").alias("id_ativo"),
                F.when(key % 4 == 0, "Corretiva").otherwise("Preventiva").alias("tipo"),
                day.alias("data_abertura"),
                F.date_add(day, (key % 3).cast("int")).alias("data_fechamento"),
                (value * 100).cast(AMOUNT).alias("custo"),
                (F.floor(value) / 10).alias("downtime_horas"),
                F.concat(F.lit("Ordem "), key.cast("string")).alias("descricao"),
            )
        )

    # --- audit ---------------------------------------------------------------

    def approvers(self) -> DataFrame:
        key = F.col("n_nationkey")
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                key.cast("bigint").alias("id_aprovador"),
                F.col("n_name").alias("nome"),
                pick(POSITIONS, key).alias("cargo"),
                F.col("r_name").alias("area"),
                pick(LIMITS, key).cast(AMOUNT).alias("alcada_limite"),
            )
        )

    def payments(self) -> DataFrame:
        key, segment = F.col("o_orderkey"), F.col("c_mktsegment")
        return self._orders_with_place().select(
            key.alias("id_transacao"),
            F.col("day").alias("data_transacao"),
            self._supplier_of("o_custkey").alias("id_fornecedor"),
            (key * 7 % 25).alias("id_solicitante"),
            F.col("c_nationkey").cast("bigint").alias("id_aprovador"),
            F.col("r_name").alias("area"),
            F.when(key % 20 == 0, " ")
            .when(segment == "HOUSEHOLD", "Brindes e hospitalidade")
            .otherwise(segment)
            .alias("categoria_despesa"),
            (F.round(F.col("o_totalprice") / 2000) * 1000).cast(AMOUNT).alias("valor"),
            pick(PAYMENT_METHODS, key).alias("metodo_pagamento"),
            self._contract().alias("contrato_id"),
            F.when(F.col("o_orderstatus") == "P", "Pendente").otherwise("Pago").alias("status"),
        )

    # --- documents -----------------------------------------------------------

    def documents(self) -> DataFrame:
        """Texts with the policy each source stands for; sources beyond the policies keep their name."""
        policies = sorted({rule[-1] for rule in RULES})
        number = F.substring("source", 4, 10).try_cast("int")
        named = F.get(F.array(*[F.lit(p) for p in policies]), number)
        return self.table("documents").select(
            F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("doc_nome"),
            F.coalesce(named, "source").alias("politica"),
            F.col("text").alias("texto"),
        )

    def questions(self) -> DataFrame:
        return self.table("benchmark").select(F.col("item_id").alias("id_consulta"), F.col("text").alias("texto"))

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"), F.col("embedding").alias("vetor"), "label", "embedding"
        )
