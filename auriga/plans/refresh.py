"""Refresh a case from its raw files: bronze and silver as streams, gold recomputed.

Dimensions join a silver stream as the snapshot they are at refresh time. A dimension row that lands later leaves NULLs in
rows already written; the refresh that sees it makes these rows again (REPAIRED), and no others.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.operators import audit, finance, maintenance, procurement, silver
from auriga.sources.files import RESCUED, cast_or_rescue, stream_csv
from auriga.sources.stored import replace_table
from auriga.streaming.repairs import Repairs
from auriga.streaming.tables import StreamTable

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class CaseLayers:
    """bronze: names of raw tables. silver: name -> (table streamed, transformation). gold: name -> plan.

    reads: what a silver table reads beside its stream, and a gold one at all.
    """

    bronze: list[str]
    silver: dict[str, tuple[str, Callable[[DataFrame, Tables], DataFrame]]]
    gold: dict[str, Callable[[Tables], DataFrame]] = field(default_factory=dict)
    reads: dict[str, list[str]] = field(default_factory=dict)

    def tables(self) -> list[str]:
        layers = {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}
        return [f"{layer}_{name}" for layer, names in layers.items() for name in names]

    def needed(self, wanted: Collection[str]) -> set[str]:
        """These tables and all that they are made of."""
        found, left = set(), [*wanted]
        while left:
            if (name := left.pop()) not in found:
                found.add(name)
                left += self.reads.get(name, [])
                if name.startswith("silver_"):
                    left.append(f"bronze_{self.silver[name.removeprefix('silver_')][0]}")
        return found


CASES = {
    "suprimentos": CaseLayers(
        ["fornecedores", "categorias_compra", "contratos", "pedidos_compra", "itens_pedido", "recebimentos"],
        {
            "pedidos": ("pedidos_compra", lambda s, t: silver.enriched_orders(
                s, t["bronze_fornecedores"], t["bronze_categorias_compra"])),
            "itens": ("itens_pedido", lambda s, t: silver.priced_lines(s)),
            "recebimentos": ("recebimentos", lambda s, t: silver.timed_receipts(s)),
        },
        {
            "gasto_categoria": lambda t: procurement.category_spend(t["silver_pedidos"]),
            "lead_time_fornecedor": lambda t: procurement.supplier_delivery(
                t["silver_recebimentos"], t["silver_pedidos"]),
            "saving": lambda t: procurement.category_saving(t["silver_itens"], t["silver_pedidos"]),
            "aderencia_contrato": lambda t: procurement.contract_coverage(t["silver_pedidos"]),
            "fornecedor_unico": lambda t: procurement.sole_source_spend(t["silver_pedidos"]),
        },
        {
            "silver_pedidos": ["bronze_fornecedores", "bronze_categorias_compra"],
            "gold_gasto_categoria": ["silver_pedidos"],
            "gold_lead_time_fornecedor": ["silver_recebimentos", "silver_pedidos"],
            "gold_saving": ["silver_itens", "silver_pedidos"],
            "gold_aderencia_contrato": ["silver_pedidos"],
            "gold_fornecedor_unico": ["silver_pedidos"],
        },
    ),
    "financas": CaseLayers(
        ["centros_custo", "contas_contabeis", "orcamento", "lancamentos"],
        {
            "centros": ("centros_custo", lambda s, t: silver.clean_centers(s)),
            "contas": ("contas_contabeis", lambda s, t: silver.clean_accounts(s)),
            "orcamento": ("orcamento", lambda s, t: silver.enriched_ledger(
                s, "id_orcamento", "valor_orcado", t["silver_centros"], t["silver_contas"])),
            "realizado": ("lancamentos", lambda s, t: silver.enriched_ledger(
                s, "id_lancamento", "valor_realizado", t["silver_centros"], t["silver_contas"])),
        },
        {
            "orcado_vs_realizado": lambda t: finance.budget_vs_actual(t["silver_orcamento"], t["silver_realizado"]),
            "variacao_budget": lambda t: finance.budget_variance(t["gold_orcado_vs_realizado"]),
            "despesa_categoria": lambda t: finance.expense_by_group(t["gold_orcado_vs_realizado"]),
            "receita_mensal": lambda t: finance.monthly_revenue(t["gold_orcado_vs_realizado"]),
            "topo_estouros": lambda t: finance.top_overruns(t["gold_orcado_vs_realizado"]),
        },
        {
            "silver_orcamento": ["silver_centros", "silver_contas"],
            "silver_realizado": ["silver_centros", "silver_contas"],
            "gold_orcado_vs_realizado": ["silver_orcamento", "silver_realizado"],
            "gold_variacao_budget": ["gold_orcado_vs_realizado"],
            "gold_despesa_categoria": ["gold_orcado_vs_realizado"],
            "gold_receita_mensal": ["gold_orcado_vs_realizado"],
            "gold_topo_estouros": ["gold_orcado_vs_realizado"],
        },
    ),
    "manutencao": CaseLayers(
        ["ativos", "falhas", "ordens_manutencao", "leituras_sensores"],
        {
            "ativos": ("ativos", lambda s, t: silver.typed_assets(s)),
            "leituras": ("leituras_sensores", lambda s, t: silver.enriched_readings(s, t["bronze_ativos"])),
            "falhas": ("falhas", lambda s, t: silver.typed_failures(s)),
            "ordens": ("ordens_manutencao", lambda s, t: silver.typed_work_orders(s)),
        },
        {
            "telemetria_resumo": lambda t: maintenance.daily_telemetry(t["silver_leituras"]),
            "saude_ativo": lambda t: maintenance.asset_health(t["silver_leituras"], t["silver_ativos"]),
            "mtbf": lambda t: maintenance.mean_time_between_failures(t["silver_falhas"], t["silver_ativos"]),
            "custo_manutencao": lambda t: maintenance.maintenance_cost(t["silver_ordens"], t["silver_ativos"]),
            "ativos_risco": lambda t: maintenance.assets_at_risk(
                t["gold_saude_ativo"], t["gold_mtbf"], t["silver_ordens"]),
        },
        {
            "silver_leituras": ["bronze_ativos"],
            "gold_telemetria_resumo": ["silver_leituras"],
            "gold_saude_ativo": ["silver_leituras", "silver_ativos"],
            "gold_mtbf": ["silver_falhas", "silver_ativos"],
            "gold_custo_manutencao": ["silver_ordens", "silver_ativos"],
            "gold_ativos_risco": ["gold_saude_ativo", "gold_mtbf", "silver_ordens"],
        },
    ),
    "auditoria": CaseLayers(
        ["fornecedores", "aprovadores", "regras_compliance", "transacoes", "achados_auditoria"],
        {
            "transacoes": ("transacoes", lambda s, t: silver.flagged_payments(
                s, t["bronze_fornecedores"], t["bronze_aprovadores"])),
            "achados": ("achados_auditoria", lambda s, t: silver.enriched_findings(
                s, t["bronze_regras_compliance"], t["silver_transacoes"])),
        },
        {
            "achados": lambda t: audit.findings_by_rule(t["silver_achados"]),
            "violacoes_alcada": lambda t: audit.limit_violations(t["silver_transacoes"]),
            "gasto_sem_contrato": lambda t: audit.uncontracted_spend(t["silver_transacoes"]),
            "resumo_compliance": lambda t: audit.compliance_summary(t["silver_transacoes"], t["silver_achados"]),
        },
        {
            "silver_transacoes": ["bronze_fornecedores", "bronze_aprovadores"],
            "silver_achados": ["bronze_regras_compliance", "silver_transacoes"],
            "gold_achados": ["silver_achados"],
            "gold_violacoes_alcada": ["silver_transacoes"],
            "gold_gasto_sem_contrato": ["silver_transacoes"],
            "gold_resumo_compliance": ["silver_transacoes", "silver_achados"],
        },
    ),
}


# What silver reads typed. Text that does not fit is set aside, so one bad value stops no table.
TYPES = {
    "pedidos_compra": {"data_pedido": "date", "valor_total": "decimal(18,2)"},
    "itens_pedido": {
        "id_item": "int", "qtd": "decimal(18,2)", "preco_unitario": "decimal(18,2)", "preco_baseline": "decimal(18,2)"},
    "recebimentos": {
        "data_prometida": "date", "data_recebida": "date", "qtd_recebida": "decimal(18,2)", "ok_qualidade": "boolean"},
    "orcamento": {"mes": "date", "valor_orcado": "decimal(18,2)"},
    "lancamentos": {"mes": "date", "valor_realizado": "decimal(18,2)"},
    "ativos": {"data_instalacao": "date", "potencia_kw": "int"},
    "leituras_sensores": {
        "data_hora": "timestamp_ntz", "temperatura": "double", "vibracao": "double", "pressao": "double", "rpm": "int"},
    "falhas": {"data_falha": "date"},
    "ordens_manutencao": {
        "data_abertura": "date", "data_fechamento": "date", "custo": "decimal(18,2)", "downtime_horas": "double"},
    "transacoes": {"data_transacao": "date", "valor": "decimal(18,2)"},
    "achados_auditoria": {"data_deteccao": "date", "valor_em_risco": "decimal(18,2)"},
}


# Silver tables whose rows are repaired when a dimension row lands late: their key, and the key of each dimension.
REPAIRED = {
    "suprimentos": {"pedidos": ("id_pedido", {"fornecedores": "id_fornecedor", "categorias_compra": "id_categoria"})},
    "manutencao": {"leituras": ("id_leitura", {"ativos": "id_ativo"})},
    "auditoria": {"transacoes": ("id_transacao", {"fornecedores": "id_fornecedor", "aprovadores": "id_aprovador"})},
}


def raw_source(raw: str, name: str) -> tuple[str, str]:
    """Where the files of a raw table are: one file of its name, or the numbered lots of the sensors."""
    return raw, f"{name}_lote*.csv" if name == "leituras_sensores" else f"{name}.csv"


def refresh_bronze(
    spark: SparkSession, case: str, raw: str, root: str, full: bool = False,
    source: Callable[[str, str], tuple[str, str]] = raw_source, only: Collection[str] | None = None,
) -> Tables:
    """Raw tables do not depend on each other, so their streams run side by side. `only` names the tables to refresh."""
    names = [name for name in CASES[case].bronze if only is None or f"bronze_{name}" in only]
    tables = {name: StreamTable(spark, root, f"bronze_{name}") for name in names}
    running = [
        table.start(stream_csv(spark, *source(raw, name)), full)
        for name, table in tables.items()
    ]
    for query in running:
        query.awaitTermination()
    return {f"bronze_{name}": table.read() for name, table in tables.items()}


def refresh_silver(
    spark: SparkSession, case: str, root: str, tables: Tables, full: bool = False, only: Collection[str] | None = None
) -> Tables:
    """Silver tables, and a `rescued_` table beside each with the rows of which some text did not fit."""
    tables = dict(tables)
    for name, (streamed, transform) in CASES[case].silver.items():
        if only is not None and f"silver_{name}" not in only:
            continue
        facts = StreamTable(spark, root, f"bronze_{streamed}").stream()
        facts = cast_or_rescue(facts, TYPES.get(streamed, {}))
        misfits = StreamTable(spark, root, f"rescued_{name}")
        running = misfits.start(facts.filter(F.col(RESCUED).isNotNull()), full)
        table = StreamTable(spark, root, f"silver_{name}").refresh(transform(facts, tables), full)
        running.awaitTermination()
        tables[f"silver_{name}"], tables[f"rescued_{name}"] = table.read(), misfits.read(facts.schema)
        if name in REPAIRED.get(case, {}):
            row_key, dimensions = REPAIRED[case][name]
            repairs = Repairs(spark, root, name, table.version, row_key)
            stored = cast_or_rescue(tables[f"bronze_{streamed}"], TYPES.get(streamed, {}))
            known = {d: (tables[f"bronze_{d}"], key) for d, key in dimensions.items()}
            repairs.refresh(stored, known, lambda late, make=transform, now=tables: make(late, now))
            tables[f"silver_{name}"] = repairs.applied(tables[f"silver_{name}"])
    return tables


def refresh_gold(
    spark: SparkSession, case: str, root: str, tables: Tables, only: Collection[str] | None = None
) -> Tables:
    """Recompute and replace. A gold table may read the gold tables before it."""
    tables = dict(tables)
    for name, plan in CASES[case].gold.items():
        if only is None or f"gold_{name}" in only:
            tables[f"gold_{name}"] = replace_table(plan(tables), f"{root}/gold_{name}")
    return tables


def refresh_case(
    spark: SparkSession, case: str, raw: str, root: str, full: bool = False,
    source: Callable[[str, str], tuple[str, str]] = raw_source, wanted: Collection[str] | None = None,
) -> Tables:
    """All three layers and what was rescued; every table by its prefixed name.

    With `wanted`, only these tables and those that they are made of.
    """
    only = None if wanted is None else CASES[case].needed(wanted)
    bronze = refresh_bronze(spark, case, raw, root, full, source, only)
    return refresh_gold(spark, case, root, refresh_silver(spark, case, root, bronze, full, only), only)
