"""Quality jobs (Q), layer counts (S12) and change feed (S13)."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import functions as F

from auriga.operators import changes, finance, quality
from auriga.plans.oracle_tables import pct_true, ratio, tot, tot_where

FIRST_SNAPSHOT = "2000-06-30"
SECOND_SNAPSHOT = "2000-12-31"


def _orphans(c):
    lake = c.lake
    contracted = c.stored_orders.filter(F.col("contrato_id").isNotNull())
    checks = [
        ("pedidos", c.stored_orders, "id_fornecedor", lake.suppliers(), "id_fornecedor"),
        ("pedidos", c.stored_orders, "id_categoria", lake.purchase_categories(), "id_categoria"),
        ("pedidos", contracted, "contrato_id", lake.contracts(), "contrato_id"),
        ("contratos", lake.contracts(), "id_fornecedor", lake.suppliers(), "id_fornecedor"),
        ("itens", c.lines, "id_pedido", c.stored_orders, "id_pedido"),
        ("recebimentos", c.receipts, "id_pedido", c.stored_orders, "id_pedido"),
        ("orcamento", c.budget, "id_centro", c.centers, "id_centro"),
        ("orcamento", c.budget, "id_conta", c.accounts, "id_conta"),
        ("lancamentos", c.actuals, "id_centro", c.centers, "id_centro"),
        ("lancamentos", c.actuals, "id_conta", c.accounts, "id_conta"),
        ("leituras", c.readings, "id_ativo", c.assets, "id_ativo"),
        ("falhas", c.failures, "id_ativo", c.assets, "id_ativo"),
        ("ordens", c.work_orders, "id_ativo", c.assets, "id_ativo"),
        ("transacoes", c.stored_payments, "id_fornecedor", lake.suppliers(), "id_fornecedor"),
        ("transacoes", c.stored_payments, "id_aprovador", lake.approvers(), "id_aprovador"),
        ("transacoes", c.stored_payments, "id_solicitante", lake.approvers(), "id_aprovador"),
        ("achados", c.stored_raised, "id_transacao", c.stored_payments, "id_transacao"),
        ("achados", c.stored_raised, "id_regra", c.rules, "id_regra"),
        ("rotulos", lake.table("labels"), "doc_id", lake.table("documents"), "doc_id"),
    ]
    return quality.stack([quality.orphan_count(*check) for check in checks])


_ORPHANS = [
    ("pedidos", "t_orders", "id_fornecedor", "t_suppliers", "id_fornecedor"),
    ("pedidos", "t_orders", "id_categoria", "t_categories", "id_categoria"),
    ("pedidos", "(SELECT * FROM t_orders WHERE contrato_id IS NOT NULL)", "contrato_id", "t_contracts", "contrato_id"),
    ("contratos", "t_contracts", "id_fornecedor", "t_suppliers", "id_fornecedor"),
    ("itens", "t_lines", "id_pedido", "t_orders", "id_pedido"),
    ("recebimentos", "t_receipts", "id_pedido", "t_orders", "id_pedido"),
    ("orcamento", "t_budget", "id_centro", "t_centers", "id_centro"),
    ("orcamento", "t_budget", "id_conta", "t_accounts", "id_conta"),
    ("lancamentos", "t_actuals", "id_centro", "t_centers", "id_centro"),
    ("lancamentos", "t_actuals", "id_conta", "t_accounts", "id_conta"),
    ("leituras", "t_readings", "id_ativo", "t_assets", "id_ativo"),
    ("falhas", "t_failures", "id_ativo", "t_assets", "id_ativo"),
    ("ordens", "t_work", "id_ativo", "t_assets", "id_ativo"),
    ("transacoes", "t_payments", "id_fornecedor", "t_suppliers", "id_fornecedor"),
    ("transacoes", "t_payments", "id_aprovador", "t_approvers", "id_aprovador"),
    ("transacoes", "t_payments", "id_solicitante", "t_approvers", "id_aprovador"),
    ("achados", "t_raised", "id_transacao", "t_payments", "id_transacao"),
    ("achados", "t_raised", "id_regra", "t_rules", "id_regra"),
    ("rotulos", "labels", "doc_id", "documents", "doc_id"),
]
_DUPLICATES = [
    ("orcamento", "t_budget", ["id_centro", "id_conta", "mes"]),
    ("lancamentos", "t_actuals", ["id_centro", "id_conta", "mes"]),
    ("leituras", "t_readings", ["id_ativo", "data_hora"]),
    ("itens", "t_lines", ["id_pedido", "id_item"]),
    ("pedidos", "t_orders", ["id_pedido"]),
    ("achados", "t_raised", ["id_transacao", "id_regra"]),
]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _backlog_sql(day: str) -> str:
    return f"""SELECT id_pedido, razao_social, valor_total, data_prometida, data_prometida < DATE '{day}' AS vencido
        FROM t_orders JOIN t_receipts USING (id_pedido)
        WHERE data_pedido <= DATE '{day}' AND (data_recebida IS NULL OR data_recebida > DATE '{day}')"""


EXTRA = {
    "t_contracts": """SELECT contrato_id, min(id_fornecedor) AS id_fornecedor FROM t_orders
        WHERE contrato_id IS NOT NULL GROUP BY 1""",
    "t_backlog_before": _backlog_sql(FIRST_SNAPSHOT),
    "t_backlog_after": _backlog_sql(SECOND_SNAPSHOT),
}

# Bronze tables of each case: (name, adapter).
RAW = {
    "suprimentos": [
        ("fornecedores", "suppliers"), ("categorias_compra", "purchase_categories"), ("contratos", "contracts"),
        ("pedidos_compra", "purchase_orders"), ("itens_pedido", "order_lines"), ("recebimentos", "receipts"),
    ],
    "financas": [
        ("centros_custo", "cost_centers"), ("contas_contabeis", "accounts"), ("orcamento", "budget"),
        ("lancamentos", "actuals"),
    ],
    "manutencao": [
        ("ativos", "assets"), ("falhas", "failures"), ("ordens_manutencao", "work_orders"),
        ("leituras_sensores", "readings"),
    ],
    "auditoria": [
        ("fornecedores", "suppliers"), ("aprovadores", "approvers"), ("regras_compliance", None),
        ("transacoes", "payments"), ("achados_auditoria", None),
    ],
}


def raw_tables(c, case: str, names: Collection[str] | None = None) -> dict:
    """The raw tables of a case, or those named; rules and findings come from the rule engine."""
    made = {"regras_compliance": lambda: c.rules, "achados_auditoria": lambda: c.raised}
    return {name: getattr(c.lake, adapter)() if adapter else made[name]() for name, adapter in RAW[case]
            if names is None or name in names}


def layer_counts(c, case: str):
    """Rows of every stored table of a refreshed case."""
    from auriga.plans.catalog.ingest import refreshed

    tables, parts = refreshed(c, case), []
    for layer in ("bronze", "silver", "gold"):
        own = {n.removeprefix(f"{layer}_"): df for n, df in tables.items() if n.startswith(f"{layer}_")}
        parts.append(quality.row_counts(layer, own))
    return quality.stack(parts)


def checked_tables(case: str) -> list[str]:
    return [f"{layer}_{name}" for _, of, bronze, silver, *_ in _KEYED if of == case
            for layer, name in (("bronze", bronze), ("silver", silver))]


def stored_check(c, name: str, case: str, bronze: str, silver: str, keys: list[str]):
    """A stored bronze table against the stored silver table made of it."""
    from auriga.plans.catalog.ingest import refreshed

    tables = refreshed(c, case, checked_tables(case))
    return quality.layer_check(name, tables[f"bronze_{bronze}"], tables[f"silver_{silver}"], keys)


_COUNTED = {
    "suprimentos": [
        ("bronze", "fornecedores", "t_suppliers"), ("bronze", "categorias_compra", "t_categories"),
        ("bronze", "contratos", "t_contracts"), ("bronze", "pedidos_compra", "t_orders"),
        ("bronze", "itens_pedido", "t_lines"), ("bronze", "recebimentos", "t_receipts"),
        ("silver", "pedidos", "t_orders"), ("silver", "itens", "t_lines"), ("silver", "recebimentos", "t_receipts"),
        ("gold", "gasto_categoria", "t_category_spend"), ("gold", "lead_time_fornecedor", "t_delivery"),
        ("gold", "saving", "t_saving"), ("gold", "aderencia_contrato", "(SELECT DISTINCT centro FROM t_orders)"),
        ("gold", "fornecedor_unico", "(SELECT DISTINCT id_fornecedor FROM t_orders WHERE fornecedor_unico)"),
    ],
    "financas": [
        ("bronze", "centros_custo", "t_centers"), ("bronze", "contas_contabeis", "t_accounts"),
        ("bronze", "orcamento", "t_budget"), ("bronze", "lancamentos", "t_actuals"),
        ("silver", "centros", "t_centers"), ("silver", "contas", "t_accounts"), ("silver", "orcamento", "t_budget"),
        ("silver", "realizado", "t_actuals"), ("gold", "orcado_vs_realizado", "t_base"),
        ("gold", "variacao_budget", "t_variance"),
        ("gold", "despesa_categoria", "(SELECT DISTINCT grupo, mes FROM t_base WHERE tipo = 'Despesa')"),
        ("gold", "receita_mensal", "t_revenue"), ("gold", "topo_estouros", "t_overruns"),
    ],
    "manutencao": [
        ("bronze", "ativos", "t_assets"), ("bronze", "falhas", "t_failures"),
        ("bronze", "ordens_manutencao", "t_work"), ("bronze", "leituras_sensores", "t_readings"),
        ("silver", "ativos", "t_assets"), ("silver", "leituras", "t_readings"), ("silver", "falhas", "t_failures"),
        ("silver", "ordens", "t_work"), ("gold", "telemetria_resumo", "t_daily"), ("gold", "saude_ativo", "t_health"),
        ("gold", "mtbf", "t_mtbf"), ("gold", "custo_manutencao", "t_cost"), ("gold", "ativos_risco", "t_risk"),
    ],
    "auditoria": [
        ("bronze", "fornecedores", "t_suppliers"), ("bronze", "aprovadores", "t_approvers"),
        ("bronze", "regras_compliance", "t_rules"), ("bronze", "transacoes", "t_payments"),
        ("bronze", "achados_auditoria", "t_raised"), ("silver", "transacoes", "t_payments"),
        ("silver", "achados", "t_findings"), ("gold", "achados", "t_finding_rules"),
        ("gold", "violacoes_alcada", "(SELECT * FROM t_payments WHERE acima_alcada)"),
        ("gold", "gasto_sem_contrato", "t_uncontracted"), ("gold", "resumo_compliance", "t_compliance"),
    ],
}


_KEYED = [
    ("pedidos", "suprimentos", "pedidos_compra", "pedidos", ["id_pedido", "id_fornecedor"], "t_orders"),
    ("itens", "suprimentos", "itens_pedido", "itens", ["id_pedido", "id_item"], "t_lines"),
    ("recebimentos", "suprimentos", "recebimentos", "recebimentos", ["id_pedido"], "t_receipts"),
    ("orcamento", "financas", "orcamento", "orcamento", ["id_centro", "id_conta", "mes"], "t_budget"),
    ("lancamentos", "financas", "lancamentos", "realizado", ["id_centro", "id_conta", "mes"], "t_actuals"),
    ("leituras", "manutencao", "leituras_sensores", "leituras", ["id_leitura", "id_ativo"], "t_readings"),
    ("transacoes", "auditoria", "transacoes", "transacoes", ["id_transacao"], "t_payments"),
]


def register(add_query) -> None:
    def add(name, build, sql=None):
        add_query(name, build, sql, **EXTRA)

    for case, tables in _COUNTED.items():
        add(
            f"s12_layer_counts_{case}",
            lambda c, case=case: layer_counts(c, case),
            _union(
                [f"SELECT '{layer}' AS camada, '{name}' AS tabela, count(*) AS linhas FROM {table}"
                 for layer, name, table in tables]
            ),
        )
    add(
        "s13_backlog_changes",
        lambda c: changes.change_feed(
            changes.open_backlog(c.stored_orders, c.receipts, FIRST_SNAPSHOT),
            changes.open_backlog(c.stored_orders, c.receipts, SECOND_SNAPSHOT),
            ["id_pedido"],
        ),
        """SELECT id_pedido, coalesce(a.razao_social, b.razao_social) AS razao_social,
                  coalesce(a.valor_total, b.valor_total) AS valor_total,
                  coalesce(a.data_prometida, b.data_prometida) AS data_prometida,
                  coalesce(a.vencido, b.vencido) AS vencido,
                  CASE WHEN b.valor_total IS NULL THEN 'insert' WHEN a.valor_total IS NULL THEN 'delete'
                       ELSE 'update' END AS _change
           FROM t_backlog_before b FULL JOIN t_backlog_after a USING (id_pedido)
           WHERE a.valor_total IS NULL OR b.valor_total IS NULL OR a.vencido <> b.vencido""",
    )

    add(
        "q1_orphans",
        _orphans,
        _union(
            [f"""SELECT '{name}' AS tabela, '{key}' AS chave, count(*) AS orfaos FROM {fact} f
                 WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dim_key} = f.{key})"""
             for name, fact, key, dim, dim_key in _ORPHANS]
        ),
    )
    add(
        "q2_duplicate_keys",
        lambda c: quality.stack(
            [
                quality.duplicate_count(name, df, keys)
                for (name, _, keys), df in zip(
                    _DUPLICATES, [c.budget, c.actuals, c.readings, c.lines, c.orders, c.raised]
                )
            ]
        ),
        _union(
            [f"""SELECT '{name}' AS tabela, '{', '.join(keys)}' AS chave,
                        CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicadas
                 FROM (SELECT count(*) AS n FROM {table} GROUP BY {', '.join(keys)})"""
             for name, table, keys in _DUPLICATES]
        ),
    )
    add(
        "q3_header_against_lines",
        lambda c: quality.header_against_lines(c.orders, c.lines),
        """SELECT count(*) AS pedidos, count(*) FILTER (WHERE soma IS NULL) AS pedidos_sem_itens,
                  count(*) FILTER (WHERE abs(valor_total - soma) >= 0.01) AS pedidos_divergentes,
                  CAST(max(abs(valor_total - soma)) AS DECIMAL(28,2)) AS maior_diferenca
           FROM t_orders LEFT JOIN (SELECT id_pedido, sum(valor_item) AS soma FROM t_lines GROUP BY 1)
             USING (id_pedido)""",
    )
    add(
        "q4_procurement_rates",
        lambda c: quality.procurement_rates(c.orders, c.lines, c.receipts, "URGENT"),
        f"""SELECT r.*, l.*, o.*
            FROM (SELECT {pct_true('dias_atraso > 0')} AS pct_atraso, {pct_true('otif')} AS pct_otif
                  FROM t_receipts WHERE data_recebida IS NOT NULL) r,
                 (SELECT {pct_true('preco_unitario < preco_baseline')} AS pct_itens_com_saving FROM t_lines) l,
                 (SELECT {pct_true('NOT tem_contrato')} AS pct_pedidos_fora_contrato,
                         {ratio('sum(valor_total) FILTER (WHERE fornecedor_unico)', 'sum(valor_total)')}
                           AS pct_gasto_fonte_unica,
                         {ratio("sum(valor_total) FILTER (WHERE categoria_nome = 'URGENT')", 'sum(valor_total)')}
                           AS pct_gasto_categoria FROM t_orders) o""",
    )

    def spent(kind: str) -> str:
        return tot_where(f"tipo = '{kind}'", "valor_realizado")

    def off(kind: str) -> str:
        return ratio(
            f"sum(variancia) FILTER (WHERE tipo = '{kind}')", f"sum(valor_orcado) FILTER (WHERE tipo = '{kind}')"
        )

    add(
        "q5_finance_signals",
        lambda c: quality.finance_signals(c.stored_base),
        f"""SELECT t.*, p.* FROM (
              SELECT {spent('Receita')} AS receita, {spent('Despesa')} AS despesa, {spent('CAPEX')} AS capex,
                     CAST({spent('Receita')} - {spent('Despesa')} AS DECIMAL(28,2)) AS resultado,
                     {off('Despesa')} AS variancia_despesa_pct, {off('Receita')} AS variancia_receita_pct
              FROM t_base WHERE valor_realizado IS NOT NULL) t,
             (SELECT count(*) AS pares_despesa, count(*) FILTER (WHERE variancia > 0) AS pares_com_estouro
              FROM t_variance WHERE tipo = 'Despesa') p""",
    )
    add(
        "q5_top_five_overruns",
        lambda c: finance.top_overruns(c.budget_base).orderBy("posicao", "id_conta", "id_centro").limit(5),
        "SELECT * FROM t_overruns ORDER BY posicao, id_conta, id_centro LIMIT 5",
    )
    add(
        "q6_actuals_without_budget",
        lambda c: quality.actuals_without_budget(c.actuals, c.budget),
        """SELECT count(*) AS sem_orcamento FROM t_actuals a WHERE NOT EXISTS (
             SELECT 1 FROM t_budget b WHERE b.id_centro = a.id_centro AND b.id_conta = a.id_conta AND b.mes = a.mes)""",
    )
    add(
        "q7_series_readiness",
        lambda c: quality.series_readiness(
            finance.monthly_revenue(c.budget_base), "mes", "receita_realizada"
        ),
        """SELECT count(DISTINCT mes) AS pontos, min(mes) AS primeiro, max(mes) AS ultimo,
                  count(DISTINCT mes) >= 24 AS pronta FROM t_revenue WHERE receita_realizada IS NOT NULL""",
    )
    add(
        "q8_findings_by_severity",
        lambda c: quality.findings_by_severity(c.ruled_findings),
        f"""SELECT severidade, count(*) AS qtd_achados, {tot('valor_em_risco')} AS valor_em_risco
            FROM t_findings GROUP BY 1""",
    )
    add(
        "q8_failures_per_asset",
        lambda c: quality.failures_per_asset(c.failures),
        """SELECT n_falhas, count(*) AS ativos
           FROM (SELECT count(*) AS n_falhas FROM t_failures GROUP BY id_ativo) GROUP BY 1""",
    )
    add(
        "q8_maintenance_coverage",
        lambda c: quality.maintenance_coverage(c.assets, c.failures, c.work_orders),
        f"""SELECT a.*, f.*, w.* FROM (
              SELECT count(*) AS ativos, count(DISTINCT tipo) AS tipos,
                     count(*) FILTER (WHERE criticidade = 'Alta') AS ativos_criticidade_alta FROM t_assets) a,
             (SELECT CAST(sum(n) AS BIGINT) AS falhas, count(*) AS ativos_com_falha,
                     count(*) FILTER (WHERE n = 2) AS ativos_com_duas_falhas
              FROM (SELECT count(*) AS n FROM t_failures GROUP BY id_ativo)) f,
             (SELECT count(*) FILTER (WHERE tipo_ordem = 'Corretiva') AS ordens_corretivas,
                     count(*) FILTER (WHERE tipo_ordem = 'Preventiva') AS ordens_preventivas,
                     {tot('custo')} AS custo_total FROM t_work) w""",
    )
    signals = {
        "acima_alcada": "acima_alcada", "sod": "sod_violado", "sem_categoria": "sem_categoria",
        "sem_contrato": "NOT fornecedor_possui_contrato",
    }
    add(
        "q8_audit_signals",
        lambda c: quality.audit_signals(c.payments, c.lake.suppliers()),
        f"""SELECT p.*, v.* FROM (
              SELECT count(*) AS transacoes,
                     {', '.join(f'count(*) FILTER (WHERE {flag}) AS qtd_{name}' for name, flag in signals.items())},
                     {', '.join(f'{pct_true(flag)} AS pct_{name}' for name, flag in signals.items())}
              FROM t_payments) p,
             (SELECT count(*) FILTER (WHERE NOT possui_contrato) AS fornecedores_sem_contrato,
                     count(*) FILTER (WHERE situacao_cadastral = 'Irregular') AS fornecedores_irregulares,
                     count(*) FILTER (WHERE parte_relacionada) AS fornecedores_parte_relacionada
              FROM t_suppliers) v""",
    )
    add(
        "q9_layer_check",
        lambda c: quality.stack([stored_check(c, *check) for *check, _ in _KEYED]),
        _union(
            [f"""SELECT '{name}' AS tabela, count(*) AS linhas_silver, count(*) AS linhas_bronze,
                        count(*) FILTER (WHERE {' OR '.join(f'{k} IS NULL' for k in keys)}) AS chaves_nulas FROM {table}"""
             for name, _, _, _, keys, table in _KEYED]
        ),
    )
