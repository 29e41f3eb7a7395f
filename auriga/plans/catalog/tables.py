"""Silver tables (V), gold tables (P, F, M, A) and audit rules (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from auriga.operators import audit, audit_rules, finance, procurement, silver
from auriga.plans.oracle_tables import ratio, tot, tot_where


def register(add) -> None:
    add("v1_enriched_orders", lambda c: c.orders, "SELECT * FROM t_orders")
    add("v2_priced_lines", lambda c: c.lines, "SELECT * FROM t_lines")
    add("v3_timed_receipts", lambda c: c.receipts, "SELECT * FROM t_receipts")
    add("v4_cost_centers", lambda c: c.centers, "SELECT * FROM t_centers")
    add("v4_accounts", lambda c: c.accounts, "SELECT * FROM t_accounts")
    add("v5_budget", lambda c: c.budget, "SELECT * FROM t_budget")
    add("v5_actuals", lambda c: c.actuals, "SELECT * FROM t_actuals")
    add("v6_assets", lambda c: c.assets, "SELECT * FROM t_assets")
    add("v6_failures", lambda c: c.failures, "SELECT * FROM t_failures")
    add("v6_work_orders", lambda c: c.work_orders, "SELECT * FROM t_work")
    add("v7_readings", lambda c: c.readings, "SELECT * FROM t_readings")
    add("v8_flagged_payments", lambda c: c.payments, "SELECT * FROM t_payments")
    add("v9_enriched_findings", lambda c: c.findings, "SELECT * FROM t_findings")
    add(
        "v10_keep_first",
        lambda c: silver.keep_first(
            c.lines, ["id_pedido", "id_item"], ["valor_item", "saving_item", "descricao", "qtd"]
        ),
        """SELECT * FROM t_lines QUALIFY row_number() OVER (
             PARTITION BY id_pedido, id_item ORDER BY valor_item, saving_item, descricao, qtd) = 1""",
    )

    add("p1_category_spend", lambda c: procurement.category_spend(c.orders), "SELECT * FROM t_category_spend")
    add("p2_supplier_delivery", lambda c: c.delivery, "SELECT * FROM t_delivery")
    add("p3_category_saving", lambda c: procurement.category_saving(c.lines, c.orders), "SELECT * FROM t_saving")
    add(
        "p4_contract_coverage",
        lambda c: procurement.contract_coverage(c.orders),
        f"""SELECT centro, {tot_where('tem_contrato', 'valor_total')} AS gasto_em_contrato,
                   {tot_where('NOT tem_contrato', 'valor_total')} AS gasto_fora_contrato,
                   {tot('valor_total')} AS gasto_total,
                   {ratio('sum(valor_total) FILTER (WHERE tem_contrato)', 'sum(valor_total)')} AS pct_em_contrato,
                   {ratio('sum(valor_total) FILTER (WHERE NOT tem_contrato)', 'sum(valor_total)')} AS pct_fora_contrato
            FROM t_orders GROUP BY centro""",
    )
    add(
        "p5_sole_source_spend",
        lambda c: procurement.sole_source_spend(c.orders),
        f"""SELECT id_fornecedor, razao_social, uf, criticidade, count(*) AS qtd_pedidos,
                   {tot('valor_total')} AS gasto_total FROM t_orders WHERE fornecedor_unico GROUP BY ALL""",
    )

    add("f1_budget_vs_actual", lambda c: c.budget_base, "SELECT * FROM t_base")
    add("f2_budget_variance", lambda c: finance.budget_variance(c.budget_base), "SELECT * FROM t_variance")
    add(
        "f3_expense_by_group",
        lambda c: finance.expense_by_group(c.budget_base),
        f"""SELECT grupo, mes, {tot('valor_orcado')} AS orcado, {tot('valor_realizado')} AS realizado,
                   {ratio('sum(variancia)', 'sum(valor_orcado)')} AS variancia_pct
            FROM t_base WHERE tipo = 'Despesa' GROUP BY ALL""",
    )
    add("f4_monthly_revenue", lambda c: finance.monthly_revenue(c.budget_base), "SELECT * FROM t_revenue")
    add("f5_top_overruns", lambda c: finance.top_overruns(c.budget_base), "SELECT * FROM t_overruns")

    add("m1_daily_telemetry", lambda c: c.daily, "SELECT * FROM t_daily")
    add("m2_asset_health", lambda c: c.health, "SELECT * FROM t_health")
    add("m3_time_between_failures", lambda c: c.mtbf, "SELECT * FROM t_mtbf")
    add("m4_maintenance_cost", lambda c: c.cost, "SELECT * FROM t_cost")
    add("m5_assets_at_risk", lambda c: c.risk, "SELECT * FROM t_risk")

    add("a1_findings_by_rule", lambda c: audit.findings_by_rule(c.ruled_findings), "SELECT * FROM t_finding_rules")
    add(
        "a2_limit_violations",
        lambda c: audit.limit_violations(c.payments),
        """SELECT id_transacao, data_transacao, area, aprovador_nome, aprovador_cargo, alcada_limite, valor,
                  CAST(valor - alcada_limite AS DECIMAL(18,2)) AS valor_excedente, razao_social AS fornecedor, status
           FROM t_payments WHERE valor > alcada_limite""",
    )
    add("a3_uncontracted_spend", lambda c: audit.uncontracted_spend(c.payments), "SELECT * FROM t_uncontracted")
    add("a4_compliance_summary", lambda c: c.compliance, "SELECT * FROM t_compliance")

    flags = [
        "acima_alcada", "sem_contrato_relevante", "sod_violado", "fornecedor_irregular", "parte_relacionada",
        "dia_nao_util", "sem_categoria",
    ]
    add(
        "x1_payment_flags",
        lambda c: c.payments.select("id_transacao", *flags),
        f"SELECT id_transacao, {', '.join(flags)} FROM t_payments",
    )
    finding = "id_transacao, id_regra, data_deteccao, valor_em_risco, descricao"
    for key, rule in [
        ("x2_limit_exceeded", "R001"), ("x3_no_contract", "R002"), ("x4_duties_not_separated", "R003"),
        ("x5_weekend_payment", "R004"), ("x6_irregular_vendor", "R005"), ("x9a_blank_category", "R008"),
        ("x9b_gift_above_limit", "R009"), ("x9c_related_party", "R010"),
    ]:
        add(
            key,
            lambda c, rule=rule: audit_rules.payment_findings(c.payments, [rule]),
            f"SELECT {finding} FROM t_single WHERE id_regra = '{rule}'",
        )
    add("x7_split_clusters", lambda c: audit_rules.split_clusters(c.payments), "SELECT * FROM t_clusters")
    add("x7_split_payments", lambda c: audit_rules.split_findings(c.stored_payments), "SELECT * FROM t_split")
    add("x8_duplicate_payments", lambda c: audit_rules.duplicate_findings(c.stored_payments), "SELECT * FROM t_repeats")
    add(
        "x10_findings",
        lambda c: c.raised,
        f"SELECT {finding}, id_achado, status_achado FROM t_raised",
    )
    add(
        "x11_findings_with_rule",
        lambda c: c.raised.select("id_achado", "id_regra").join(
            F.broadcast(c.rules.select("id_regra", "nome", "severidade", "politica_referencia")), "id_regra", "left"
        ),
        """SELECT id_achado, id_regra, regra_nome AS nome, severidade, politica_referencia
           FROM t_raised LEFT JOIN t_rules USING (id_regra)""",
    )
    add(
        "x12_flag_reconciliation",
        lambda c: audit.reconcile_flags(c.stored_payments, c.raised),
        """SELECT coalesce(d.id_transacao, s.id_transacao) AS id_transacao, coalesce(d.id_regra, s.id_regra) AS id_regra,
                  CASE WHEN s.id_transacao IS NULL THEN 'sem achado' WHEN d.id_transacao IS NULL THEN 'sem sinal'
                       ELSE 'conforme' END AS situacao
           FROM (UNPIVOT (SELECT id_transacao, acima_alcada AS R001, sem_contrato_relevante AS R002,
                                 sod_violado AS R003, dia_nao_util AS R004, fornecedor_irregular AS R005,
                                 sem_categoria AS R008, parte_relacionada AS R010 FROM t_payments)
                 ON R001, R002, R003, R004, R005, R008, R010 INTO NAME id_regra VALUE aceso) d
           FULL JOIN (SELECT DISTINCT id_transacao, id_regra FROM t_raised
                      WHERE id_regra IN ('R001', 'R002', 'R003', 'R004', 'R005', 'R008', 'R010')) s
             ON s.id_transacao = d.id_transacao AND s.id_regra = d.id_regra AND d.aceso
           WHERE d.aceso OR s.id_transacao IS NOT NULL""",
    )
