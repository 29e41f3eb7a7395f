"""Metric view, forecasts, summaries, KPI sets, questions (B) and lookups (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from auriga.functions import lookups
from auriga.operators import audit, finance, metrics, procurement, silver
from auriga.operators.forecast import forecast
from auriga.plans import kpis, questions
from auriga.plans.oracle_tables import brl, month, pct_true, ratio, rnd, tot, tot_where

HORIZON = "2001-07-31"


def forecast_sql(source: str, value: str, keys: str = "") -> str:
    """The forecast definition over `source`, a table with mes, `value` and the series keys."""
    by = f"{keys}, " if keys else ""
    over = f"PARTITION BY {keys}" if keys else ""
    using = f"USING ({keys})" if keys else "ON true"
    season_using = f"USING ({keys}, estacao)" if keys else "USING (estacao)"
    return f"""
    WITH m AS (SELECT {by}mes, (year(mes) - 1970) * 12 + month(mes) AS t, month(mes) AS estacao,
                      CAST(sum({value}) AS DOUBLE) AS y
               FROM {source} WHERE {value} IS NOT NULL GROUP BY ALL),
    fit AS (SELECT *, regr_slope(y, t) OVER ({over}) AS b, regr_intercept(y, t) OVER ({over}) AS a FROM m),
    res AS (SELECT *, y - (a + b * t) AS r FROM fit),
    sea AS (SELECT {by}estacao, avg(r) AS s FROM res GROUP BY ALL),
    sig AS (SELECT {by}max(mes) AS ultimo, any_value(a) AS a, any_value(b) AS b, stddev_samp(r - s) AS sigma
            FROM res JOIN sea {season_using} {'GROUP BY ' + keys if keys else ''}),
    fut AS (SELECT *, month(mes) AS estacao, (year(mes) - 1970) * 12 + month(mes) AS t
            FROM (SELECT *, CAST(unnest(generate_series(ultimo + INTERVAL 1 MONTH, TIMESTAMP '{HORIZON}',
                                                        INTERVAL 1 MONTH)) AS DATE) AS mes FROM sig)),
    val AS (SELECT {by}mes, a + b * t + coalesce(s, 0) AS c, sigma FROM fut LEFT JOIN sea {season_using})
    SELECT {by}mes, {rnd('c', 2)} AS {value}_forecast, {rnd('c + 1.96 * sigma', 2)} AS {value}_upper,
           {rnd('c - 1.96 * sigma', 2)} AS {value}_lower FROM val"""


_SUMS = f"""{tot_where("tipo = 'Receita'", 'valor_realizado')} AS receita,
            {tot_where("tipo = 'Despesa'", 'valor_realizado')} AS despesa,
            CAST({tot_where("tipo = 'Receita'", 'valor_realizado')}
                 - {tot_where("tipo = 'Despesa'", 'valor_realizado')} AS DECIMAL(28,2)) AS resultado,
            {tot_where("tipo = 'Despesa'", 'variancia')} AS variancia_despesa"""

_CARDS = """SELECT s.*, l.*, r.* FROM ({spend}) s, ({saving}) l, ({receipts}) r"""


def _cards(orders: str, lines: str, receipts: str) -> str:
    return _CARDS.format(
        spend=f"""SELECT {tot('valor_total')} AS gasto_total,
                         {tot_where('NOT tem_contrato', 'valor_total')} AS gasto_fora_contrato,
                         {ratio('sum(valor_total) FILTER (WHERE NOT tem_contrato)', 'sum(valor_total)')}
                           AS pct_fora_contrato FROM {orders}""",
        saving=f"""SELECT {tot('saving_item')} AS saving_total,
                          {ratio('sum(saving_item)', 'sum(preco_baseline * qtd)')} AS saving_pct FROM {lines}""",
        receipts=f"""SELECT count(*) AS pedidos_recebidos, count(*) FILTER (WHERE dias_atraso > 0) AS pedidos_atrasados,
                            {pct_true('otif')} AS otif_pct FROM {receipts} WHERE data_recebida IS NOT NULL""",
    )


EXTRA = {
    "t_newest_orders": f"""SELECT * FROM t_orders
        WHERE {month('data_pedido')} = (SELECT {month('max(data_pedido)')} FROM t_orders)""",
    "t_newest_lines": "SELECT * FROM t_lines WHERE id_pedido IN (SELECT id_pedido FROM t_newest_orders)",
    "t_newest_receipts": "SELECT * FROM t_receipts WHERE id_pedido IN (SELECT id_pedido FROM t_newest_orders)",
    "t_cards": _cards("t_orders", "t_lines", "t_receipts"),
    "t_month_cards": f"""SELECT c.*, (SELECT {month('max(data_pedido)')} FROM t_orders) AS mes
        FROM ({_cards('t_newest_orders', 't_newest_lines', 't_newest_receipts')}) c""",
    "t_last_closed": f"""
    SELECT mes, {_SUMS} FROM t_base
    WHERE mes = (SELECT max(mes) FROM t_base WHERE valor_realizado IS NOT NULL) GROUP BY mes""",
    "t_worst_pair": """
    SELECT mes, conta_nome, centro_nome, variancia FROM t_base
    WHERE mes = (SELECT mes FROM t_last_closed) AND tipo = 'Despesa' AND variancia > 0
    ORDER BY variancia DESC, id_conta, id_centro LIMIT 1""",
    "t_summary": """
    SELECT s.*, conta_nome AS maior_estouro_conta, centro_nome AS maior_estouro_centro, variancia AS maior_estouro
    FROM t_last_closed s LEFT JOIN t_worst_pair USING (mes)""",
    "t_types": f"""
    SELECT tipo, mes, {tot('valor_orcado')} AS orcado, {tot('valor_realizado')} AS realizado
    FROM t_base WHERE tipo IN ('Receita', 'Despesa') GROUP BY ALL""",
    "t_type_forecast": forecast_sql("t_types", "realizado", "tipo"),
    "t_revenue_forecast": forecast_sql("t_revenue", "receita_realizada"),
    "t_pair_forecast": forecast_sql("t_base", "valor_realizado", "id_conta, id_centro"),
    "t_late": f"""SELECT id_pedido, razao_social, categoria_nome, valor_total, data_prometida, dias_atraso,
        {month('data_pedido')} AS mes FROM t_orders JOIN t_receipts USING (id_pedido) WHERE dias_atraso > 0""",
    "t_newest_compliance": "SELECT * FROM t_compliance WHERE mes = (SELECT max(mes) FROM t_compliance)",
}

CONFORMITY = ratio("(sum(qtd_transacoes) - sum(qtd_transacoes_com_achado))", "sum(qtd_transacoes)")


def register(add_query) -> None:
    def add(name, build, sql=None):
        add_query(name, build, sql, **EXTRA)

    add(
        "b1_metric_by_type_and_month",
        lambda c: metrics.budget_metrics(c.budget_base)
        .query(["Realizado", "Variância %"], by=["Tipo", "Mês"])
        .select(
            F.col("Tipo").alias("tipo"), F.col("Mês").alias("mes"), F.col("Realizado").alias("realizado"),
            F.col("Variância %").alias("variancia_pct"),
        ),
        f"""SELECT tipo, mes, {tot('valor_realizado')} AS realizado,
                   100 * CAST(sum(valor_realizado) - sum(valor_orcado) AS DOUBLE) / CAST(sum(valor_orcado) AS DOUBLE)
                     AS variancia_pct FROM t_base GROUP BY ALL""",
    )
    add(
        "b1_metric_all_dimensions",
        lambda c: metrics.budget_metrics(c.budget_base).query(
            ["Orçado", "Realizado", "Variância"], by=["Mês", "Tipo", "Grupo", "Área", "Centro", "Conta"]
        ),
        f"""SELECT mes AS "Mês", tipo AS "Tipo", grupo AS "Grupo", area AS "Área", centro_nome AS "Centro",
                   conta_nome AS "Conta", {tot('valor_orcado')} AS "Orçado", {tot('valor_realizado')} AS "Realizado",
                   CAST(sum(valor_realizado) - sum(valor_orcado) AS DECIMAL(28,2)) AS "Variância"
            FROM t_base GROUP BY ALL""",
    )
    add(
        "b3_revenue_forecast",
        lambda c: forecast(finance.monthly_revenue(c.budget_base), HORIZON, "mes", "receita_realizada"),
        "SELECT * FROM t_revenue_forecast",
    )
    add(
        "b3_forecast_per_account_and_center",
        lambda c: forecast(c.budget_base, HORIZON, "mes", "valor_realizado", ["id_conta", "id_centro"]),
        "SELECT * FROM t_pair_forecast",
    )
    add(
        "b4_forecast_against_budget",
        lambda c: kpis.forecast_against_budget(c.stored_base, HORIZON),
        f"""SELECT tipo, mes, orcado, realizado_forecast, {rnd('realizado_forecast - CAST(orcado AS DOUBLE)', 2)} AS diferenca,
                   {ratio('(realizado_forecast - CAST(orcado AS DOUBLE))', 'orcado')} AS diferenca_pct,
                   realizado_forecast >= CAST(orcado AS DOUBLE) AS atinge_orcado
            FROM t_type_forecast JOIN t_types USING (tipo, mes)""",
    )
    add("b5_closed_month_summary", lambda c: kpis.closed_month_summary(c.budget_base), "SELECT * FROM t_summary")

    def reais(e: str) -> str:
        return f"'R$ ' || coalesce({brl(e)}, 'n/d')"

    def percent(e: str) -> str:
        return f"coalesce(translate(format('{{:,.1f}}', {e}), ',.', '.,'), 'n/d') || '%'"

    add(
        "b6_closed_month_sentence",
        lambda c: kpis.finance_sentence(kpis.closed_month_summary(c.budget_base)),
        f"""SELECT mes, 'Em ' || strftime(mes, '%Y-%m') || ', a receita realizada foi de ' || {reais('receita')}
              || ' e a despesa de ' || {reais('despesa')} || ', com resultado de ' || {reais('resultado')}
              || '. A despesa variou ' || {reais('variancia_despesa')} || ' contra o orçado; o maior estouro foi '
              || coalesce(maior_estouro_conta, 'n/d') || ' em ' || coalesce(maior_estouro_centro, 'n/d') || ' ('
              || {reais('maior_estouro')} || ').' AS resumo FROM t_summary""",
    )
    add(
        "b7_procurement_month",
        lambda c: kpis.procurement_month(c.stored_orders, c.lines, c.receipts),
        "SELECT * FROM t_month_cards",
    )
    add(
        "b7_procurement_month_sentence",
        lambda c: kpis.procurement_sentence(kpis.procurement_month(c.stored_orders, c.lines, c.receipts)),
        f"""SELECT mes, 'Em ' || strftime(mes, '%Y-%m') || ', o gasto foi de ' || {reais('gasto_total')}
              || ', com economia de ' || {percent('saving_pct')} || ' e OTIF de ' || {percent('otif_pct')} || '; '
              || pedidos_atrasados || ' pedidos recebidos com atraso.' AS resumo FROM t_month_cards""",
    )
    add(
        "b7_categories_of_month",
        lambda c: kpis.top_categories_of_month(c.stored_orders),
        f"""SELECT categoria_nome, {tot('valor_total')} AS gasto, count(*) AS qtd_pedidos
            FROM t_newest_orders GROUP BY ALL""",
    )
    add(
        "b7_worst_delays_of_month",
        lambda c: kpis.worst_delays(c.stored_orders, c.receipts),
        """SELECT * FROM t_late WHERE mes = (SELECT max(CAST(date_trunc('month', data_pedido) AS DATE)) FROM t_orders)
           ORDER BY dias_atraso DESC, id_pedido LIMIT 5""",
    )
    add(
        "b8_procurement_cards",
        lambda c: kpis.procurement_cards(c.orders, c.lines, c.receipts),
        "SELECT * FROM t_cards",
    )
    for key, column in [("category", "categoria_nome"), ("site", "centro"), ("month", "mes")]:
        add(
            f"b8_spend_by_{key}",
            lambda c, column=column: kpis.spend_by(c.orders, column),
            f"""SELECT {month('data_pedido') + ' AS mes' if column == 'mes' else column}, {tot('valor_total')} AS gasto,
                       count(*) AS qtd_pedidos FROM t_orders GROUP BY 1""",
        )
    add(
        "b8_top_suppliers",
        lambda c: kpis.top_suppliers(c.stored_orders, c.receipts),
        f"""SELECT t.*, lead_time_medio_dias, otif_pct
            FROM (SELECT id_fornecedor, razao_social, {tot('valor_total')} AS gasto_total, count(*) AS qtd_pedidos
                  FROM t_orders GROUP BY ALL ORDER BY gasto_total DESC, id_fornecedor LIMIT 10) t
            LEFT JOIN t_delivery d ON d.id_fornecedor = t.id_fornecedor""",
    )
    add(
        "b8_overdue_orders",
        lambda c: kpis.overdue_orders(c.stored_orders, c.receipts),
        """SELECT id_pedido, data_prometida,
                  CAST((SELECT max(data_pedido) FROM t_orders) - data_prometida AS BIGINT) AS dias_vencidos,
                  razao_social, categoria_nome, centro, status, valor_total
           FROM t_receipts JOIN t_orders USING (id_pedido)
           WHERE data_recebida IS NULL AND status <> 'Cancelado'
             AND data_prometida < (SELECT max(data_pedido) FROM t_orders)""",
    )
    add(
        "b8_sole_source_list",
        lambda c: procurement.sole_source_spend(c.orders).orderBy(F.col("gasto_total").desc(), "id_fornecedor"),
        f"""SELECT id_fornecedor, razao_social, uf, criticidade, count(*) AS qtd_pedidos,
                   {tot('valor_total')} AS gasto_total FROM t_orders WHERE fornecedor_unico GROUP BY ALL""",
    )
    add(
        "b9_finance_cards",
        lambda c: kpis.finance_cards(c.budget_base),
        f"""SELECT {_SUMS}, {ratio("sum(variancia) FILTER (WHERE tipo = 'Despesa')",
                                   "sum(valor_orcado) FILTER (WHERE tipo = 'Despesa')")} AS variancia_despesa_pct
            FROM t_base WHERE valor_realizado IS NOT NULL""",
    )
    add(
        "b9_revenue_with_forecast",
        lambda c: kpis.revenue_with_forecast(finance.monthly_revenue(c.stored_base), HORIZON),
        """SELECT mes, 'historico' AS serie, CAST(receita_realizada AS DOUBLE) AS valor, CAST(NULL AS DOUBLE) AS superior,
                  CAST(NULL AS DOUBLE) AS inferior FROM t_revenue WHERE receita_realizada IS NOT NULL
           UNION ALL SELECT mes, 'projecao', receita_realizada_forecast, receita_realizada_upper,
                            receita_realizada_lower FROM t_revenue_forecast""",
    )
    add("b9_budget_and_actual_by_month", lambda c: kpis.type_series(c.budget_base), "SELECT * FROM t_types")
    add(
        "b9_overrun_ranking",
        lambda c: finance.top_overruns(c.budget_base).orderBy("posicao", "id_conta", "id_centro").limit(10),
        "SELECT * FROM t_overruns ORDER BY posicao, id_conta, id_centro LIMIT 10",
    )
    center_sql = f"""SELECT id_centro, centro_nome, {tot('valor_orcado')} AS orcado_total,
                   {tot('valor_realizado')} AS realizado_total, {tot('variancia')} AS variancia,
                   {ratio('sum(variancia)', 'sum(valor_orcado)')} AS variancia_pct
            FROM t_base WHERE tipo = 'Despesa' AND valor_realizado IS NOT NULL"""
    add("b9_variance_by_center", lambda c: kpis.variance_by_center(c.budget_base), f"{center_sql} GROUP BY ALL")

    add(
        "b10_maintenance_cards",
        lambda c: kpis.maintenance_cards(c.health, c.mtbf, c.work_orders),
        f"""SELECT h.*, m.*, w.*
            FROM (SELECT count(*) FILTER (WHERE categoria_risco = 'Crítico') AS ativos_criticos,
                         count(*) FILTER (WHERE categoria_risco = 'Atenção') AS ativos_atencao FROM t_health) h,
                 (SELECT {rnd('avg(mtbf_dias)', 1)} AS mtbf_medio_dias FROM t_mtbf) m,
                 (SELECT {tot('custo')} AS custo_total, {rnd('sum(downtime_horas)', 1)} AS downtime_total_horas
                  FROM t_work) w""",
    )
    add(
        "b10_assets_by_label",
        lambda c: kpis.assets_by_label(c.health),
        "SELECT categoria_risco, count(*) AS ativos FROM t_health GROUP BY 1",
    )
    add(
        "b10_cost_by_asset_type",
        lambda c: kpis.cost_by_asset_type(c.cost),
        """SELECT tipo_ativo, CAST(sum(custo_total) FILTER (WHERE tipo_ordem = 'Corretiva') AS DECIMAL(28,2)) AS corretiva,
                  CAST(sum(custo_total) FILTER (WHERE tipo_ordem = 'Preventiva') AS DECIMAL(28,2)) AS preventiva
           FROM t_cost GROUP BY 1""",
    )
    add(
        "b10_risky_vibration",
        lambda c: kpis.risky_vibration(c.daily, c.health),
        """SELECT id_ativo, tag, dia, vib_media, vib_max FROM t_daily
           WHERE id_ativo IN (SELECT id_ativo FROM t_health WHERE categoria_risco <> 'Saudável')""",
    )
    add(
        "b11_audit_cards",
        lambda c: kpis.audit_cards(
            silver.ruled_findings(c.stored_raised, c.rules), c.stored_compliance
        ),
        f"""SELECT f.*, l.* FROM (
              SELECT count(*) AS total_achados,
                     count(*) FILTER (WHERE severidade = 'Alta' AND status_achado IN ('Aberto', 'Em análise'))
                       AS alta_em_aberto, {tot('valor_em_risco')} AS valor_em_risco FROM t_findings) f,
              (SELECT max(mes) AS mes, {CONFORMITY} AS pct_conformidade FROM t_newest_compliance) l""",
    )
    add(
        "b11_monthly_compliance",
        lambda c: kpis.monthly_compliance(c.compliance),
        f"""SELECT mes, CAST(sum(qtd_achados) AS BIGINT) AS qtd_achados, {tot('valor_em_risco')} AS valor_em_risco,
                   {CONFORMITY} AS pct_conformidade FROM t_compliance GROUP BY mes""",
    )
    add(
        "b11_uncontracted_by_area",
        lambda c: kpis.uncontracted_by_area(audit.uncontracted_spend(c.payments)),
        f"""SELECT area, CAST(sum(qtd_transacoes) AS BIGINT) AS qtd_transacoes, {tot('valor_total')} AS valor_total,
                   {tot('valor_acima_limite')} AS valor_acima_limite FROM t_uncontracted GROUP BY 1""",
    )
    add(
        "b11_uncontracted_ranking",
        lambda c: kpis.uncontracted_ranking(audit.uncontracted_spend(c.payments)),
        f"""SELECT id_fornecedor, razao_social, CAST(sum(qtd_transacoes) AS BIGINT) AS qtd_transacoes,
                   {tot('valor_total')} AS valor_total
            FROM t_uncontracted GROUP BY ALL ORDER BY valor_total DESC, id_fornecedor LIMIT 10""",
    )

    add(
        "b12_spend_last_six_months",
        lambda c: questions.spend_in_last_months(c.stored_orders),
        f"""SELECT categoria_nome, centro, {tot('valor_total')} AS gasto, count(*) AS qtd_pedidos FROM t_orders
            WHERE {month('data_pedido')} >= (SELECT {month('max(data_pedido)')} FROM t_orders) - INTERVAL 5 MONTH
            GROUP BY ALL""",
    )
    add(
        "b12_spend_of_category_and_site",
        lambda c: questions.spend_in_last_months(c.stored_orders, 6, "URGENT", "AFRICA"),
        f"""SELECT categoria_nome, centro, {tot('valor_total')} AS gasto, count(*) AS qtd_pedidos FROM t_orders
            WHERE {month('data_pedido')} >= (SELECT {month('max(data_pedido)')} FROM t_orders) - INTERVAL 5 MONTH
              AND categoria_nome = 'URGENT' AND centro = 'AFRICA' GROUP BY ALL""",
    )
    add(
        "b12_suppliers_below_otif",
        lambda c: questions.suppliers_below_otif(c.delivery),
        "SELECT id_fornecedor, razao_social, otif_pct, qtd_pedidos_recebidos FROM t_delivery WHERE otif_pct < 80",
    )
    add(
        "b12_saving_by_category",
        lambda c: questions.saving_by_category(c.lines, c.orders),
        f"""SELECT categoria_nome, {tot('saving_item')} AS saving_total,
                   {ratio('sum(saving_item)', 'sum(preco_baseline * qtd)')} AS saving_pct
            FROM t_lines JOIN t_orders USING (id_pedido) GROUP BY 1""",
    )
    add(
        "b12_spend_outside_contracts",
        lambda c: questions.spend_outside_contracts(c.orders),
        f"""SELECT centro, {tot_where('NOT tem_contrato', 'valor_total')} AS gasto_fora_contrato,
                   {ratio('sum(valor_total) FILTER (WHERE NOT tem_contrato)', 'sum(valor_total)')} AS pct_fora_contrato
            FROM t_orders GROUP BY 1""",
    )
    add(
        "b13_worst_account_per_center",
        lambda c: questions.worst_account_per_center(finance.budget_variance(c.budget_base)),
        """SELECT id_centro, centro_nome, conta_nome, variancia, variancia_pct FROM t_variance
           WHERE tipo = 'Despesa' AND variancia > 0
           QUALIFY row_number() OVER (PARTITION BY id_centro ORDER BY variancia DESC, id_conta) = 1""",
    )
    add(
        "b13_variance_by_center_of_year",
        lambda c: kpis.variance_by_center(questions.base_of_year(c.stored_base)),
        f"""{center_sql} AND year(mes) = (SELECT year(max(mes)) FROM t_base WHERE valor_realizado IS NOT NULL)
            GROUP BY ALL""",
    )
    add(
        "b13_actual_against_budget",
        lambda c: questions.actual_against_budget_by_month(finance.monthly_revenue(c.budget_base)),
        """SELECT mes, receita_orcada, receita_realizada, variancia_pct FROM t_revenue
           WHERE receita_realizada IS NOT NULL""",
    )
    add(
        "b13_result_of_last_month",
        lambda c: kpis.closed_month_summary(c.budget_base).select("mes", "resultado"),
        "SELECT mes, resultado FROM t_summary",
    )
    add(
        "b14_critical_assets",
        lambda c: questions.critical_assets(c.health),
        """SELECT id_ativo, tag, tipo, site, score_risco, vibracao_recente FROM t_health
           WHERE categoria_risco = 'Crítico'""",
    )
    add(
        "b14_mtbf_by_type",
        lambda c: questions.mtbf_by_type(c.mtbf),
        f"""SELECT tipo_ativo, {rnd('avg(mtbf_dias)', 1)} AS mtbf_medio_dias,
                   CAST(sum(n_falhas) AS BIGINT) AS n_falhas FROM t_mtbf GROUP BY 1""",
    )
    add(
        "b14_corrective_cost_by_site",
        lambda c: questions.corrective_cost_by_site(c.cost),
        f"""SELECT site, {tot('custo_total')} AS custo_corretivo, CAST(sum(n_ordens) AS BIGINT) AS n_ordens
            FROM t_cost WHERE tipo_ordem = 'Corretiva' GROUP BY 1""",
    )
    add(
        "b14_rising_vibration",
        lambda c: questions.rising_vibration(c.stored_daily),
        f"""SELECT * FROM (
              SELECT id_ativo, tag, {rnd("regr_slope(vib_media, dia - DATE '1970-01-01')", 4)} AS inclinacao,
                     count(*) AS dias
              FROM t_daily WHERE dia > (SELECT max(dia) FROM t_daily) - 7 GROUP BY ALL) WHERE inclinacao > 0""",
    )
    add(
        "b15_open_high_severity",
        lambda c: questions.open_high_severity(c.ruled_findings),
        f"""SELECT count(*) AS alta_em_aberto, {tot('valor_em_risco')} AS valor_em_risco FROM t_findings
            WHERE severidade = 'Alta' AND status_achado IN ('Aberto', 'Em análise')""",
    )
    add(
        "b15_risk_by_rule",
        lambda c: questions.risk_by_rule(audit.findings_by_rule(c.ruled_findings)),
        "SELECT id_regra, regra_nome, severidade, valor_em_risco FROM t_finding_rules",
    )
    add(
        "b15_violations_of_last_quarter",
        lambda c: questions.violations_of_last_quarter(
            audit.limit_violations(c.stored_payments), c.stored_payments
        ),
        """SELECT id_transacao, data_transacao, area, aprovador_nome, aprovador_cargo, alcada_limite, valor,
                  CAST(valor - alcada_limite AS DECIMAL(18,2)) AS valor_excedente, razao_social AS fornecedor, status
           FROM t_payments WHERE acima_alcada
             AND data_transacao >= (SELECT date_trunc('quarter', max(data_transacao)) FROM t_payments)""",
    )
    add(
        "b15_conformity_by_area",
        lambda c: questions.conformity_by_area(c.stored_compliance),
        "SELECT area, mes, qtd_transacoes, pct_conformidade FROM t_newest_compliance",
    )

    add(
        "u1_supplier_otif",
        lambda c: lookups.supplier_otif(c.lake.suppliers().select("razao_social").distinct(), c.delivery),
        "SELECT razao_social, id_fornecedor, otif_pct FROM t_delivery",
    )
    add(
        "u2_account_variance",
        lambda c: lookups.account_variance(
            c.accounts.select("conta_nome"), finance.budget_variance(c.budget_base)
        ),
        f"""SELECT conta_nome, {tot('orcado_total')} AS orcado, {tot('realizado_total')} AS realizado,
                   {tot('variancia')} AS variancia, {ratio('sum(variancia)', 'sum(orcado_total)')} AS variancia_pct
            FROM t_variance GROUP BY 1""",
    )
    add(
        "u3_asset_status",
        lambda c: lookups.asset_status(
            c.assets.select(F.explode(F.array(F.col("id_ativo").cast("string"), "tag")).alias("ativo")), c.health
        ),
        """SELECT unnest([CAST(id_ativo AS VARCHAR), tag]) AS ativo, id_ativo, score_risco, categoria_risco,
                  vibracao_recente FROM t_health""",
    )
    add(
        "u4_vendor_findings",
        lambda c: lookups.vendor_findings(c.lake.suppliers().select("razao_social").distinct(), c.findings),
        f"""SELECT razao_social, count(*) AS qtd_achados, {tot('valor_em_risco')} AS valor_em_risco
            FROM t_findings WHERE razao_social IS NOT NULL GROUP BY 1""",
    )
