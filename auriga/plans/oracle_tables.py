"""DuckDB definitions of the case tables, used to check the Spark results.

`compose(body)` prepends the definitions a query mentions, in dependency order.
`pct(x, d)` style rounding is written with `rnd`, the same half-up rule as
`auriga.functions.columns.settle`.
"""

from __future__ import annotations

import re

from auriga.operators.audit_rules import RULES
from auriga.sources.lake import ACTUALS_END


def rnd(expr: str, digits: int) -> str:
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def ratio(part: str, whole: str, digits: int = 1) -> str:
    return rnd(f"100 * CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)", digits)


def pct_true(flag: str, digits: int = 1) -> str:
    return rnd(f"100 * avg(CASE WHEN {flag} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", digits)


def tot(expr: str) -> str:
    return f"CAST(sum({expr}) AS DECIMAL(28,2))"


def tot_where(cond: str, expr: str) -> str:
    return f"CAST(coalesce(sum({expr}) FILTER (WHERE {cond}), 0) AS DECIMAL(28,2))"


def brl(expr: str) -> str:
    return f"translate(format('{{:,.2f}}', CAST({expr} AS DOUBLE)), ',.', '.,')"


def month(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


_RULE_ROWS = ",\n    ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in RULES)

_CONTRACT = "CASE WHEN o_orderkey % 10 < 7 THEN 'CT' || (o_orderkey % 30) ELSE ' ' END"


def _pick(values: list[str], index: str) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{items}])[CAST({index} % {len(values)} AS INT) + 1]"


def _ledger(end: str = "") -> str:
    known = f"WHERE o_orderdate < TIMESTAMP '{end}'" if end else ""
    return f"""
    SELECT c_nationkey AS id_centro, c_mktsegment AS id_conta, {month('o_orderdate')} AS mes,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS v
    FROM orders JOIN customer ON c_custkey = o_custkey
    {known} GROUP BY ALL"""


TABLES: dict[str, str] = {
    "t_places": "SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey",
    "t_suppliers": f"""
    SELECT s_suppkey AS id_fornecedor, s_name AS razao_social, n_name AS uf,
           {_pick(['Alta', 'Média', 'Baixa'], 's_suppkey')} AS criticidade,
           s_suppkey % 10 = 0 AS fornecedor_unico, s_suppkey % 10 >= 3 AS possui_contrato,
           if(s_suppkey % 10 = 5, 'Irregular', 'Regular') AS situacao_cadastral,
           s_suppkey % 10 = 7 AS parte_relacionada
    FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "t_categories": """
    SELECT DISTINCT o_orderpriority AS id_categoria, substr(o_orderpriority, 3) AS categoria_nome,
           CASE left(o_orderpriority, 1) WHEN '1' THEN 'CAPEX' WHEN '5' THEN 'Serviço' ELSE 'MRO' END AS categoria_tipo
    FROM orders""",
    "t_raw_orders": f"""
    SELECT o_orderkey AS id_pedido, o_custkey % (SELECT count(*) FROM supplier) AS id_fornecedor,
           o_orderpriority AS id_categoria, CAST(o_orderdate AS DATE) AS data_pedido, r_name AS centro,
           CAST(o_totalprice AS DECIMAL(18,2)) AS valor_total,
           CASE o_orderstatus WHEN 'F' THEN 'Recebido' WHEN 'P' THEN 'Aprovado' ELSE 'Aberto' END AS status,
           {_CONTRACT} AS contrato_cru
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN t_places ON n_nationkey = c_nationkey""",
    "t_orders": """
    SELECT o.* EXCLUDE (contrato_cru), nullif(trim(contrato_cru), '') AS contrato_id,
           razao_social, criticidade, fornecedor_unico, uf, categoria_nome, categoria_tipo,
           length(trim(contrato_cru)) > 0 AS tem_contrato
    FROM t_raw_orders o LEFT JOIN t_suppliers USING (id_fornecedor) LEFT JOIN t_categories USING (id_categoria)""",
    "t_lines": """
    SELECT *, CAST(preco_unitario * qtd AS DECIMAL(18,2)) AS valor_item,
           CAST((preco_baseline - preco_unitario) * qtd AS DECIMAL(18,2)) AS saving_item
    FROM (SELECT l_orderkey AS id_pedido, l_linenumber AS id_item, 'Item ' || l_partkey AS descricao,
                 CAST(l_quantity AS DECIMAL(18,2)) AS qtd,
                 CAST(floor(l_extendedprice / l_quantity * 100) / 100 AS DECIMAL(18,2)) AS preco_unitario,
                 CAST(floor(l_extendedprice / l_quantity * (0.95::DOUBLE + l_discount) * 100) / 100
                      AS DECIMAL(18,2)) AS preco_baseline
          FROM lineitem)""",
    "t_receipts": """
    SELECT *, dias_atraso <= 0 AS no_prazo, (dias_atraso <= 0) AND ok_qualidade AS otif
    FROM (SELECT *, CAST(data_recebida - data_prometida AS BIGINT) AS dias_atraso
          FROM (SELECT o_orderkey AS id_pedido, p AS data_prometida,
                       CASE WHEN o_orderstatus = 'F' THEN p + CAST((o_orderkey * 7) % 38 - 26 AS INT) END
                         AS data_recebida,
                       CAST(o_custkey % 50 + 1 AS DECIMAL(18,2)) AS qtd_recebida, o_orderkey % 10 <> 0 AS ok_qualidade
                FROM (SELECT *, CAST(o_orderdate AS DATE) + CAST(30 + o_custkey % 50 AS INT) AS p FROM orders)))""",
    "t_category_spend": f"""
    SELECT categoria_nome, categoria_tipo, centro, {month('data_pedido')} AS mes,
           {tot('valor_total')} AS gasto, count(*) AS qtd_pedidos FROM t_orders GROUP BY ALL""",
    "t_delivery": f"""
    SELECT id_fornecedor, razao_social, criticidade, count(*) AS qtd_pedidos_recebidos,
           {rnd('avg(CAST(data_recebida - data_pedido AS BIGINT))', 1)} AS lead_time_medio_dias,
           {pct_true('no_prazo')} AS pct_no_prazo, {pct_true('otif')} AS otif_pct
    FROM t_receipts JOIN t_orders USING (id_pedido) WHERE data_recebida IS NOT NULL GROUP BY ALL""",
    "t_saving": f"""
    SELECT categoria_nome, categoria_tipo, {month('data_pedido')} AS mes, {tot('saving_item')} AS saving_total,
           {tot('preco_baseline * qtd')} AS baseline_total,
           {ratio('sum(saving_item)', 'sum(preco_baseline * qtd)')} AS saving_pct
    FROM t_lines JOIN t_orders USING (id_pedido) GROUP BY ALL""",
    "t_centers": """
    SELECT n_nationkey AS id_centro, n_name AS centro_nome, r_name AS area, 'Resp ' || n_nationkey AS responsavel,
           r_name AS regiao FROM t_places""",
    "t_accounts": """
    SELECT DISTINCT c_mktsegment AS id_conta, 'Conta ' || c_mktsegment AS conta_nome,
           CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Receita'
                WHEN c_mktsegment = 'BUILDING' THEN 'CAPEX' ELSE 'Despesa' END AS tipo,
           c_mktsegment AS grupo FROM customer""",
    "t_raw_budget": f"""
    SELECT id_centro || '-' || id_conta || '-' || strftime(mes, '%Y%m') AS id_orcamento, id_centro, id_conta, mes,
           CAST(round(CAST(v AS DOUBLE) * (90 + (id_centro % 5) * 5) / 10000) * 100 AS DECIMAL(18,2)) AS valor_orcado
    FROM ({_ledger()})""",
    "t_raw_actuals": f"""
    SELECT id_centro || '-' || id_conta || '-' || strftime(mes, '%Y%m') AS id_lancamento, id_centro, id_conta, mes,
           v AS valor_realizado
    FROM ({_ledger(ACTUALS_END)})""",
    "t_budget": """
    SELECT b.*, centro_nome, area, regiao, conta_nome, tipo, grupo
    FROM t_raw_budget b LEFT JOIN t_centers USING (id_centro) LEFT JOIN t_accounts USING (id_conta)""",
    "t_actuals": """
    SELECT a.*, centro_nome, area, regiao, conta_nome, tipo, grupo
    FROM t_raw_actuals a LEFT JOIN t_centers USING (id_centro) LEFT JOIN t_accounts USING (id_conta)""",
    "t_base": f"""
    SELECT b.mes, b.id_centro, centro_nome, area, regiao, b.id_conta, conta_nome, tipo, grupo, valor_orcado,
           valor_realizado, CAST(valor_realizado - valor_orcado AS DECIMAL(18,2)) AS variancia,
           {ratio('(valor_realizado - valor_orcado)', 'valor_orcado')} AS variancia_pct
    FROM t_budget b LEFT JOIN t_raw_actuals a
      ON a.id_centro = b.id_centro AND a.id_conta = b.id_conta AND a.mes = b.mes""",
    "t_variance": f"""
    SELECT id_conta, conta_nome, tipo, grupo, id_centro, centro_nome, area, {tot('valor_orcado')} AS orcado_total,
           {tot('valor_realizado')} AS realizado_total, {tot('variancia')} AS variancia,
           {ratio('sum(variancia)', 'sum(valor_orcado)')} AS variancia_pct, count(*) AS meses
    FROM t_base WHERE valor_realizado IS NOT NULL GROUP BY ALL""",
    "t_revenue": f"""
    SELECT mes, {tot('valor_orcado')} AS receita_orcada, {tot('valor_realizado')} AS receita_realizada,
           {ratio('sum(variancia)', 'sum(valor_orcado)')} AS variancia_pct
    FROM t_base WHERE tipo = 'Receita' GROUP BY mes""",
    "t_overruns": f"""
    SELECT *, {ratio('estouro_total', 'orcado_total')} AS variancia_pct,
           rank() OVER (ORDER BY estouro_total DESC) AS posicao
    FROM (SELECT id_conta, conta_nome, grupo, id_centro, centro_nome, area, {tot('valor_orcado')} AS orcado_total,
                 {tot('valor_realizado')} AS realizado_total, {tot('variancia')} AS estouro_total
          FROM t_base WHERE tipo = 'Despesa' AND valor_realizado IS NOT NULL GROUP BY ALL)
    WHERE estouro_total > 0""",
    "t_assets": f"""
    SELECT user_id AS id_ativo, 'AT-' || user_id AS tag,
           {_pick(['Bomba', 'Motor', 'Britador', 'Moinho'], 'user_id')} AS tipo,
           'Fab ' || (user_id % 5) AS fabricante, 'M' || (user_id % 7) AS modelo, 'Site ' || (user_id % 6) AS site,
           {_pick(['Alta', 'Média', 'Baixa'], 'user_id')} AS criticidade,
           DATE '2015-01-01' + CAST(user_id % 3000 AS INT) AS data_instalacao,
           CAST(50 + user_id % 10 * 50 AS INT) AS potencia_kw
    FROM (SELECT DISTINCT user_id FROM events)""",
    "t_readings": """
    SELECT event_id AS id_leitura, user_id AS id_ativo, ts AS data_hora, 40 + value / 10 AS temperatura,
           value AS vibracao, 1 + value / 100 AS pressao,
           CAST(json_extract_string(props, '$.k') AS INT) * 10 AS rpm, tag, tipo, site, criticidade
    FROM events LEFT JOIN t_assets ON id_ativo = user_id WHERE event_type IN ('view', 'click', 'signup')""",
    "t_failures": f"""
    SELECT event_id AS id_falha, user_id AS id_ativo, CAST(ts AS DATE) AS data_falha,
           {_pick(['Desgaste', 'Sobrecarga', 'Lubrificação'], 'event_id')} AS causa,
           {_pick(['Mancal', 'Selo', 'Rotor', 'Acoplamento'], 'event_id')} AS componente,
           CASE WHEN value >= 200 THEN 'Alta' WHEN value >= 150 THEN 'Média' ELSE 'Baixa' END AS severidade
    FROM events WHERE event_type = 'error'""",
    "t_work": """
    SELECT event_id AS id_ordem, user_id AS id_ativo, if(event_id % 4 = 0, 'Corretiva', 'Preventiva') AS tipo_ordem,
           CAST(ts AS DATE) AS data_abertura, CAST(ts AS DATE) + CAST(event_id % 3 AS INT) AS data_fechamento,
           CAST(value * 100 AS DECIMAL(18,2)) AS custo, floor(value) / 10 AS downtime_horas,
           'Ordem ' || event_id AS descricao
    FROM events WHERE event_type = 'purchase'""",
    "t_daily": f"""
    SELECT id_ativo, tag, tipo, site, criticidade, CAST(data_hora AS DATE) AS dia, count(*) AS n_leituras,
           {rnd('avg(temperatura)', 1)} AS temp_media, {rnd('max(temperatura)', 1)} AS temp_max,
           {rnd('avg(vibracao)', 2)} AS vib_media, {rnd('max(vibracao)', 2)} AS vib_max,
           {rnd('stddev_samp(vibracao)', 2)} AS vib_dp, {rnd('avg(pressao)', 2)} AS pres_media,
           {rnd('avg(rpm)', 0)} AS rpm_media
    FROM t_readings GROUP BY ALL""",
    "t_health": f"""
    SELECT *, CASE WHEN score_risco >= 66 THEN 'Crítico' WHEN score_risco >= 40 THEN 'Atenção' ELSE 'Saudável' END
             AS categoria_risco
    FROM (SELECT a.id_ativo, tag, tipo, site, criticidade, {rnd('vr', 2)} AS vibracao_recente,
                 {rnd('vh', 2)} AS vibracao_media_hist, {rnd('tr', 1)} AS temperatura_recente,
                 {rnd('th', 1)} AS temperatura_media_hist, {rnd('100 * (vr / nullif(vh, 0) - 1)', 0)} AS pct_acima_vibracao,
                 CAST({rnd("least(100, greatest(0, 70 * (vr / nullif(vh, 0) - 1) + 30 * (tr / nullif(th, 0) - 1) "
                           "+ CASE criticidade WHEN 'Alta' THEN 8 WHEN 'Média' THEN 4 ELSE 0 END))", 0)} AS INT)
                   AS score_risco
          FROM t_assets a JOIN (
            SELECT id_ativo, avg(vibracao) AS vh, avg(temperatura) AS th,
                   avg(vibracao) FILTER (WHERE late) AS vr, avg(temperatura) FILTER (WHERE late) AS tr
            FROM (SELECT *, data_hora >= (SELECT max(data_hora) FROM t_readings) - INTERVAL 7 DAY AS late
                  FROM t_readings)
            GROUP BY id_ativo HAVING bool_or(late)) USING (id_ativo))""",
    "t_mtbf": f"""
    SELECT f.id_ativo, tag, tipo AS tipo_ativo, site, criticidade, n_falhas, primeira_falha, ultima_falha,
           {rnd('media', 1)} AS mtbf_dias
    FROM (SELECT id_ativo, count(*) AS n_falhas, min(data_falha) AS primeira_falha, max(data_falha) AS ultima_falha,
                 avg(CAST(data_falha - antes AS BIGINT)) AS media
          FROM (SELECT *, lag(data_falha) OVER (PARTITION BY id_ativo ORDER BY data_falha) AS antes FROM t_failures)
          GROUP BY id_ativo) f JOIN t_assets USING (id_ativo)""",
    "t_cost": f"""
    SELECT a.id_ativo, tag, tipo AS tipo_ativo, site, criticidade, tipo_ordem, count(*) AS n_ordens,
           {tot('custo')} AS custo_total, {rnd('sum(downtime_horas)', 1)} AS downtime_total_horas
    FROM t_work JOIN t_assets a USING (id_ativo) GROUP BY ALL""",
    "t_risk": f"""
    SELECT h.id_ativo, h.tag, h.tipo, h.site, h.criticidade, score_risco, categoria_risco, vibracao_recente,
           temperatura_recente, coalesce(n_falhas, 0) AS n_falhas, mtbf_dias,
           CAST(coalesce(custo, 0) AS DECIMAL(28,2)) AS custo_manutencao_total,
           {rnd('coalesce(horas, 0)', 1)} AS downtime_total_horas
    FROM t_health h LEFT JOIN t_mtbf m ON m.id_ativo = h.id_ativo
    LEFT JOIN (SELECT id_ativo, sum(custo) AS custo, sum(downtime_horas) AS horas FROM t_work GROUP BY 1) w
      ON w.id_ativo = h.id_ativo""",
    "t_rules": f"""
    SELECT * FROM (VALUES
    {_RULE_ROWS}) AS v(id_regra, regra_nome, regra_descricao, severidade, regra_categoria, politica_referencia)""",
    "t_approvers": f"""
    SELECT CAST(n_nationkey AS BIGINT) AS id_aprovador, n_name AS aprovador_nome,
           {_pick(['Analista', 'Coordenador', 'Gerente', 'Diretor', 'Vice-Presidente'], 'n_nationkey')} AS aprovador_cargo,
           CAST({_pick([10000, 50000, 200000, 1000000, 5000000], 'n_nationkey')} AS DECIMAL(18,2)) AS alcada_limite
    FROM nation""",
    "t_raw_payments": f"""
    SELECT o_orderkey AS id_transacao, CAST(o_orderdate AS DATE) AS data_transacao,
           o_custkey % (SELECT count(*) FROM supplier) AS id_fornecedor, (o_orderkey * 7) % 25 AS id_solicitante,
           CAST(c_nationkey AS BIGINT) AS id_aprovador, r_name AS area,
           CASE WHEN o_orderkey % 20 = 0 THEN ' ' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Brindes e hospitalidade'
                ELSE c_mktsegment END AS categoria_crua,
           CAST(round(o_totalprice / 2000) * 1000 AS DECIMAL(18,2)) AS valor,
           {_pick(['Transferência', 'Boleto', 'Cartão corporativo', 'Pix'], 'o_orderkey')} AS metodo_pagamento,
           {_CONTRACT} AS contrato_cru, if(o_orderstatus = 'P', 'Pendente', 'Pago') AS status
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN t_places ON n_nationkey = c_nationkey""",
    "t_payments": f"""
    SELECT t.* EXCLUDE (categoria_crua, contrato_cru), {month('data_transacao')} AS mes,
           nullif(trim(categoria_crua), '') AS categoria_despesa, nullif(trim(contrato_cru), '') AS contrato_id,
           razao_social, uf, possui_contrato AS fornecedor_possui_contrato, situacao_cadastral,
           parte_relacionada AS fornecedor_parte_relacionada, aprovador_nome, aprovador_cargo, alcada_limite,
           valor > alcada_limite AS acima_alcada, valor >= 50000 AND NOT possui_contrato AS sem_contrato_relevante,
           id_aprovador = id_solicitante AS sod_violado, situacao_cadastral = 'Irregular' AS fornecedor_irregular,
           parte_relacionada, isodow(data_transacao) >= 6 AS dia_nao_util,
           length(trim(categoria_crua)) = 0 AS sem_categoria
    FROM t_raw_payments t LEFT JOIN t_suppliers USING (id_fornecedor) LEFT JOIN t_approvers USING (id_aprovador)""",
    "t_windows": """
    SELECT a.id_fornecedor, a.data_transacao AS inicio, count(*) AS n_pagamentos, sum(b.valor) AS soma
    FROM (SELECT DISTINCT id_fornecedor, data_transacao FROM t_payments WHERE valor < 50000) a
    JOIN t_payments b ON b.id_fornecedor = a.id_fornecedor AND b.valor < 50000
     AND b.data_transacao BETWEEN a.data_transacao AND a.data_transacao + 10
    GROUP BY ALL HAVING count(*) >= 3 AND sum(b.valor) >= 50000""",
    "t_clusters": """
    SELECT id_fornecedor, inicio, n_pagamentos, CAST(soma AS DECIMAL(28,2)) AS soma
    FROM t_windows QUALIFY row_number() OVER (PARTITION BY id_fornecedor ORDER BY inicio) = 1""",
    "t_split": f"""
    SELECT id_transacao, 'R006' AS id_regra, data_transacao AS data_deteccao, valor AS valor_em_risco,
           'Possível fracionamento: ' || n_pagamentos || ' pagamentos ao mesmo fornecedor em 10 dias somando R$ '
             || {brl('soma')} || '.' AS descricao
    FROM t_payments p JOIN t_clusters c ON c.id_fornecedor = p.id_fornecedor AND valor < 50000
     AND data_transacao BETWEEN inicio AND inicio + 10""",
    "t_repeats": f"""
    SELECT id_transacao, 'R007' AS id_regra, data_transacao AS data_deteccao, valor AS valor_em_risco,
           'Pagamento de R$ ' || {brl('valor')} || ' ao mesmo fornecedor repetido na semana.' AS descricao
    FROM t_payments QUALIFY count(*) OVER (PARTITION BY id_fornecedor, valor, isoyear(data_transacao),
                                           weekofyear(data_transacao)) >= 2""",
    "t_single": f"""
    SELECT id_transacao, id_regra, data_transacao AS data_deteccao, CAST(risco AS DECIMAL(18,2)) AS valor_em_risco,
           descricao
    FROM (SELECT *, 'R001' AS id_regra, valor - alcada_limite AS risco,
                 'Valor de R$ ' || {brl('valor')} || ' acima da alçada do aprovador (' || aprovador_cargo
                   || ', limite R$ ' || {brl('alcada_limite')} || ').' AS descricao
          FROM t_payments WHERE acima_alcada
          UNION ALL SELECT *, 'R002', valor, 'Pagamento de R$ ' || {brl('valor')}
            || ' a fornecedor sem contrato vigente (acima do limite de R$ 50.000,00).'
          FROM t_payments WHERE sem_contrato_relevante
          UNION ALL SELECT *, 'R003', valor, 'Solicitante e aprovador são o mesmo colaborador.'
          FROM t_payments WHERE sod_violado
          UNION ALL SELECT *, 'R004', 0, 'Pagamento liquidado em '
            || if(isodow(data_transacao) = 6, 'sábado', 'domingo') || '.'
          FROM t_payments WHERE dia_nao_util AND status = 'Pago'
          UNION ALL SELECT *, 'R005', valor, 'Fornecedor com situação cadastral irregular na due diligence.'
          FROM t_payments WHERE fornecedor_irregular
          UNION ALL SELECT *, 'R008', 0, 'Lançamento sem categoria de despesa.' FROM t_payments WHERE sem_categoria
          UNION ALL SELECT *, 'R009', valor - 1000, 'Brinde/hospitalidade de R$ ' || {brl('valor')}
            || ' acima do teto de R$ 1.000,00.'
          FROM t_payments WHERE categoria_despesa = 'Brindes e hospitalidade' AND valor > 1000
          UNION ALL SELECT *, 'R010', valor, 'Pagamento a fornecedor sinalizado como parte relacionada.'
          FROM t_payments WHERE parte_relacionada)""",
    "t_raised": f"""
    SELECT *, 'AC-' || id_transacao || '-' || id_regra AS id_achado,
           {_pick(['Aberto', 'Em análise', 'Resolvido', 'Falso positivo'], 'id_transacao')} AS status_achado
    FROM (SELECT * FROM t_single UNION ALL SELECT * FROM t_split UNION ALL SELECT * FROM t_repeats)""",
    "t_findings": f"""
    SELECT id_achado, f.id_transacao, f.id_regra, regra_nome, severidade, regra_categoria, politica_referencia,
           data_deteccao, {month('data_deteccao')} AS mes, status_achado, valor_em_risco, descricao, area,
           id_fornecedor, razao_social, valor AS valor_transacao
    FROM t_raised f LEFT JOIN t_rules USING (id_regra) LEFT JOIN t_payments p ON p.id_transacao = f.id_transacao""",
    "t_finding_rules": f"""
    SELECT id_regra, regra_nome, severidade, regra_categoria, politica_referencia, count(*) AS qtd_achados,
           count(*) FILTER (WHERE status_achado IN ('Aberto', 'Em análise')) AS qtd_em_aberto,
           count(*) FILTER (WHERE status_achado = 'Resolvido') AS qtd_resolvidos,
           {tot('valor_em_risco')} AS valor_em_risco
    FROM t_findings GROUP BY ALL""",
    "t_compliance": f"""
    SELECT area, mes, count(*) AS qtd_transacoes, {tot('valor')} AS valor_transacionado,
           count(n) AS qtd_transacoes_com_achado, CAST(coalesce(sum(n), 0) AS BIGINT) AS qtd_achados,
           CAST(coalesce(sum(risco), 0) AS DECIMAL(28,2)) AS valor_em_risco, {pct_true('n IS NULL')} AS pct_conformidade
    FROM t_payments LEFT JOIN (SELECT id_transacao, count(*) AS n, sum(valor_em_risco) AS risco
                               FROM t_raised GROUP BY 1) USING (id_transacao)
    GROUP BY ALL""",
    "t_uncontracted": f"""
    SELECT area, id_fornecedor, razao_social, situacao_cadastral, count(*) AS qtd_transacoes,
           {tot('valor')} AS valor_total, {tot_where('sem_contrato_relevante', 'valor')} AS valor_acima_limite
    FROM t_payments WHERE NOT fornecedor_possui_contrato GROUP BY ALL""",
}


def compose(body: str, extra: dict[str, str] | None = None) -> str:
    """WITH the tables the body needs, then the body."""
    known = {**TABLES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({known[name]})" for name in needed)
    return f"WITH {ctes}\n{body}"
