"""Hand-sized frames for the edges of silver and gold tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from auriga.operators import features, finance, maintenance, procurement, quality, silver


def day(text: str) -> date:
    return date.fromisoformat(text)


def test_receipt_flags_are_three_valued(spark):
    rows = [
        ("a", day("2024-01-10"), None, "1", True),
        ("b", day("2024-01-10"), day("2024-01-10"), "1", False),
        ("c", day("2024-01-10"), day("2024-01-12"), "1", None),
        ("d", day("2024-01-10"), day("2024-01-09"), "1", None),
    ]
    raw = spark.createDataFrame(
        rows, "id_pedido string, data_prometida date, data_recebida date, qtd_recebida string, ok_qualidade boolean"
    )
    got = {r.id_pedido: (r.dias_atraso, r.no_prazo, r.otif) for r in silver.timed_receipts(raw).collect()}
    assert got == {"a": (None, None, None), "b": (0, True, False), "c": (2, False, False), "d": (-1, True, None)}


def test_null_flag_counts_as_missed(spark):
    receipts = spark.createDataFrame(
        [("a", day("2024-01-05"), True, True), ("b", day("2024-01-08"), True, None), ("c", None, None, None)],
        "id_pedido string, data_recebida date, no_prazo boolean, otif boolean",
    )
    orders = spark.createDataFrame(
        [(k, day("2024-01-01"), "F1", "Uno", "Alta") for k in "abc"],
        "id_pedido string, data_pedido date, id_fornecedor string, razao_social string, criticidade string",
    )
    row = procurement.supplier_delivery(receipts, orders).first()
    assert (row.qtd_pedidos_recebidos, row.lead_time_medio_dias, row.pct_no_prazo, row.otif_pct) == (2, 5.5, 100.0, 50.0)


def test_blank_contract_is_outside_and_cancelled_counts(spark):
    orders = spark.createDataFrame(
        [(1, 1, "k", "2024-01-03", "Sul", "10.00", "Cancelado", " "), (2, 1, "k", "2024-01-04", "Sul", "30.00", "Aberto", "CT1")],
        "id_pedido int, id_fornecedor int, id_categoria string, data_pedido string, centro string, "
        "valor_total string, status string, contrato_id string",
    )
    suppliers = spark.createDataFrame(
        [(1, "Uno", "Alta", "true", "SP")],
        "id_fornecedor int, razao_social string, criticidade string, fornecedor_unico string, uf string",
    )
    categories = spark.createDataFrame([("k", "Peças", "MRO")], "id_categoria string, nome string, tipo string")
    enriched = silver.enriched_orders(orders, suppliers, categories)
    row = procurement.contract_coverage(enriched).first()
    assert (row.pct_em_contrato, row.pct_fora_contrato) == (75.0, 25.0)
    assert procurement.category_spend(enriched).first().gasto == Decimal("40.00")
    assert procurement.category_spend(enriched, ["Cancelado"]).first().gasto == Decimal("30.00")


def _base(spark, rows):
    return spark.createDataFrame(
        [(day("2024-01-01"), a, "Conta " + a, "Despesa", "g", c, "Centro " + c, "x", "x",
          Decimal(b), None if r is None else Decimal(r), None if r is None else Decimal(r) - Decimal(b))
         for a, c, b, r in rows],
        "mes date, id_conta string, conta_nome string, tipo string, grupo string, id_centro string, "
        "centro_nome string, area string, regiao string, valor_orcado decimal(18,2), "
        "valor_realizado decimal(18,2), variancia decimal(18,2)",
    )


def test_zero_budget_has_no_percentage(spark):
    assert finance.budget_variance(_base(spark, [("a", "1", "0", "5")])).first().variancia_pct is None


def test_equal_overruns_share_a_rank(spark):
    base = _base(spark, [("a", "1", "10", "20"), ("b", "1", "10", "20"), ("c", "1", "10", "15"), ("d", "1", "10", "9")])
    got = {r.id_conta: r.posicao for r in finance.top_overruns(base).collect()}
    assert got == {"a": 1, "b": 1, "c": 3}


def test_open_months_stay_in_the_expense_denominator(spark):
    base = _base(spark, [("a", "1", "100", "150"), ("a", "1", "100", None)])
    row = finance.expense_by_group(base).first()
    assert (row.realizado, row.variancia_pct) == (Decimal("150.00"), 25.0)


def _assets(spark, rows):
    return spark.createDataFrame(
        [(k, "T" + k, "Bomba", "Sul", level) for k, level in rows],
        "id_ativo string, tag string, tipo string, site string, criticidade string",
    )


def test_time_between_failures(spark):
    failures = spark.createDataFrame(
        [("one", day("2024-01-01")), ("two", day("2024-01-01")), ("two", day("2024-02-16")),
         ("tie", day("2024-01-01")), ("tie", day("2024-01-01")), ("tie", day("2024-01-11"))],
        "id_ativo string, data_falha date",
    )
    assets = _assets(spark, [("one", "Alta"), ("two", "Alta"), ("tie", "Alta")])
    got = {r.id_ativo: (r.n_falhas, r.mtbf_dias) for r in
           maintenance.mean_time_between_failures(failures, assets).collect()}
    assert got == {"one": (1, None), "two": (2, 46.0), "tie": (3, 5.0)}


def _readings(spark, rows):
    return spark.createDataFrame(
        [(a, "T" + a, "Bomba", "Sul", "Alta", t, v, temp, 1.0, 10) for a, t, v, temp in rows],
        "id_ativo string, tag string, tipo string, site string, criticidade string, data_hora timestamp_ntz, "
        "vibracao double, temperatura double, pressao double, rpm int",
    )


def test_health_score_and_missing_recent(spark):
    start = datetime(2024, 3, 1)
    # Two old readings at 1, one recent at 4: history mean 2, recent twice that; temperature flat.
    rows = [("a", start, 1.0, 50.0), ("a", start + timedelta(days=1), 1.0, 50.0), ("a", start + timedelta(days=30), 4.0, 50.0),
            ("b", start, 1.0, 50.0)]
    health = maintenance.asset_health(_readings(spark, rows), _assets(spark, [("a", "Alta"), ("b", "Alta")]))
    got = [(r.id_ativo, r.score_risco, r.categoria_risco, r.pct_acima_vibracao) for r in health.collect()]
    assert got == [("a", 78, "Crítico", 100.0)]


def test_recent_window_keeps_its_edge(spark):
    start = datetime(2024, 3, 1)
    rows = [("a", start, 2.0, 50.0), ("a", start + timedelta(days=7), 2.0, 50.0)]
    health = maintenance.asset_health(_readings(spark, rows), _assets(spark, [("a", "Baixa")]))
    assert health.first().pct_acima_vibracao == 0.0


def test_label_window_is_next_day_to_seventh(spark):
    days = spark.createDataFrame([("a", day(f"2024-01-{d:02d}")) for d in range(1, 12)], "id_ativo string, dia date")
    failures = spark.createDataFrame([("a", day("2024-01-10"))], "id_ativo string, data_falha date")
    marked = features.label_failures(days, failures).filter("falha_proxima = 1").collect()
    assert sorted(r.dia.day for r in marked) == [3, 4, 5, 6, 7, 8, 9]


def test_moving_mean_weighs_readings(spark):
    start = datetime(2024, 3, 1)
    rows = [("a", start, 1.0, 10.0), ("a", start + timedelta(hours=1), 3.0, 10.0), ("a", start + timedelta(days=6), 8.0, 10.0),
            ("a", start + timedelta(days=7), 2.0, 10.0)]
    got = {r.dia.day: r.vib_media_7d for r in features.daily_features(_readings(spark, rows)).collect()}
    assert got == {1: 2.0, 7: 4.0, 8: 5.0}


def test_uplift_needs_both_sides(spark):
    start = datetime(2024, 3, 1)
    rows = [("a", start, 1.0, 1.0), ("a", start + timedelta(days=20), 3.0, 1.0), ("b", start, 1.0, 1.0)]
    failures = spark.createDataFrame(
        [(1, "a", day("2024-03-22")), (2, "b", day("2024-03-02"))], "id_falha int, id_ativo string, data_falha date"
    )
    got = features.failure_uplift(_readings(spark, rows), failures).collect()
    assert [(r.id_falha, r.vib_antes, r.vib_rampa, r.aumento_pct) for r in got] == [(1, 1.0, 3.0, 200.0)]


def test_class_weights_balance(spark):
    labelled = spark.createDataFrame([(1,), (0,), (0,), (0,)], "falha_proxima int")
    weights = features.balance_classes(labelled).groupBy("falha_proxima").agg(F.sum("peso").alias("w")).collect()
    assert {round(r.w, 9) for r in weights} == {2.0}


def test_orphans_count_null_keys_and_hot_keys(spark):
    fact = spark.createDataFrame([(1,), (9,), (9,), (9,), (None,)], "k int")
    dimension = spark.createDataFrame([(1,)], "id int")
    assert quality.orphan_count("t", fact, "k", dimension, "id").first().orfaos == 4


def test_keep_first_takes_smallest(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 7, "c")], "k int, v int, t string")
    assert sorted(map(tuple, silver.keep_first(df, ["k"], ["v", "t"]).collect())) == [(1, 3, "a"), (2, 7, "c")]
