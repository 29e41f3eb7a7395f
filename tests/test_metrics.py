"""Metric view, forecast, lookups, ranking, change feed and broadcast bounds."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from auriga.functions.columns import brazilian, settle, share
from auriga.functions.lookups import register_functions
from auriga.operators import risk_model
from auriga.operators.changes import apply_changes, change_feed
from auriga.operators.forecast import forecast
from auriga.operators.joins import global_rank, join_dimension
from auriga.operators.metrics import MetricView
from auriga.operators.oneline import side_by_side


@pytest.fixture(scope="module")
def view(spark):
    rows = spark.createDataFrame([("x", 10, 15), ("x", 30, 30), ("y", 0, 4)], "tipo string, plan int, fact int")
    ratio = 100 * (F.sum("fact") - F.sum("plan")) / F.nullif(F.sum("plan"), F.lit(0))
    return MetricView(rows, {"Tipo": F.col("tipo")}, {"Fato": F.sum("fact"), "Desvio": ratio})


def test_ratio_is_taken_after_grouping(view):
    got = {r["Tipo"]: (r["Fato"], r["Desvio"]) for r in view.query(["Fato", "Desvio"], by=["Tipo"]).collect()}
    assert got == {"x": (45, 12.5), "y": (4, None)}
    assert view.query(["Fato"], where="tipo = 'x'").first()["Fato"] == 45


def test_rows_cannot_be_asked_for(view):
    for wrong in (["*"], ["plan"], []):
        with pytest.raises(ValueError):
            view.query(wrong, by=["Tipo"])


def test_forecast_follows_trend_and_season(spark):
    months = [(y, m) for y in (2020, 2021, 2022) for m in range(1, 13)]
    bump = {7: 50.0, 1: -50.0}

    def value(series, t, m):
        return series * (100 + 2 * t) + bump.get(m, 0.0)

    rows = [(s, date(y, m, 1), value(s, t, m)) for s in (1, 3) for t, (y, m) in enumerate(months)]
    observed = spark.createDataFrame(rows, "s int, mes date, v double")
    got = forecast(observed, "2023-07-31", "mes", "v", ["s"]).collect()
    assert len(got) == 14
    for r in got:
        t = (r.mes.year - 2020) * 12 + r.mes.month - 1
        assert r.v_forecast == pytest.approx(value(r.s, t, r.mes.month), abs=20)
        assert r.v_lower <= r.v_forecast <= r.v_upper
    july = next(r for r in got if r.s == 1 and r.mes.month == 7)
    june = next(r for r in got if r.s == 1 and r.mes.month == 6)
    assert july.v_forecast - june.v_forecast > 30


def test_series_past_the_horizon_gives_nothing(spark):
    observed = spark.createDataFrame([(date(2024, m, 1), float(m)) for m in range(1, 7)], "mes date, v double")
    assert forecast(observed, "2024-06-30", "mes", "v").count() == 0


def test_global_rank_equals_rank(spark):
    df = spark.range(500).select((F.pmod(F.hash("id"), F.lit(90)) + 0.01).cast("decimal(18,2)").alias("v"))
    got = global_rank(df, "v", "p").select("v", "p")
    want = df.withColumn("p", F.rank().over(Window.orderBy(F.col("v").desc())).cast("bigint"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dimension_past_the_bound_joins_the_same(spark):
    fact = spark.range(50).select((F.col("id") % 5).alias("k"), "id")
    dimension = spark.range(4).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small, large = join_dimension(fact, dimension, "k"), join_dimension(fact, dimension, "k", max_bytes=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    plan = small._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_change_feed_round_trip(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 2)], "k int, t string, n int")
    after = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", 5)], "k int, t string, n int")
    changes = change_feed(before, after, ["k"])
    assert sorted((r.k, r._change) for r in changes.collect()) == [(2, "update"), (3, "delete"), (4, "insert")]
    copy = apply_changes(before, changes, ["k"])
    assert sorted(map(tuple, copy.collect()), key=str) == sorted(map(tuple, after.collect()), key=str)


def test_side_by_side_keeps_columns(spark):
    one, two = spark.range(5).agg(F.sum("id").alias("a")), spark.range(3).agg(F.count("*").alias("b"), F.max("id").alias("c"))
    assert side_by_side(one, two).first().asDict() == {"a": 10, "b": 3, "c": 2}


def test_rounding_and_numbers(spark):
    row = spark.range(1).select(
        settle(F.lit(12.249999999999998), 1).alias("a"), settle(F.lit(1.005), 2).alias("b"),
        share(F.lit(1), F.lit(0)).alias("c"), brazilian(F.lit(1234567.8)).alias("d"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == (12.3, 1.01, None, "1.234.567,80")


def test_sql_functions(spark):
    health = spark.createDataFrame([(7, "AT-7", 80, "Crítico", 9.5)],
                                   "id_ativo bigint, tag string, score_risco int, categoria_risco string, vibracao_recente double")
    variance = spark.createDataFrame([("Energia", Decimal(100), Decimal(110), Decimal(10)), ("Energia", Decimal(50), Decimal(50), Decimal(0))],
                                     "conta_nome string, orcado_total decimal(28,2), realizado_total decimal(28,2), variancia decimal(28,2)")
    delivery = spark.createDataFrame([(1, "Uno", 75.5)], "id_fornecedor bigint, razao_social string, otif_pct double")
    findings = spark.createDataFrame([("Uno", Decimal(10)), ("Uno", Decimal(5))], "razao_social string, valor_em_risco decimal(18,2)")
    register_functions(spark, {
        "mnt_saude_ativo": health, "fin_variancia_conta": variance, "sup_otif_fornecedor": delivery,
        "aud_achados_fornecedor": findings,
    })
    assert spark.sql("SELECT score_risco FROM mnt_saude_ativo('AT-7')").first()[0] == 80
    assert spark.sql("SELECT categoria_risco FROM mnt_saude_ativo('7')").first()[0] == "Crítico"
    assert spark.sql("SELECT variancia, variancia_pct FROM fin_variancia_conta('Energia')").first()[:] == (Decimal("10.00"), 6.7)
    assert spark.sql("SELECT otif_pct FROM sup_otif_fornecedor('Uno')").first()[0] == 75.5
    assert spark.sql("SELECT * FROM aud_achados_fornecedor('Uno')").first()[:] == (2, Decimal("15.00"))


def test_functions_take_the_ids_of_their_tables(spark):
    health = spark.createDataFrame([("ATV001", "B-1", 80, "Crítico", 3.5)], "id_ativo string, tag string, score_risco int, categoria_risco string, vibracao_recente double")
    delivery = spark.createDataFrame([("F01", "Uno", 75.5)], "id_fornecedor string, razao_social string, otif_pct double")
    register_functions(spark, {"mnt_saude_ativo": health, "sup_otif_fornecedor": delivery})
    assert spark.sql("SELECT id_ativo FROM mnt_saude_ativo('ATV001')").first()[0] == "ATV001"
    assert spark.sql("SELECT * FROM sup_otif_fornecedor('Uno')").first()[:] == ("F01", 75.5)


def test_global_rank_keeps_every_row(spark):
    values = [5.0, 0.0, -3.0, None, 5.0, -0.001, 1e-9, -3.0, None, 700.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = sorted((r.p, str(r.v)) for r in global_rank(df, "v", "p").select("v", "p").collect())
    df.createOrReplaceTempView("ranked_values")
    want = spark.sql("SELECT rank() OVER (ORDER BY v DESC) AS p, v FROM ranked_values").collect()
    assert got == sorted((r.p, str(r.v)) for r in want)


def test_joins_are_planned_without_jobs(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    join_dimension(spark.range(5), spark.range(9).groupBy("id").count(), "id")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_planted_wear_is_learned_and_ranked(spark):
    """Vibration that rises in the week before a failure: held-out AUC over 0.9, and worn assets are the riskiest."""
    rng = np.random.default_rng(12)
    start, rows = date(2024, 1, 1), []
    for asset in range(24):
        worn = asset % 6 == 0
        for day in range(120):
            left = (119 + (4 if worn else 15) - day) % 21
            wear = 1.5 * (8 - left) if 1 <= left <= 7 else 0.0
            vib = float(rng.normal(5, 0.4) + wear)
            rows.append((f"A{asset:02d}", "t", "Bomba", "Sul", "Alta", start + timedelta(days=day), 50.0, 55.0, vib, vib + 1, 0.3, 2.0, 900.0,
                         vib, 50.0, int(1 <= left <= 7)))
    columns = (
        "id_ativo string, tag string, tipo string, site string, criticidade string, dia date, temp_media double, temp_max double, vib_media double, "
        "vib_max double, vib_dp double, pres_media double, rpm_media double, vib_media_7d double, temp_media_7d double, falha_proxima int"
    )
    labelled = spark.createDataFrame(rows, columns)
    training, held_out = risk_model.split_by_day(labelled)
    for kind in ("forest", "logistic"):
        model = risk_model.train(training, kind)
        measures = {r.nome: r.valor for r in risk_model.measure(model, held_out).collect()}
        assert measures["auc"] > 0.9 and measures["f1"] > 0.8
        scores = risk_model.score_latest(model, labelled.drop("falha_proxima"))
        assert {r.id_ativo for r in risk_model.riskiest(scores, 4).collect()} == {"A00", "A06", "A12", "A18"}
