"""Maintenance gold tables over readings, failures and work orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auriga.functions.columns import TOTAL, settle, total

ASSET = ["id_ativo", "tag", "tipo", "site", "criticidade"]

# Fixed values of the health score.
RECENT_DAYS = 7
VIBRATION_WEIGHT = 70
TEMPERATURE_WEIGHT = 30
CRITICALITY_BUMP = {"Alta": 8, "Média": 4}
CRITICAL_SCORE = 66
WARNING_SCORE = 40


def daily_measures() -> list[Column]:
    return [
        F.count("*").alias("n_leituras"),
        settle(F.avg("temperatura"), 1).alias("temp_media"),
        settle(F.max("temperatura"), 1).alias("temp_max"),
        settle(F.avg("vibracao"), 2).alias("vib_media"),
        settle(F.max("vibracao"), 2).alias("vib_max"),
        settle(F.stddev("vibracao"), 2).alias("vib_dp"),
        settle(F.avg("pressao"), 2).alias("pres_media"),
        settle(F.avg("rpm"), 0).alias("rpm_media"),
    ]


def daily_telemetry(readings: DataFrame) -> DataFrame:
    return readings.groupBy(*ASSET, F.col("data_hora").cast("date").alias("dia")).agg(*daily_measures())


def asset_health(readings: DataFrame, assets: DataFrame) -> DataFrame:
    """Risk score: the last days' means over the asset's own history, in one pass.

    "Now" is the newest reading of the data. Assets without a recent reading drop out.
    """
    newest = readings.agg(F.max("data_hora")).scalar()
    recent = F.col("data_hora") >= newest - F.expr(f"interval {RECENT_DAYS} days")
    means = (
        readings.groupBy("id_ativo")
        .agg(
            F.avg("vibracao").alias("vib_hist"),
            F.avg("temperatura").alias("temp_hist"),
            F.avg(F.when(recent, F.col("vibracao"))).alias("vib_rec"),
            F.avg(F.when(recent, F.col("temperatura"))).alias("temp_rec"),
            F.count(F.when(recent, F.lit(1))).alias("_recent"),
        )
        .filter(F.col("_recent") > 0)
    )
    vib_gain = F.col("vib_rec") / F.nullif(F.col("vib_hist"), F.lit(0.0)) - 1
    temp_gain = F.col("temp_rec") / F.nullif(F.col("temp_hist"), F.lit(0.0)) - 1
    bump = F.coalesce(
        *[F.when(F.col("criticidade") == level, F.lit(points)) for level, points in CRITICALITY_BUMP.items()],
        F.lit(0),
    )
    raw = VIBRATION_WEIGHT * vib_gain + TEMPERATURE_WEIGHT * temp_gain + bump
    # greatest/least skip NULLs, so a score over missing means falls to zero.
    score = settle(F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw)), 0).cast("int")
    return (
        assets.select(*ASSET)
        .join(means, "id_ativo")
        .select(
            *ASSET,
            settle(F.col("vib_rec"), 2).alias("vibracao_recente"),
            settle(F.col("vib_hist"), 2).alias("vibracao_media_hist"),
            settle(F.col("temp_rec"), 1).alias("temperatura_recente"),
            settle(F.col("temp_hist"), 1).alias("temperatura_media_hist"),
            settle(100 * vib_gain, 0).alias("pct_acima_vibracao"),
            score.alias("score_risco"),
        )
        .withColumn(
            "categoria_risco",
            F.when(F.col("score_risco") >= CRITICAL_SCORE, "Crítico")
            .when(F.col("score_risco") >= WARNING_SCORE, "Atenção")
            .otherwise("Saudável"),
        )
    )


def mean_time_between_failures(failures: DataFrame, assets: DataFrame) -> DataFrame:
    """The mean gap between consecutive failures is (last - first) / (failures - 1).

    That identity needs no ordering, so an asset with very many failures is still a
    partial aggregate. One failure leaves NULL.
    """
    dated = F.count("data_falha")
    gap = F.datediff(F.max("data_falha"), F.min("data_falha")) / F.nullif(dated - 1, F.lit(0))
    per_asset = failures.groupBy("id_ativo").agg(
        F.count("*").alias("n_falhas"),
        F.min("data_falha").alias("primeira_falha"),
        F.max("data_falha").alias("ultima_falha"),
        settle(F.when(dated > 1, gap), 1).alias("mtbf_dias"),
    )
    asset = assets.select("id_ativo", "tag", F.col("tipo").alias("tipo_ativo"), "site", "criticidade")
    return per_asset.join(asset, "id_ativo")


def maintenance_cost(work_orders: DataFrame, assets: DataFrame) -> DataFrame:
    """Grouped by asset before the join, so only totals meet the asset table."""
    per_asset = work_orders.groupBy("id_ativo", "tipo_ordem").agg(
        F.count("*").alias("n_ordens"),
        total("custo").alias("custo_total"),
        settle(F.sum("downtime_horas"), 1).alias("downtime_total_horas"),
    )
    asset = assets.select("id_ativo", "tag", F.col("tipo").alias("tipo_ativo"), "site", "criticidade")
    return per_asset.join(asset, "id_ativo")


def assets_at_risk(health: DataFrame, mtbf: DataFrame, work_orders: DataFrame) -> DataFrame:
    """One row per scored asset, worst first."""
    spent = work_orders.groupBy("id_ativo").agg(
        F.sum("custo").alias("_cost"), F.sum("downtime_horas").alias("_hours")
    )
    return (
        health.join(mtbf.select("id_ativo", "n_falhas", "mtbf_dias"), "id_ativo", "left")
        .join(spent, "id_ativo", "left")
        .select(
            *ASSET,
            "score_risco",
            "categoria_risco",
            "vibracao_recente",
            "temperatura_recente",
            F.coalesce("n_falhas", F.lit(0)).cast("bigint").alias("n_falhas"),
            "mtbf_dias",
            F.coalesce("_cost", F.lit(0)).cast(TOTAL).alias("custo_manutencao_total"),
            settle(F.coalesce("_hours", F.lit(0.0)), 1).alias("downtime_total_horas"),
        )
        .orderBy(F.col("score_risco").desc(), F.col("custo_manutencao_total").desc())
    )
