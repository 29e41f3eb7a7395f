"""Failure-risk features, labels, class weights and the pre-failure uplift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auriga.functions.columns import settle
from auriga.operators.maintenance import ASSET, daily_measures

HORIZON_DAYS = 7
RAMP_DAYS = 12


def _sums() -> list[Column]:
    return [
        F.sum("vibracao").alias("_vib"),
        F.count("vibracao").alias("_n_vib"),
        F.sum("temperatura").alias("_temp"),
        F.count("temperatura").alias("_n_temp"),
    ]


def _over_days(first: int, last: int):
    """Days are a bounded calendar, so a window over daily rows of one asset stays small."""
    return Window.partitionBy("id_ativo").orderBy(F.unix_date("dia")).rangeBetween(first, last)


def daily_features(readings: DataFrame) -> DataFrame:
    """Daily telemetry plus the means of all readings of the last seven days.

    One grouping yields the daily measures and the sums the moving means are made of.
    """
    daily = readings.groupBy(*ASSET, F.col("data_hora").cast("date").alias("dia")).agg(
        *daily_measures(), *_sums()
    )
    week = _over_days(1 - HORIZON_DAYS, 0)

    def moving(name: str) -> Column:
        return settle(F.sum(name).over(week) / F.nullif(F.sum(f"_n{name}").over(week), F.lit(0)), 4)

    return daily.withColumns({"vib_media_7d": moving("_vib"), "temp_media_7d": moving("_temp")}).drop(
        "_vib", "_n_vib", "_temp", "_n_temp"
    )


def label_failures(features: DataFrame, failures: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """falha_proxima = 1 when the asset fails from the next day up to `days` days later.

    Each failure day is turned into the days it marks, so the test is an equality join.
    """
    marked = (
        failures.select("id_ativo", "data_falha")
        .distinct()
        .select(
            "id_ativo",
            F.explode(F.sequence(F.date_sub("data_falha", days), F.date_sub("data_falha", 1))).alias("dia"),
        )
        .distinct()
        .withColumn("_hit", F.lit(1))
    )
    return (
        features.join(marked, ["id_ativo", "dia"], "left")
        .withColumn("falha_proxima", F.coalesce("_hit", F.lit(0)))
        .drop("_hit")
    )


def balance_classes(labelled: DataFrame) -> DataFrame:
    """peso = n / (2 * rows of the class), so both classes weigh the same in total."""
    counts = labelled.agg(
        F.struct(F.count("*").alias("n"), F.sum("falha_proxima").alias("positive")).alias("_counts")
    ).scalar()
    with_counts = labelled.withColumn("_c", counts)
    n, positive = F.col("_c.n"), F.col("_c.positive")
    size = F.when(F.col("falha_proxima") == 1, positive).otherwise(n - positive)
    return with_counts.withColumn("peso", n / (2 * size)).drop("_c")


def failure_uplift(readings: DataFrame, failures: DataFrame, ramp: int = RAMP_DAYS) -> DataFrame:
    """Mean vibration in the ramp up to a failure against all readings before the ramp.

    Readings and failures fold to one row per asset and day; running sums over days then
    answer every failure without pairing it with readings. Failures lacking either side drop out.
    """
    sums = readings.groupBy("id_ativo", F.col("data_hora").cast("date").alias("dia")).agg(*_sums()[:2])
    nothing = failures.select("id_ativo", F.col("data_falha").alias("dia")).distinct().withColumns(
        {"_vib": F.lit(0.0), "_n_vib": F.lit(0).cast("bigint")}
    )
    grid = sums.unionByName(nothing).groupBy("id_ativo", "dia").agg(
        F.sum("_vib").alias("_vib"), F.sum("_n_vib").alias("_n")
    )
    near, past = _over_days(-ramp, 0), _over_days(Window.unboundedPreceding, -ramp - 1)

    def mean(window):
        return F.sum("_vib").over(window) / F.nullif(F.sum("_n").over(window), F.lit(0))

    around = grid.select("id_ativo", F.col("dia").alias("data_falha"), mean(near).alias("_ramp"), mean(past).alias("_base"))
    return (
        failures.select("id_falha", "id_ativo", "data_falha")
        .join(around, ["id_ativo", "data_falha"])
        .filter(F.col("_ramp").isNotNull() & F.col("_base").isNotNull())
        .select(
            "id_falha", "id_ativo", "data_falha",
            settle(F.col("_base"), 2).alias("vib_antes"),
            settle(F.col("_ramp"), 2).alias("vib_rampa"),
            settle(100 * (F.col("_ramp") / F.nullif(F.col("_base"), F.lit(0.0)) - 1), 1).alias("aumento_pct"),
        )
    )


def latest_rows(features: DataFrame) -> DataFrame:
    """The newest feature row of each asset."""
    rest = [c for c in features.columns if c not in ASSET]
    newest = features.groupBy(*ASSET).agg(F.max_by(F.struct(*rest), "dia").alias("_row"))
    return newest.select(*ASSET, "_row.*")
