"""Daily telemetry kept up to date by a stream: batches leave mergeable moments, and days that they touch are summed anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auriga.functions.columns import settle
from auriga.operators.maintenance import ASSET

MEASURES = ["temperatura", "vibracao", "pressao", "rpm"]


def moments(readings: DataFrame) -> DataFrame:
    """One row per asset and day: rows, and for each measure its number, sum and maximum; of vibration the squares too.

    Squares are taken from the batch's own mean, so they keep their digits.
    """
    measures = []
    for name in MEASURES:
        value = F.col(name).cast("double")
        measures += [F.count(name).alias(f"{name}_n"), F.sum(value).alias(f"{name}_sum"), F.max(value).alias(f"{name}_max")]
    squares = (F.var_pop("vibracao") * F.count("vibracao")).alias("vibracao_squares")
    day = F.col("data_hora").cast("date").alias("dia")
    return readings.groupBy(*ASSET, day).agg(F.count("*").alias("n"), *measures, squares)


def daily_from_moments(parts: DataFrame) -> DataFrame:
    """Moments of any number of batches -> the daily table, as daily_telemetry gives it from all readings."""

    def mean(name: str, digits: int) -> Column:
        return settle(F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0)), digits)

    many, total = F.sum("vibracao_n"), F.sum("vibracao_sum")
    between = F.sum(F.col("vibracao_sum") * F.col("vibracao_sum") / F.nullif("vibracao_n", F.lit(0))) - total * total / many
    spread = F.when(many > 1, F.sqrt((F.sum("vibracao_squares") + F.greatest(between, F.lit(0.0))) / (many - 1)))
    return parts.groupBy(*ASSET, "dia").agg(
        F.sum("n").alias("n_leituras"),
        mean("temperatura", 1).alias("temp_media"),
        settle(F.max("temperatura_max"), 1).alias("temp_max"),
        mean("vibracao", 2).alias("vib_media"),
        settle(F.max("vibracao_max"), 2).alias("vib_max"),
        settle(spread, 2).alias("vib_dp"),
        mean("pressao", 2).alias("pres_media"),
        mean("rpm", 0).alias("rpm_media"),
    )


def refresh_daily_telemetry(readings: DataFrame, path: str, checkpoint: str) -> None:
    """Bring the daily table at `path` up to date with a stream of readings.

    A batch writes its moments under `<path>_moments`, by day and batch, and replaces the days it touches by the sum of
    their moments. Readings of former batches are not read again. A late reading counts, the newest day is there,
    and a batch that runs again replaces what it wrote.
    """
    stored = f"{path}_moments"

    def replace_days(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = moments(batch).withColumn("lote", F.lit(number))
        # Overwrites the batch's own partitions only.
        replacing = {"partitionOverwriteMode": "dynamic"}
        new.write.mode("overwrite").options(**replacing).partitionBy("dia", "lote").parquet(stored)
        parts = spark.read.parquet(stored)
        # Days are bounded by the calendar; they prune the partitions that are read.
        days = [row["dia"] for row in parts.filter(F.col("lote") == number).select("dia").distinct().collect()]
        daily = daily_from_moments(parts.filter(F.col("dia").isin(days)))
        daily.write.mode("overwrite").options(**replacing).partitionBy("dia").parquet(path)

    readings.writeStream.foreachBatch(replace_days).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
