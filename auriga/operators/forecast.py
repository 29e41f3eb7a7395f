"""Monthly forecast per series: linear trend plus the mean residual of each calendar month.

The interval is 1.96 standard deviations of what trend and season leave over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INTERVAL = 1.96


def forecast(
    observed: DataFrame, horizon: str, time_col: str, value_col: str, series: Sequence[str] = ()
) -> DataFrame:
    """Rows for every month after a series' last one, up to the month of `horizon`.

    Observations fold to one row per series and month first, so a series is never longer
    than its calendar and each window stays small, however many rows or series there are.
    """
    keys = list(series)
    monthly = (
        observed.filter(F.col(value_col).isNotNull())
        .groupBy(*keys, F.trunc(time_col, "month").alias("_month"))
        .agg(F.sum(value_col).cast("double").alias("_y"))
        .withColumn("_t", (F.year("_month") - 1970) * 12 + F.month("_month"))
        .withColumn("_season", F.month("_month"))
    )
    whole, season = Window.partitionBy(*keys), Window.partitionBy(*keys, "_season")
    fitted = (
        monthly.withColumns(
            {
                "_slope": F.regr_slope("_y", F.col("_t").cast("double")).over(whole),
                "_base": F.regr_intercept("_y", F.col("_t").cast("double")).over(whole),
            }
        )
        .withColumn("_left", F.col("_y") - (F.col("_base") + F.col("_slope") * F.col("_t")))
        .withColumn("_seasonal", F.avg("_left").over(season))
        .withColumn("_noise", F.col("_left") - F.col("_seasonal"))
    )
    model = fitted.groupBy(*keys).agg(
        F.max("_month").alias("_last"),
        F.first("_slope").alias("_slope"),
        F.first("_base").alias("_base"),
        F.stddev_samp("_noise").alias("_sigma"),
        F.map_from_entries(F.collect_set(F.struct("_season", "_seasonal"))).alias("_seasons"),
    )
    end = F.trunc(F.lit(horizon).cast("date"), "month")
    step = F.expr("interval 1 month")
    future = model.filter(F.col("_last") < end).withColumn(
        "_month", F.explode(F.sequence(F.add_months("_last", 1), end, step))
    )
    t = (F.year("_month") - 1970) * 12 + F.month("_month")
    seasonal = F.coalesce(F.try_element_at("_seasons", F.month("_month")), F.lit(0.0))
    center = F.col("_base") + F.col("_slope") * t + seasonal
    margin = INTERVAL * F.col("_sigma")
    return future.select(
        *keys,
        F.col("_month").alias(time_col),
        F.round(center, 2).alias(f"{value_col}_forecast"),
        F.round(center + margin, 2).alias(f"{value_col}_upper"),
        F.round(center - margin, 2).alias(f"{value_col}_lower"),
    )
