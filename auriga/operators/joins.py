"""Joins that stay safe when a dimension grows or one key holds much of the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auriga.sources.stored import store_once

# Small enough for every task to hold; Catalyst's own estimate must prove it.
BROADCAST_BYTES = 32 << 20


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the planner's estimate of a plan, an upper bound from file sizes, is within the limit. Runs no job."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes())) <= max_bytes


def join_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a dimension with one row per key.

    A dimension that is small by the planner's estimate is broadcast and the fact is not shuffled. Any other
    joins by shuffle, where adaptive execution broadcasts what turns out small and splits hot keys.
    """
    if fits_broadcast(dimension, max_bytes):
        dimension = F.broadcast(dimension)
    return fact.join(dimension, on, how)


def global_rank(df: DataFrame, value: str, output: str) -> DataFrame:
    """rank() over (order by value desc), null last, without sending every row, or every row of a value, to one task.

    Values fold to one row each with their number of rows, are dealt by ranges that a sample of them sets, and count on
    inside each range; a table of one row per range adds what lies in the ranges above. The rows are stored first,
    as both steps read them.
    """
    rows = store_once(df, "ranked")
    values = rows.groupBy(value).agg(F.count("*").alias("_rows"))
    order = F.col(value).desc_nulls_last()
    ranged = store_once(values.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "rank-ranges")
    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(F.sum("_rows").alias("_all")).select(
        "_range", F.coalesce(F.sum("_all").over(above), F.lit(0)).alias("_above")
    )
    before = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        ranged.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .join(F.broadcast(offsets), "_range")
        .select(F.col(value).alias("_value"), (F.col("_before") + F.col("_above") + 1).cast("bigint").alias(output))
    )
    return rows.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def first_by(order: Sequence[Column], *columns: str) -> Column:
    """The columns of the row that sorts first; a partial aggregate instead of a window."""
    return F.min_by(F.struct(*columns), F.struct(*order))
