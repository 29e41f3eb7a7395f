"""Facts written before their dimension row: when the row lands, its facts are made again, and those alone."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.sources.stored import read_version, replace_table, store_once, version_of

ROUND = "_reparo"


class Repairs:
    """Repaired rows of one version of a streamed table, beside it.

    `seen` holds the dimension keys that the table's facts have met. Each commit of it has a folder of the rows that were
    repaired for it, written before, so a refresh that is lost in between repairs the same rows again.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, version: int, row_key: str):
        self.spark, self.row_key = spark, row_key
        self.base = f"{root}/repairs_{name}/{version}"

    def refresh(
        self, facts: DataFrame, dimensions: dict[str, tuple[DataFrame, str]], transform: Callable[[DataFrame], DataFrame]
    ) -> None:
        """Make the facts again whose key a dimension (name -> rows and key column) did not have at the last refresh.

        A null key waits for no row. Where nothing came late nothing is written or read but the keys.
        """
        keys = store_once(reduce(DataFrame.unionByName, [
            rows.filter(F.col(key).isNotNull()).select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key"))
            for name, (rows, key) in dimensions.items()
        ]).distinct(), "dimension-keys")
        number = version_of(self.spark, f"{self.base}/seen")
        if number:
            late = store_once(keys.join(read_version(self.spark, f"{self.base}/seen", number), keys.columns, "left_anti"), "late-keys")
            if late.isEmpty():
                return
            touched = reduce(lambda a, b: a | b, [F.col(f"_late_{name}").isNotNull() for name in dimensions])
            waiting = facts
            for name, (_, key) in dimensions.items():
                mine = late.filter(F.col("dimension") == name).select(F.col("key").alias(f"_late_{name}"))
                waiting = waiting.join(mine, F.col(key).cast("string") == F.col(f"_late_{name}"), "left")
            waiting = waiting.filter(touched).drop(*[f"_late_{name}" for name in dimensions])
            rows = transform(waiting).withColumn(ROUND, F.lit(number))
            rows.write.mode("overwrite").parquet(f"{self.base}/rows/{number:06d}")
        replace_table(keys, f"{self.base}/seen")

    def applied(self, table: DataFrame) -> DataFrame:
        """The table with its repaired rows in place of those written before, each in its newest form."""
        number = version_of(self.spark, f"{self.base}/seen")
        if number < 2:
            return table
        rows = self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.base}/rows").filter(F.col(ROUND) < number)
        newest = rows.groupBy(self.row_key).agg(F.max(ROUND).alias(ROUND))
        repaired = rows.join(newest, [self.row_key, ROUND])
        return table.join(newest, self.row_key, "left_anti").unionByName(repaired.select(*table.columns))
