"""Tables written once and read back: replaceable targets and intermediate results.

A replaceable table lies under its path as `v<number>`; `versions` says which one holds. Readers see the former table until
the next one is whole, and a job that is lost in between leaves the former one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.session import scratch


def version_of(spark: SparkSession, path: str) -> int:
    """0 where no table was committed yet."""
    try:
        return spark.read.schema("version int").json(f"{path}/versions").agg(F.max("version")).first()[0] or 0
    except AnalysisException:
        return 0


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that the last replacement committed."""
    return read_version(spark, path, version_of(spark, path))


def read_version(spark: SparkSession, path: str, number: int) -> DataFrame:
    return spark.read.parquet(f"{path}/v{number}")


def offset_of(spark: SparkSession, path: str) -> int:
    """The version of its source that the committed table was made of; 0 where none was named."""
    try:
        rows = spark.read.schema("version int, source int").json(f"{path}/versions")
        return rows.agg(F.max_by("source", "version")).first()[0] or 0
    except AnalysisException:
        return 0


def replace_table(df: DataFrame, path: str, kept: int = 2, source: int = 0) -> DataFrame:
    """Create or replace: running it again gives the same table.

    The last `kept` versions stay, at least the one before for those who read it. `source` is committed with the
    version: the version of the table it follows.
    """
    spark = df.sparkSession
    number = version_of(spark, path) + 1
    # A version that was written but not committed is overwritten.
    df.write.mode("overwrite").parquet(f"{path}/v{number}")
    _commit(spark, path, number, source)
    _forget(spark, f"{path}/v{number - max(kept, 2)}")
    return read_version(spark, path, number)


def store_once(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several passes read, so a lost executor recomputes none of it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _commit(spark: SparkSession, path: str, number: int, source: int) -> None:
    """One appended row makes a version the table."""
    row = spark.range(1).select(F.lit(number).alias("version"), F.lit(source).alias("source"))
    row.write.mode("append").json(f"{path}/versions")


def _forget(spark: SparkSession, path: str) -> None:
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
