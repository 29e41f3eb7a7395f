"""The first row of every key, kept up to date by a stream: batches leave their own first rows, which merge when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.operators.silver import keep_first

ORDER = "ordem"


def refresh_first_rows(stream: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str) -> None:
    """Bring the table at `path` up to date: per key the row that sorts first on `order` among all that ever landed.

    A batch writes the first row of each of its keys, in a folder of its own, and replaces it if it runs again. No state
    is held: a row that lands late sorts before those of former batches when the table is read. What each column is in
    the order is kept as metadata of the stored columns.
    """

    def write(batch: DataFrame, number: int) -> None:
        first = keep_first(batch, keys, order)
        placed = [F.col(c).alias(c, metadata={ORDER: order.index(c)}) if c in order else F.col(c) for c in first.columns]
        first.select(*placed).write.mode("overwrite").parquet(f"{path}/{number:012d}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()


def first_rows(spark: SparkSession, keys: list[str], path: str) -> DataFrame:
    """The table as it is: of each key the first of the rows that its batches left."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    places = {field.metadata[ORDER]: field.name for field in rows.schema if ORDER in field.metadata}
    return keep_first(rows, keys, [places[i] for i in sorted(places)])
