"""Append-only tables fed by streams, with refresh and full refresh.

A table lives under `<root>/<name>/v<version>`: its parquet data and the stream's
checkpoint. A refresh goes on from the checkpoint; a full refresh starts the next
version. Versions are recorded by appending, so a lost job never leaves a table
without a current version.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from auriga.sources.files import CsvStream


def start_append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start writing everything the stream has now; the query ends by itself."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class StreamTable:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark = spark
        self.base = f"{root}/{name}"
        self.version = self._newest_version()

    def _newest_version(self) -> int:
        """0 before the first refresh."""
        try:
            versions = self.spark.read.schema("version int").json(f"{self.base}/versions")
            return versions.agg(F.max("version")).first()[0] or 0
        except AnalysisException:
            return 0

    def _next_version(self) -> None:
        self.version += 1
        row = self.spark.createDataFrame([(self.version,)], "version int")
        row.coalesce(1).write.mode("append").json(f"{self.base}/versions")

    @property
    def data_path(self) -> str:
        return f"{self.base}/v{self.version}/data"

    def start(self, stream: DataFrame | CsvStream, full: bool = False) -> StreamingQuery:
        """Append what the stream has not delivered yet; `full` rebuilds the table from its source."""
        if full or self.version == 0:
            self._next_version()
        checkpoint = f"{self.base}/v{self.version}/checkpoint"
        if isinstance(stream, CsvStream):
            writer = stream.lines.writeStream.foreachBatch(self._appending(stream))
            return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        return start_append(stream, self.data_path, checkpoint)

    def _appending(self, stream: CsvStream):
        """Each batch has its own folder, so a batch that runs again replaces what it wrote before."""
        path = self.data_path

        def append(batch: DataFrame, number: int) -> None:
            rows = stream.parse(batch, self.columns())
            if rows is not None:
                rows.write.mode("overwrite").parquet(f"{path}/{number:012d}")

        return append

    def refresh(self, stream: DataFrame | CsvStream, full: bool = False) -> StreamTable:
        self.start(stream, full).awaitTermination()
        return self

    def read(self, schema: StructType | None = None) -> DataFrame:
        """The table; with a schema also one that has no rows yet."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.option("recursiveFileLookup", "true").parquet(self.data_path)

    def columns(self) -> list[str] | None:
        """Columns the table has already; None before its first refresh."""
        try:
            return self.read().columns
        except AnalysisException:
            return None

    def stream(self) -> DataFrame:
        """The table as a stream of its appends."""
        reader = self.spark.readStream.schema(self.read().schema).option("recursiveFileLookup", "true")
        return reader.parquet(self.data_path)
