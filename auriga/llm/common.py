"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.session import scratch

# Words are runs without the six ASCII blanks; no other white space parts them.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; a null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def crc_fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it many times inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sliced(batches: Iterator[pd.DataFrame], rows: int = 256) -> Iterator[pd.DataFrame]:
    """The same rows in smaller frames, so that what a function makes of each stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows].reset_index(drop=True)


def map_frames(
    df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, ids: str = "doc_id"
) -> DataFrame:
    """mapInPandas in which the bigint column `ids` travels as text, both ways.

    pandas makes doubles of whole numbers as soon as one of them is null, and so rounds large ones.
    """
    named = f"{ids} bigint"
    if named not in schema:
        raise ValueError(f"{named} is not in {schema}")
    given = df.withColumn(ids, F.col(ids).cast("string"))
    found = given.mapInPandas(run, schema.replace(named, f"{ids} string"))
    return found.withColumn(ids, F.col(ids).cast("bigint"))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several passes read as Parquet in the shared folder, and read it back.

    The plan after it starts at the files, so a lost executor costs no step before them.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """checkpoint() into the shared folder: ends the lineage of an iterative job.

    Spark removes the files when the frame is no longer used and the session says so.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(scratch(df.sparkSession, "checkpoints"))
    return df.checkpoint()
