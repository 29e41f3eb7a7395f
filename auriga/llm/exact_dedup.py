"""Exact duplicates by 128-bit content hash, with the bytes compared inside every group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auriga.llm.common import keep, text_of

# Stands for a null id where ids are compared; it sorts before every id in use.
NO_ID = -(2**63)


def content_hash(text: Column) -> Column:
    """128 bits of MD5 over the UTF-8 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256, content_hash.

    Texts are equal when their bytes are; a null text equals an empty one. The row with the largest id
    stays; a null id comes before all others. Of rows that repeat id and text exactly one is kept. Other
    columns are ignored, whatever their names. An empty table gives no rows.

    Only ids and hashes are shuffled for all rows, folded per task first, so a hot group leaves a task as
    one row. Texts travel for the byte comparison alone, and only those that share a hash.
    """
    rows = _classed(documents, id_column, text_column, hashed)
    rows = keep(
        rows.select("_id", "_hash", "_class", F.sha2("_text", 256).alias("_sha"))
        .groupBy("_id", "_hash", "_class", "_sha")
        .agg(F.count("*").alias("_copies")),
        "exact-rows",
    )
    groups = rows.groupBy("_hash", "_class").agg(F.max("_id").alias("_keep"), F.sum("_copies").alias("group_size"))
    return (
        rows.join(groups, ["_hash", "_class"])
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_keep").alias("keep_id"),
            "group_size",
            (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
            F.col("_sha").alias("text_sha256"),
            F.col("_hash").alias("content_hash"),
        )
    )


def keep_distinct(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """The rows that exact_groups keeps, with all their columns.

    The join key holds the id beside the hash, so the rows of a hot group spread over all tasks.
    """
    rows = _classed(documents, id_column, text_column, hashed, whole=True)
    rows = rows.withColumn("_key", F.coalesce("_id", F.lit(NO_ID)))
    groups = rows.groupBy("_hash", "_class").agg(F.max("_key").alias("_key"))
    one = Window.partitionBy("_hash", "_class", "_key").orderBy("_key")
    return (
        rows.join(groups, ["_hash", "_class", "_key"])
        .withColumn("_copy", F.row_number().over(one))
        .filter("_copy = 1")
        .select("_row.*")
    )


def _classed(
    documents: DataFrame, id_column: str, text_column: str, hashed: Callable[[Column], Column], whole: bool = False
) -> DataFrame:
    """Documents as _id, _text, _hash and _class: 0, or the rank of the text where one hash has several texts."""
    row = [F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")] if whole else []
    rows = documents.select(
        F.col(id_column).cast("bigint").alias("_id"), text_of(text_column).alias("_text"), *row
    ).withColumn("_hash", hashed(F.col("_text")))
    collided = _collisions(rows)
    if collided is None:
        return rows.withColumn("_class", F.lit(0))
    return rows.join(collided, ["_hash", "_text"], "left").withColumn("_class", F.coalesce("_class", F.lit(0)))


def _collisions(rows: DataFrame) -> DataFrame | None:
    """Hash, text and rank of texts that share a hash but differ in bytes; None when there are none.

    Grouping by hash and text compares the bytes, and folds equal texts before the shuffle.
    """
    shared = keep(
        rows.groupBy("_hash").agg(F.count("*").alias("_rows")).filter("_rows > 1").select("_hash"), "shared-hashes"
    )
    texts = rows.join(shared, "_hash", "left_semi").groupBy("_hash", "_text").agg(F.count("*").alias("_rows"))
    odd = keep(
        texts.groupBy("_hash").agg(F.count("*").alias("_texts")).filter("_texts > 1").select("_hash"), "odd-hashes"
    )
    if odd.isEmpty():
        return None
    found = rows.join(odd, "_hash", "left_semi").select("_hash", "_text").distinct()
    rank = F.row_number().over(Window.partitionBy("_hash").orderBy("_text"))
    return keep(found.withColumn("_class", rank), "collisions")
