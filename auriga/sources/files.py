"""Raw file scans: CSV as strings, whole texts, binary files, and rescue of misfits."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auriga.operators.joins import join_dimension
from auriga.sources.stored import store_once

RESCUED = "_rescued_data"
INGESTED = "_ingested_at"
FILE_NAME = "([^/]+)$"


def columns_of(header: str) -> list[str]:
    return next(csv.reader([header]))


def _lines(reader, folder: str, pattern: str) -> DataFrame:
    """Lines of all files with the file and the byte at which the part of it that was read starts."""
    lines = reader.option("pathGlobFilter", pattern).text(folder)
    return lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))


def parse_lines(lines: DataFrame, columns: Sequence[str] | None = None) -> DataFrame | None:
    """Lines of whole files -> columns by the names in each file's header, as strings, plus rescued text and ingestion time.

    The lines are stored once, so every file is opened once and its header is a row like others: the first line that is
    not blank where the file starts. That line alone is the header; a later one that reads the same is data. Blank
    lines are no data, but in a file of one column, where they are empty values. Without `columns`, those of
    all files are kept; None if no file has a header. The driver sees the distinct headers only.
    """
    filled = F.ltrim("value", F.lit(" \r\uFEFF")) != ""
    kept = store_once(lines.withColumn("_line", F.monotonically_increasing_id()).withColumn("_filled", filled), "csv-lines")
    heads = store_once(_headers(kept), "csv-headers")
    forms = sorted(row["_header"] for row in heads.select("_header").distinct().collect())
    names = list(columns or dict.fromkeys(c for form in forms for c in columns_of(form)))
    if not names:
        return None
    single = [form for form in forms if len(columns_of(form)) == 1]
    placed = join_dimension(kept, heads, "_file", "inner")
    data = placed.filter(
        ((F.col("_start") > 0) | (F.col("_line") > F.col("_first"))) & (F.col("_filled") | F.col("_header").isin(single))
    )
    return _by_name(data, forms, names)


def _headers(kept: DataFrame) -> DataFrame:
    """The header line of every file that has one.

    Its number is found first and its text fetched by that: a number folds in a hash table, while text beside it would
    have every task sort all its lines by file.
    """
    starts = kept.filter("_start = 0 AND _filled")
    firsts = store_once(starts.groupBy("_file").agg(F.min("_line").alias("_first")), "csv-firsts")
    heads = join_dimension(starts.select("_line", "value"), firsts, F.col("_line") == F.col("_first"), "inner")
    return heads.select("_file", "_first", F.regexp_replace("value", "^\uFEFF|\r$", "").alias("_header"))


def _by_name(lines: DataFrame, forms: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Lines parsed by the header of their own file, and put in place by name.

    Each form of header is one schema. Columns beyond `columns` go to the rescued column as JSON; a line with
    missing or extra fields keeps its raw text there, and what it has in its columns. A line is parsed once, into a
    column of its form, from which all its fields are taken.
    """

    def row(form: str) -> Column:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns_of(form), RESCUED]])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED, "escape": '"'}
        value = F.col("value")
        text = F.when(value.endswith("\r"), F.rtrim(value, F.lit("\r"))).otherwise(value)
        return F.when(F.col("_header") == form, F.from_csv(text, _ddl(schema), options))

    def fields(form: str, parsed: Column) -> list[Column]:
        names = columns_of(form)
        surplus = [n for n in names if n not in columns]
        more = F.to_json(F.struct(*[parsed[n].alias(n) for n in surplus])) if surplus else F.lit(None).cast("string")
        values = [parsed[c] if c in names else F.lit(None).cast("string") for c in columns]
        return [F.when(F.col("_header") == form, value) for value in (*values, F.coalesce(parsed[RESCUED], more))]

    rows = lines.select("_header", *[row(form).alias(f"_row{i}") for i, form in enumerate(forms)])
    found = [fields(form, F.col(f"_row{i}")) for i, form in enumerate(forms)]
    placed = [F.coalesce(*of_forms).alias(c) for c, *of_forms in zip([*columns, RESCUED], *found, strict=True)]
    return rows.select(*placed, F.current_timestamp().alias(INGESTED))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)


def scan_csv(
    spark: SparkSession, folder: str, pattern: str = "*.csv", columns: list[str] | None = None
) -> DataFrame:
    """Columns by their names in each file's header, as strings, plus rescued text and ingestion time.

    `folder` may be a glob. Without `columns`, the columns of all files are kept; with them, others are
    rescued. A file without a column has NULL there. Line breaks inside quotes are not read.
    """
    found = parse_lines(_lines(spark.read, folder, pattern), columns)
    if found is None:
        raise ValueError(f"no header in {folder}/{pattern}")
    return found


@dataclass(frozen=True)
class CsvStream:
    """Lines of files that land in a folder. Headers are found in each batch, so a refresh opens new files only."""

    lines: DataFrame
    columns: list[str] | None = None

    def parse(self, batch: DataFrame, known: list[str] | None) -> DataFrame | None:
        """A batch in the columns that are asked for, or else those the table has, or else those of its files."""
        fixed = known and [c for c in known if c not in (RESCUED, INGESTED)]
        return parse_lines(batch, self.columns or fixed)


def stream_csv(
    spark: SparkSession, folder: str, pattern: str = "*.csv", columns: list[str] | None = None
) -> CsvStream:
    """The same scan as a stream: each file is read once, files that land later are picked up.

    A table's columns are fixed by `columns`, or by its first batch: a later file's new ones are rescued, not lost.
    """
    return CsvStream(_lines(spark.readStream, folder, pattern), columns)


def cast_or_rescue(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast string columns; text that does not fit goes to the rescued column as JSON, blanks become NULL.

    What the scan rescued stays: alone as it was, or as one more field of the JSON.
    """
    text = {c: F.nullif(F.trim(c), F.lit("")) for c in types}
    misfit = {c: F.when(text[c].try_cast(t).isNull(), text[c]) for c, t in types.items()}
    earlier = F.col(RESCUED) if RESCUED in df.columns else F.lit(None).cast("string")
    pairs = F.create_map(*[part for c in types for part in (F.lit(c), misfit[c])], F.lit(RESCUED), earlier)
    kept = F.map_filter(pairs, lambda _, value: value.isNotNull())
    fits = F.coalesce(*[F.when(misfit[c].isNotNull(), F.lit(False)) for c in types], F.lit(True))
    rescued = F.when(fits, earlier).otherwise(F.to_json(kept))
    columns = [text[c].try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns if c != RESCUED]
    return df.select(*columns, rescued.alias(RESCUED))


def whole_texts(spark: SparkSession, folder: str, pattern: str = "*", name: str = FILE_NAME) -> DataFrame:
    """One row per text file, named by the part of its path that `name` captures; by default the last."""
    files = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return files.select(
        F.regexp_extract("_metadata.file_path", name, 1).alias("doc_nome"), F.col("value").alias("texto")
    )


def binary_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per file. Content is read only where it is selected."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.regexp_extract("path", FILE_NAME, 1).alias("arquivo"), "path", "length", "content")


def write_csv(df: DataFrame, folder: str) -> None:
    """CSV with a header that keeps blanks and microseconds as they are."""
    df.write.mode("overwrite").options(
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", escape='"'
    ).csv(folder)
