"""Documents to packed sequences: toxicity, exact copies, near copies, mix, packing.

Every stage takes nulls in any column, texts of any length, repeated rows, further columns of any name and
empty tables; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auriga.llm import exact_dedup, mixing, packing, simhash, toxicity
from auriga.llm.common import keep, read
from auriga.llm.queries import byte_bpe


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; null and empty texts are judged like others, repeated rows alike."""
    return toxicity.accepted(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (null counts as empty), the one with the largest id, null ids before all others."""
    return exact_dedup.keep_distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link at two bits, the one with the smallest id, as op8 groups them.

    Texts without words are one group. Null ids come before all others.
    """
    return simhash.near_distinct(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a row for each time a document is taken, in the order of the mix.

    A document that lies in two blocks of the mix is a row for each. Texts without words, null ones too, have nothing to
    take. n_chars follows the text where the table has it. A null source is a source of its own; repeated rows are
    taken each.
    """
    row = F.col("row")
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length(F.col("row")["text"]).cast(dict(docs.dtypes)["n_chars"]))
    return mixing.mixed(docs).select(row.alias("row")).select("row.*")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows of 1024, as op6 returns them; an empty or null text is its end alone."""
    return packing.pack(docs, byte_bpe)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# Trained trees, 64-bit hashes and a tokenizer's ids are beyond SQL; tests hold each stage against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
