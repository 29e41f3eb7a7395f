"""Documents to chunks: sections, size-bounded pieces, text of HTML pages, tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns both Java and RE2 read the same way.
BLANKS = r"[ \t\r\n\f]+"
WORD = r"[\p{L}\p{N}]+"
HIDDEN = [r"(?is)<!--.*?-->", r"(?is)<script\b[^>]*>.*?</script>", r"(?is)<style\b[^>]*>.*?</style>"]
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
TAG = r"(?s)<[^>]*>"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def split_sections(documents: DataFrame, marker: str = "\n## ") -> DataFrame:
    """documents(doc_nome, texto) -> chunks; the marker is put back on every section after the first."""
    pieces = F.posexplode(F.split("texto", "\\Q" + marker + "\\E"))
    kept = [c for c in documents.columns if c not in ("doc_nome", "texto")]
    sections = documents.select("doc_nome", *kept, pieces.alias("secao_idx", "_piece"))
    heading = marker.lstrip("\n")
    return sections.filter(F.length(F.trim("_piece")) > 0).select(
        F.concat("doc_nome", F.lit("#"), F.col("secao_idx").cast("string")).alias("chunk_id"),
        "doc_nome",
        *kept,
        "secao_idx",
        F.when(F.col("secao_idx") == 0, F.col("_piece"))
        .otherwise(F.concat(F.lit(heading), F.col("_piece")))
        .alias("texto"),
    )


def bounded_chunks(documents: DataFrame, most: int = 1000) -> DataFrame:
    """Whole texts in even pieces of at most `most` words: more than half of that once a text needs two."""
    words = F.filter(F.split("texto", BLANKS), lambda w: w != "")
    counted = documents.select("doc_nome", words.alias("_words")).withColumn("_n", F.size("_words"))
    pieces = F.ceil(F.col("_n") / most).cast("int")
    sized = counted.filter(F.col("_n") > 0).withColumn("_pieces", pieces)
    sized = sized.withColumn("_size", F.ceil(F.col("_n") / F.col("_pieces")).cast("int"))
    parts = F.transform(
        F.sequence(F.lit(0), F.col("_pieces") - 1),
        lambda i: F.slice("_words", i * F.col("_size") + 1, F.col("_size")),
    )
    filled = F.filter(parts, lambda part: F.size(part) > 0)
    return sized.select("doc_nome", F.posexplode(filled).alias("parte_idx", "_part")).select(
        F.concat("doc_nome", F.lit("#"), F.col("parte_idx").cast("string")).alias("chunk_id"),
        "doc_nome",
        "parte_idx",
        F.size("_part").alias("n_tokens"),
        F.array_join("_part", " ").alias("texto"),
    )


def check_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("doc_nome").agg(
        F.count("*").alias("qtd_chunks"),
        F.count(F.when(F.length(F.trim("texto")) == 0, 1)).alias("qtd_vazios"),
    )


def page_text(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> title and visible text."""
    visible = F.col("html")
    for pattern in HIDDEN:
        visible = F.regexp_replace(visible, pattern, " ")
    visible = F.regexp_replace(visible, TITLE, " ")
    return pages.select(
        "page_id",
        "url",
        _readable(F.regexp_extract("html", TITLE, 1)).alias("titulo"),
        _readable(visible).alias("texto"),
    )


def _readable(html: Column) -> Column:
    text = F.regexp_replace(html, TAG, " ")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def tokens(text: str = "texto") -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def rule_policies(rules: DataFrame, chunks: DataFrame) -> DataFrame:
    """Each rule with the chunks of the document it names. The catalogue is a handful of rows."""
    named = rules.select("id_regra", F.col("nome").alias("regra_nome"), F.col("politica_referencia").alias("politica"))
    return chunks.join(F.broadcast(named), "politica")
