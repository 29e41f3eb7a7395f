"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from auriga.llm.common import crc_fold, keep, text_of

FOLDS = 5
# Rows that the lexicon, the trees and the calibration are fitted on, at most; scoring has no bound.
FIT_ROWS = 20_000
LEXICON_TERMS = 2_000
PREFIX = 5
# Pronouns that address a reader, in the languages of the corpus and as commonly shortened.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner euch tu te toi ton ta tes vous votre vos ti tú usted "
    "ustedes vosotros".split()
)
NEAR = 3
FEATURES = (
    "hit_density", "hit_weight", "strong_density", "best_weight", "distinct_hits", "near_you", "you_density",
    "capitals", "shouted", "exclaims", "questions", "punctuation", "obfuscated", "stretched", "log_words",
)
STRIP = ".,;:!?\"'()[]{}<>*_-|/\\"


def toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per document row: doc_id, held_out, score (0 to 1), predicted.

    Labels are learned from rows whose crc32 fold is not 0; of those the fit takes at most `fit_rows`, in the
    order of a hash of the id. Four fifths of them give the lexicon and the trees, one fifth the calibration.
    Several labels of one id count as toxic if any is; labels without a toxic mark are skipped. Inputs of
    a score are the text's features alone.

    A null text is empty; an empty text has features of 0 and is scored like any other. With no labels to
    learn from, or one class only, every score is the share of toxic rows among them (0 without any).
    Repeated rows repeat. Other columns are ignored. An empty table gives no rows.

    Lexicon and trees are bounded by their parameters, so scoring is one pass without a shuffle.
    """
    rows = _rows(documents, id_column, text_column)
    return judged(rows, labels, fit_rows, ["doc_id", "held_out"])


def accepted(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """The documents not predicted toxic, with all their columns. No join: rows carry their columns along."""
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = _rows(documents, id_column, text_column, whole)
    return judged(rows, labels, fit_rows, ["row"]).filter("predicted = 0").select("row.*")


def judged(rows: DataFrame, labels: DataFrame, fit_rows: int, kept: list[str]) -> DataFrame:
    """The kept columns, score and predicted."""
    sample = labelled(rows, labels, fit_rows)
    counts = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        scored = rows.select(*kept, F.lit(1.0 if counts.get(1.0) else 0.0).alias("score"))
    else:
        lexicon = learn_lexicon(sample.filter(~F.col("calibrates")))
        trees, curve = fit(sample, lexicon)
        scored = score(features(rows, lexicon, kept), trees, curve, kept)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _rows(documents: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    text = text_of(text_column).alias("text")
    rows = documents.select(F.col(id_column).cast("bigint").alias("doc_id"), text, *[m.alias("row") for m in more])
    return rows.withColumn("held_out", crc_fold("doc_id", FOLDS) == 0)


def labelled(rows: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """The rows to fit on, with label and calibrates."""
    order = F.xxhash64(F.lit(11), "doc_id")
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    marks = marks.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(crc_fold("doc_id", FOLDS) != 0)
    present = rows.select("doc_id").distinct().join(marks, "doc_id")
    # Bounded by fit_rows ids; only their texts are read on.
    chosen = keep(present.orderBy(order, "doc_id").limit(fit_rows), "tox-labels")
    texts = rows.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return keep(
        texts.select(
            "doc_id", "text", F.col("toxic").cast("double").alias("label"), (F.pmod(order, F.lit(5)) == 0).alias("calibrates")
        ),
        "tox-sample",
    )


def learn_lexicon(sample: DataFrame, terms: int = LEXICON_TERMS) -> dict[str, float]:
    """Words, and word beginnings of PREFIX letters, that are commoner in toxic texts: term -> log odds.

    Distinct per text and counted by class; at most `terms`, those of the clearest evidence.
    """
    blank = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " ")
    words = F.array_distinct(F.split(blank, " "))
    # "*" parts beginnings from words.
    begins = F.transform(F.filter(words, lambda w: F.length(w) >= PREFIX), lambda w: F.concat(F.substring(w, 1, PREFIX), F.lit("*")))
    toxic, size = sample.agg(F.sum("label"), F.count("*")).first()
    clean = size - toxic
    pairs = sample.select("label", F.explode(F.array_distinct(F.concat(words, begins))).alias("term")).filter("term <> ''")
    counts = pairs.groupBy("term").agg(F.sum("label").alias("p"), F.count("*").alias("n")).filter("p >= 5")
    rate = (F.col("p") + 0.5) / (toxic + 1.0)
    base = (F.col("n") - F.col("p") + 0.5) / (clean + 1.0)
    weighed = counts.withColumn("weight", F.log(rate / base))
    # Standard error of the log odds ratio: evidence must be clear of chance.
    error = F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") - F.col("p") + 0.5))
    best = weighed.withColumn("z", F.col("weight") / error).filter("weight > 1 AND z > 3").orderBy(F.desc("z"), "term")
    return {row["term"]: row["weight"] for row in best.limit(terms).collect()}


def features_of(text: str, lexicon: dict[str, float]) -> list[float]:
    words = text.lower().split()
    count = max(len(words), 1)
    bare = [w.strip(STRIP) for w in words]
    begins = [w[:PREFIX] + "*" if len(w) >= PREFIX else "" for w in bare]
    hits: dict[int, float] = {}
    if not lexicon.keys().isdisjoint(bare) or not lexicon.keys().isdisjoint(begins):
        for at, (word, begin) in enumerate(zip(bare, begins, strict=True)):
            weight = max(lexicon.get(word, 0.0), lexicon.get(begin, 0.0))
            if weight:
                hits[at] = weight
    near = sum(any(w in SECOND_PERSON for w in bare[max(0, at - NEAR) : at + NEAR + 1]) for at in hits)
    total = sum(hits.values())
    strong = sum(w > 2.5 for w in hits.values())
    addressed = sum(map(bare.count, SECOND_PERSON)) if len(bare) < 64 else sum(w in SECOND_PERSON for w in bare)
    b = np.frombuffer(text.encode(), dtype=np.uint8)
    n = max(len(b), 1)
    of = np.bincount(b, minlength=256)
    upper = (b >= 65) & (b <= 90)
    letter = upper | ((b >= 97) & (b <= 122)) | (b >= 128)
    symbol = (b == 42) | (b == 64) | (b == 36) | (b == 35) | ((b >= 48) & (b <= 57))
    inside = int((letter[:-2] & symbol[1:-1] & letter[2:]).sum()) if n > 2 else 0
    same = b[1:] == b[:-1]
    stretched = int((same[1:] & same[:-1] & letter[2:]).sum()) if n > 2 else 0
    shouted = int((upper[1:] & upper[:-1]).sum())
    marks = int(of[33:48].sum() + of[58:65].sum() + of[91:97].sum() + of[123:127].sum())
    return [
        len(hits) / count, total / count, strong / count, max(hits.values(), default=0.0),
        float(len({bare[at] for at in hits})), near / count, addressed / count,
        int(upper.sum()) / n, shouted / n, of[33] / n, of[63] / n, marks / n,
        inside / n, stretched / n, math.log1p(len(words)),
    ]


def features(rows: DataFrame, lexicon: dict[str, float], kept: list[str]) -> DataFrame:
    """The kept columns as they are, and FEATURES of `text`; the lexicon goes along with the function."""
    fields = [*rows.select(*kept).schema.fields, *(StructField(name, DoubleType()) for name in FEATURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            values = np.array([features_of(t, lexicon) for t in texts], dtype=float).reshape(-1, len(FEATURES))
            columns = [batch.column(c) for c in kept] + [pa.array(values[:, i]) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *FEATURES])

    return rows.select(*kept, *([] if "text" in kept else ["text"])).mapInArrow(run, StructType(fields))


def fit(sample: DataFrame, lexicon: dict[str, float]) -> tuple[GBTClassificationModel, IsotonicRegressionModel]:
    dense = keep(features(sample, lexicon, ["label", "calibrates"]).coalesce(4), "tox-features")
    dense = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(dense)
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=7).fit(dense.filter(~F.col("calibrates")))
    raw = trees.transform(dense.filter("calibrates")).select(
        "label", vector_to_array("probability")[1].alias("raw")
    )
    if raw.isEmpty():
        raw = trees.transform(dense).select("label", vector_to_array("probability")[1].alias("raw"))
    return trees, IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="prediction_iso").fit(raw)


def score(dense: DataFrame, trees: GBTClassificationModel, curve: IsotonicRegressionModel, kept: list[str]) -> DataFrame:
    """The kept columns and score. The calibrated value decides; the trees' own breaks its ties in rank."""
    dense = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(dense)
    raw = trees.transform(dense).withColumn("raw", vector_to_array("probability")[1])
    calibrated = curve.transform(raw)
    value = 0.999 * F.least(F.greatest("prediction_iso", F.lit(0.0)), F.lit(1.0)) + 0.001 * F.col("raw")
    return calibrated.select(*kept, value.alias("score"))
