"""Failure-risk classifier on Spark ML: training, holdout measures, importances and batch scores."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auriga.operators.features import balance_classes, latest_rows

SIGNALS = [
    "temp_media", "temp_max", "vib_media", "vib_max", "vib_dp", "pres_media", "rpm_media",
    "vib_media_7d", "temp_media_7d", "criticidade_nivel",
]


def with_signals(features: DataFrame) -> DataFrame:
    """Criticality as a level; a deviation over one reading counts as zero."""
    level = F.when(F.col("criticidade") == "Alta", 2.0).when(F.col("criticidade") == "Média", 1.0).otherwise(0.0)
    ready = features.withColumn("criticidade_nivel", level)
    return ready.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SIGNALS})


def train(labelled: DataFrame, kind: str = "forest") -> PipelineModel:
    """Fit on labelled rows with class weights."""
    common = {"featuresCol": "signals", "labelCol": "falha_proxima", "weightCol": "peso"}
    if kind == "forest":
        classifier = RandomForestClassifier(numTrees=20, maxDepth=5, seed=42, **common)
    else:
        classifier = LogisticRegression(maxIter=50, **common)
    steps = [VectorAssembler(inputCols=SIGNALS, outputCol="signals"), classifier]
    return Pipeline(stages=steps).fit(balance_classes(with_signals(labelled)))


def split_by_day(labelled: DataFrame, held_out: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Earlier days train, later days test, so no future leaks into training."""
    first, last = labelled.agg(F.min("dia"), F.max("dia")).first()
    cut = F.date_sub(F.lit(last), int((last - first).days * held_out))
    return labelled.filter(F.col("dia") <= cut), labelled.filter(F.col("dia") > cut)


def measure(model: PipelineModel, held_out: DataFrame) -> DataFrame:
    """AUC and F1 on the held-out days and the importance (or weight) of each signal."""
    scored = model.transform(with_signals(held_out)).select("falha_proxima", "rawPrediction", "prediction")
    auc = BinaryClassificationEvaluator(labelCol="falha_proxima").evaluate(scored)
    f1 = MulticlassClassificationEvaluator(labelCol="falha_proxima", metricName="f1").evaluate(scored)
    fitted = model.stages[-1]
    weights = fitted.featureImportances if hasattr(fitted, "featureImportances") else fitted.coefficients
    rows = [("metrica", "auc", float(auc)), ("metrica", "f1", float(f1))]
    rows += [("importancia", name, float(w)) for name, w in zip(SIGNALS, weights.toArray())]
    return held_out.sparkSession.createDataFrame(rows, "tipo string, nome string, valor double")


def score_latest(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Failure probability of each asset from its newest row."""
    scored = model.transform(with_signals(latest_rows(features)))
    return scored.select(
        "id_ativo", "tag", "dia", vector_to_array("probability")[1].alias("probabilidade_falha")
    )


def riskiest(scores: DataFrame, n: int = 10) -> DataFrame:
    return scores.orderBy(F.col("probabilidade_falha").desc(), "id_ativo").limit(n)
