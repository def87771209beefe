"""Detectors on Spark ML, fitted on all rows. Boosters on a bounded sample, many at a time,
are in ``boosting``; the search is in ``tuning``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.evaluate import evaluate_models


@dataclass(frozen=True)
class BoosterParams:
    max_depth: int = 6
    step_size: float = 0.1
    rounds: int = 500
    subsample: float = 0.8
    column_share: float = 0.8
    min_rows: int = 1
    min_gain: float = 0.0
    seed: int = 42


# The two boosters of the comparison.
BOOSTER_A = BoosterParams()
BOOSTER_B = BoosterParams(step_size=0.05, rounds=1000, column_share=1.0)


def fit_booster(
    df: DataFrame, params: BoosterParams = BOOSTER_A, features: str = "features", label: str = "label",
    validation: str | None = None, weight: str | None = None,
) -> GBTClassificationModel:
    """Gradient-boosted trees, binary logistic loss.

    ``validation`` names a boolean column; its rows stop the boosting once the held-out
    loss no longer falls, which keeps the best iteration.
    """
    booster = GBTClassifier(
        featuresCol=features, labelCol=label, maxDepth=params.max_depth, stepSize=params.step_size,
        maxIter=params.rounds, subsamplingRate=params.subsample, minInstancesPerNode=params.min_rows,
        minInfoGain=params.min_gain, seed=params.seed,
        featureSubsetStrategy="all" if params.column_share >= 1 else str(params.column_share),
    )
    if validation is not None:
        booster = booster.setValidationIndicatorCol(validation)
    if weight is not None:
        booster = booster.setWeightCol(weight)
    return booster.fit(df)


def class_weights(df: DataFrame, label: str = "label", anomaly: float = 95.0, normal: float = 5.0, out: str = "weight") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, anomaly).otherwise(normal))


def predict(model, df: DataFrame, name: str | None = None, keep: Sequence[str] = ("id", "label")) -> DataFrame:
    """``prediction`` and the anomaly ``score`` for every row; works on streams too."""
    scored = model.transform(df)
    out = [F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("score")]
    if name is not None:
        out.insert(0, F.lit(name).alias("model"))
    return scored.select(*keep, *out)


def feature_importance(spark: SparkSession, model: GBTClassificationModel, names: Sequence[str]) -> DataFrame:
    """One row per feature; the vector has one entry per model input."""
    values = model.featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def save_model(model, path: str) -> None:
    PipelineModel(stages=[model]).write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def compare_models(models: Mapping[str, object], test: DataFrame) -> DataFrame:
    """Metrics of several models on one test set, in a single aggregation."""
    parts = [predict(m, test, name) for name, m in models.items()]
    return evaluate_models(reduce(lambda a, b: a.unionByName(b), parts))


def top_trials(trials: DataFrame, n: int = 3) -> DataFrame:
    """Best trials with equal traffic weights."""
    return trials.orderBy(F.desc("value"), "number").limit(n).withColumn("weight", F.lit(1.0 / n))
