"""Classifier evaluation from prediction rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions.binning import ratio
from emberlog.operators.ordered import _join_on, ordered_running
from emberlog.operators.stats import best_row, metrics_long, threshold_check

# What a model must reach before it is deployed.
REQUIREMENTS = {"accuracy": 0.85, "f1_score": 0.80, "precision": 0.85, "recall": 0.75}


def confusion(df: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*keys).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"),
    )


def scores_from_confusion(df: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and false-positive rate; empty denominators give 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return df.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + fp + tn + fn, 0.0),
            "precision": ratio(tp, tp + fp, 0.0),
            "recall": ratio(tp, tp + fn, 0.0),
            "f1_score": ratio(2 * tp, 2 * tp + fp + fn, 0.0),
            "false_positive_rate": ratio(fp, fp + tn, 0.0),
        }
    )


def _score_steps(df: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """Running positives and negatives over the distinct scores, ascending."""
    steps = df.groupBy(*keys, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return ordered_running(steps, keys, ["threshold"], {"cum_pos": F.col("pos"), "cum_neg": F.col("neg")})


def roc_auc(df: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", score: str = "score") -> DataFrame:
    """Exact rank-sum AUC with ties counted half; NULL if a class is absent."""
    steps = _score_steps(df, keys, label, score)
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2.0))
    return steps.groupBy(*keys).agg(
        ratio(wins, F.max("cum_pos_total").cast("double") * F.max("cum_neg_total")).alias("auc_roc")
    )


def roc_points(df: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", score: str = "score") -> DataFrame:
    """One ``(threshold, fpr, tpr)`` row per distinct score: predict 1 at or above it."""
    steps = _score_steps(df, keys, label, score)
    tp = F.col("cum_pos_total") - F.col("cum_pos") + F.col("pos")
    fp = F.col("cum_neg_total") - F.col("cum_neg") + F.col("neg")
    return steps.select(
        *keys, "threshold", ratio(fp, F.col("cum_neg_total"), 0.0).alias("fpr"),
        ratio(tp, F.col("cum_pos_total"), 0.0).alias("tpr"),
    )


def evaluate_models(df: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Every model's metrics in one table."""
    metrics = scores_from_confusion(confusion(df, keys))
    return _join_on(metrics, roc_auc(df, keys), list(keys), "left")


def normalise_scores(df: DataFrame, score: str, out: str = "probability", invert: bool = True) -> DataFrame:
    """Min-max scale to [0, 1]; ``invert`` turns low-is-anomalous scores around."""
    value = -F.col(score) if invert else F.col(score)
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("b")).scalar()
    scaled = F.try_divide(value - F.col("_b.low"), F.col("_b.high") - F.col("_b.low"))
    return df.withColumn("_b", bounds).withColumn(out, scaled).drop("_b")


def newest_rows(df: DataFrame, ts: str, tie: str, n: int = 1000) -> DataFrame:
    return df.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def score_summary(df: DataFrame, score: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum(prediction).alias("n_anomalies"),
        F.avg(prediction).alias("anomaly_rate"), F.min(score).alias("score_min"),
        F.max(score).alias("score_max"), F.avg(score).alias("score_mean"),
        F.stddev_pop(score).alias("score_std"),
    )


def join_truth(predictions: DataFrame, truth: DataFrame, on: str) -> DataFrame:
    return predictions.join(truth, on, "inner")


def disagreement(df_old: DataFrame, df_new: DataFrame, on: str, prediction: str = "prediction") -> DataFrame:
    """How often two models differ on the same rows."""
    old = df_old.select(on, F.col(prediction).alias("old"))
    new = df_new.select(on, F.col(prediction).alias("new"))
    return old.join(new, on).agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(F.col("old") != F.col("new")).alias("different"),
        F.avg((F.col("old") != F.col("new")).cast("int")).alias("disagreement_rate"),
    )


def readiness(metrics: DataFrame, criterion: str = "f1_score", required: Mapping[str, float] = REQUIREMENTS) -> DataFrame:
    """The best model by ``criterion`` with one pass / fail row per requirement."""
    best = best_row(metrics, criterion, "model")
    return threshold_check(metrics_long(best, ["model"], list(required)), required)
