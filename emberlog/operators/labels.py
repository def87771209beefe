"""Anomaly labels and the row predicates around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions.binning import bucketize, flag
from emberlog.operators.ordered import exact_percentiles

# Thresholds of the label rule.
ERROR_RATE_LIMIT = 0.1
CUTOFF_PERCENTILE = 0.95


def label_cutoffs(df: DataFrame, p: float = CUTOFF_PERCENTILE) -> DataFrame:
    """One row with the memory and duration cutoffs, both in a single ranked pass."""
    long = df.select(
        F.explode(
            F.array(
                F.struct(F.lit("memory").alias("m"), F.col("memory_used_mb").cast("double").alias("v")),
                F.struct(F.lit("duration").alias("m"), F.col("duration").cast("double").alias("v")),
            )
        ).alias("x")
    ).select("x.*")
    ranked = exact_percentiles(long, ["m"], "v", {"cut": p})
    return ranked.agg(
        F.max(F.when(F.col("m") == "memory", F.col("cut"))).alias("memory_cut"),
        F.max(F.when(F.col("m") == "duration", F.col("cut"))).alias("duration_cut"),
    )


def label_anomalies(
    df: DataFrame,
    cutoffs: DataFrame | None = None,
    error_rate: float = ERROR_RATE_LIMIT,
    p: float = CUTOFF_PERCENTILE,
) -> DataFrame:
    """``is_anomaly``: any of error level, error, error rate, slow, memory or duration tail.

    Pass ``cutoffs`` from a narrow frame (two columns are enough) when ``df`` is the
    result of expensive windows, so that those are not evaluated twice.
    """
    cutoffs = label_cutoffs(df, p) if cutoffs is None else cutoffs
    cut = cutoffs.select(F.struct("*").alias("c")).scalar()
    rule = (
        (F.col("log_level") == "ERROR")
        | (F.col("has_error") == 1)
        | (F.col("error_rate") > error_rate)
        | (F.col("is_slow") == 1)
    )
    tails = [F.col("memory_used_mb") > F.col("_cut.memory_cut"), F.col("duration") > F.col("_cut.duration_cut")]
    hit = F.greatest(flag(rule), *[flag(t) for t in tails])
    return df.withColumn("_cut", cut).withColumn("is_anomaly", hit).drop("_cut")


def high_confidence(df: DataFrame, limit: float = 0.85) -> DataFrame:
    return df.where((F.col("prediction") == 1) & (F.col("probability") > limit))


def confidence_tier(df: DataFrame, score: str = "score") -> DataFrame:
    """Tier of an isolation score; lower scores are more anomalous."""
    inf = float("inf")
    tier = bucketize(
        F.col(score),
        [-inf, -0.6, -0.3, 0.0, 0.3, inf],
        ["high_anomaly", "medium_anomaly", "low_anomaly", "low_normal", "high_normal"],
        right=False,
    )
    return df.withColumn("tier", tier)
