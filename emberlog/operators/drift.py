"""Distribution drift between a baseline and a current set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions.binning import ratio
from emberlog.operators.ordered import _join_on, exact_percentiles
from emberlog.session import stored

PSI_ALERT = 0.3
PSI_WATCH = 0.1
EPSILON = 1e-6


def _edges(baseline: DataFrame, feature: str, value: str, bins: int) -> DataFrame:
    points = {f"e{i}": i / bins for i in range(1, bins)}
    return exact_percentiles(baseline, [feature], value, points)


def histograms(
    baseline: DataFrame, current: DataFrame, feature: str = "feature", value: str = "value", bins: int = 10
) -> DataFrame:
    """Share per baseline-quantile bin in both sets: ``(feature, bin, p, q)``.

    Both sets share one aggregation. The edges are one row per feature; they are written
    first, so that the join knows their size.
    """
    both = baseline.select(feature, value, F.lit(1).alias("_base")).unionByName(
        current.select(feature, value, F.lit(0).alias("_base"))
    )
    edged = _join_on(both.where(F.col(value).isNotNull()), stored(_edges(baseline, feature, value, bins)), [feature])
    slot = sum([(F.col(value) > F.col(f"e{i}")).cast("int") for i in range(1, bins)], F.lit(0))
    counts = edged.groupBy(feature, slot.alias("bin")).agg(
        F.sum("_base").alias("n_base"), F.sum(1 - F.col("_base")).alias("n_now")
    )
    totals = counts.groupBy(feature).agg(F.sum("n_base").alias("t_base"), F.sum("n_now").alias("t_now"))
    return _join_on(counts, totals, [feature]).select(
        feature, "bin",
        F.greatest(ratio(F.col("n_base"), F.col("t_base"), 0.0), F.lit(EPSILON)).alias("p"),
        F.greatest(ratio(F.col("n_now"), F.col("t_now"), 0.0), F.lit(EPSILON)).alias("q"),
    )


def drift_scores(baseline: DataFrame, current: DataFrame, feature: str = "feature", value: str = "value", bins: int = 10) -> DataFrame:
    """PSI and KL divergence per feature with the alert band."""
    p, q = F.col("p"), F.col("q")
    scores = histograms(baseline, current, feature, value, bins).groupBy(feature).agg(
        F.sum((p - q) * F.ln(p / q)).alias("psi"), F.sum(q * F.ln(q / p)).alias("kl_divergence")
    )
    return scores.withColumn("band", psi_band(F.col("psi")))


def psi_band(psi: Column) -> Column:
    return F.when(psi > PSI_ALERT, "red").when(psi > PSI_WATCH, "yellow").otherwise("green")


def moment_comparison(baseline: DataFrame, current: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """Mean and sample std in both sets, one aggregation."""
    both = baseline.select(feature, F.col(value).alias("b"), F.lit(None).cast("double").alias("c")).unionByName(
        current.select(feature, F.lit(None).cast("double").alias("b"), F.col(value).alias("c"))
    )
    return both.groupBy(feature).agg(
        F.avg("b").alias("baseline_mean"), F.stddev_samp("b").alias("baseline_std"),
        F.avg("c").alias("current_mean"), F.stddev_samp("c").alias("current_std"),
    )


def drift_heatmap(scores: DataFrame, ts: str, psi: str = "psi", width: str = "1 hour", step: float = 0.05) -> DataFrame:
    slot = F.floor(F.round(F.col(psi) / step, 9))
    return scores.groupBy(F.window(ts, width).start.alias("window_start"), slot.alias("psi_slot")).agg(
        F.count(F.lit(1)).alias("n")
    )


def drifting_features(scores: DataFrame, limit: float = PSI_ALERT) -> DataFrame:
    return scores.agg(F.count_if(F.col("psi") > limit).alias("drifting"), F.count(F.lit(1)).alias("features"))


def top_drifting(scores: DataFrame, n: int = 10, feature: str = "feature") -> DataFrame:
    return scores.orderBy(F.desc("psi"), feature).limit(n)


def concept_drift(df: DataFrame, ts: str, hit: Column, width: str, baseline: float | Column, limit: float = 0.5) -> DataFrame:
    """Anomaly rate per window against a baseline rate; alert on a relative change above ``limit``."""
    rates = df.groupBy(F.window(ts, width).start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(hit.cast("int")).alias("anomaly_rate")
    )
    base = baseline if isinstance(baseline, Column) else F.lit(baseline)
    change = ratio(F.abs(F.col("anomaly_rate") - base), base)
    return rates.withColumn("relative_change", change).withColumn("alert", F.coalesce(change > limit, F.lit(False)))
