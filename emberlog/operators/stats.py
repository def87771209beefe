"""Summaries, shares and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.functions.binning import ratio
from emberlog.operators.ordered import _join_on, exact_percentiles


def metrics_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
                 name: str = "metric", value: str = "value") -> DataFrame:
    """Numeric columns turned into rows; one narrow pass."""
    doubles = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(ids), list(columns), name, value)


def group_summary(df: DataFrame, keys: Sequence[str], value: str, percentiles: Mapping[str, float] | None = None) -> DataFrame:
    """n, mean, sample std and exact percentiles per group."""
    base = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )
    points = {"median": 0.5} if percentiles is None else percentiles
    if not points:
        return base
    return _join_on(base, exact_percentiles(df, keys, value, points), list(keys), "left")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def success_rate(df: DataFrame, keys: Sequence[str], success: Column) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(success.cast("int")).alias("success_rate")
    )


def traffic_share(df: DataFrame, variant: str, success: Column, latency: str) -> DataFrame:
    """Share of the successes and mean latency of the successes per variant."""
    per = df.groupBy(variant).agg(
        F.count_if(success).alias("successes"), F.avg(F.when(success, F.col(latency))).alias("mean_latency")
    )
    total = per.agg(F.sum("successes").alias("t")).scalar()
    return per.withColumn("share_percent", 100.0 * F.col("successes") / total)


def pairs_of(df: DataFrame, variant: str, on: Sequence[str] = ()) -> DataFrame:
    """Every unordered pair of rows ``variant_a < variant_b`` of an aggregated table.

    Input is one row per (variant, ``on``), so the output is bounded by the squared
    number of variants. The pair list is made per ``on`` group by the join keys.
    """
    on = list(on)
    others = [c for c in df.columns if c not in (variant, *on)]
    keyed = df if on else df.withColumn("_all", F.lit(1))
    join_keys = on or ["_all"]
    left = keyed.select(*join_keys, F.col(variant).alias("variant_a"), *[F.col(c).alias(f"{c}_a") for c in others])
    right = keyed.select(*join_keys, F.col(variant).alias("variant_b"), *[F.col(c).alias(f"{c}_b") for c in others])
    return left.join(right, join_keys).where(F.col("variant_a") < F.col("variant_b")).select(
        *on, "variant_a", "variant_b", *[c for name in others for c in (f"{name}_a", f"{name}_b")]
    )


def faster_variant(df: DataFrame, variant: str, latency: str) -> DataFrame:
    """Which of two variants is faster and by how much of the slower one."""
    means = df.groupBy(variant).agg(F.avg(latency).alias("mean"))
    gap = F.abs(F.col("mean_a") - F.col("mean_b"))
    return pairs_of(means, variant).select(
        "variant_a", "variant_b",
        F.when(F.col("mean_a") < F.col("mean_b"), F.col("variant_a")).otherwise(F.col("variant_b")).alias("faster"),
        gap.alias("difference"),
        (100 * ratio(gap, F.greatest("mean_a", "mean_b"))).alias("percent"),
    )


def daily_counters(df: DataFrame, ts: str, variant: str, prediction: str, latency: str,
                   classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Predictions per variant and day, by class, with the latency total."""
    return df.groupBy(variant, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        *[F.count_if(F.col(prediction) == c).alias(f"prediction_{c}") for c in classes],
        F.sum(latency).alias("total_latency"),
    )


def counters_rollup(daily: DataFrame, variant: str, days: int = 7, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Totals of the last ``days`` days up to the newest day."""
    newest = daily.agg(F.max("day").alias("d")).scalar()
    recent = daily.where(F.col("day") > F.date_sub(newest, days))
    return recent.groupBy(variant).agg(
        F.sum("total_predictions").alias("total_predictions"),
        *[F.sum(f"prediction_{c}").alias(f"prediction_{c}") for c in classes],
        ratio(F.sum("total_latency"), F.sum("total_predictions"), 0.0).alias("avg_latency_ms"),
    )


def minimum_sample_gate(df: DataFrame, keys: Sequence[str], minimum: int = 1000) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("enough", F.col("n") >= minimum)


def threshold_check(metrics: DataFrame, required: Mapping[str, float]) -> DataFrame:
    """``(metric, value)`` rows against required minima."""
    need = None
    for name, bound in required.items():
        need = F.when(F.col("metric") == name, bound) if need is None else need.when(F.col("metric") == name, bound)
    out = metrics.withColumn("required", need).where(F.col("required").isNotNull())
    return out.withColumn("status", F.when(F.col("value") >= F.col("required"), "PASS").otherwise("FAIL"))


def best_row(df: DataFrame, by: str, tie: str, keys: Sequence[str] = (), largest: bool = True) -> DataFrame:
    """Row with the best ``by`` per key, ties by the smallest ``tie``; an aggregate, no sort."""
    # ties: order a struct so that the better one is always the minimum
    rank = F.struct((-F.col(by) if largest else F.col(by)).alias("r"), F.col(tie).alias("t"))
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    return df.where(F.col(by).isNotNull()).groupBy(*keys).agg(F.min_by(row, rank).alias("best")).select(*keys, "best.*")


def top_n(df: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(tie)).limit(n)


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """Top rows per key. ``row_number() <= n`` plans a per-task limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def resolution_time(df: DataFrame, opened: str, resolved: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean minutes from ``opened`` to ``resolved``; open rows do not count."""
    minutes = (F.unix_micros(resolved) - F.unix_micros(opened)) / 60e6
    return df.groupBy(*keys).agg(F.avg(minutes).alias("mttr_minutes"), F.count(minutes).alias("resolved"))
