"""Rates, quantiles and rule checks over labelled metric samples.

Samples are rows ``(ts, <labels...>, value)``; ``series`` names the label columns that
identify one series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.functions.binning import ratio
from emberlog.operators.ordered import _join_on, ordered_running, with_lags
from emberlog.operators.stats import top_n_per_key
from emberlog.session import stored


def counter_deltas(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value", tie: str | None = None) -> DataFrame:
    """Growth since the previous sample of the series; a drop is a restart from 0."""
    order = [ts] if tie is None else [ts, tie]
    lagged = with_lags(samples, series, order, {"_prev": (value, 1)}, tie=tie)
    grown = F.when(F.col(value) >= F.col("_prev"), F.col(value) - F.col("_prev")).otherwise(F.col(value))
    return lagged.withColumn("delta", F.when(F.col("_prev").isNotNull(), grown)).drop("_prev")


def counter_increase(
    samples: DataFrame, series: Sequence[str], width: str, by: Sequence[str] | None = None,
    ts: str = "ts", value: str = "value", tie: str | None = None,
) -> DataFrame:
    """Increase per window, summed over series to the ``by`` labels."""
    by = list(series if by is None else by)
    deltas = counter_deltas(samples, series, ts, value, tie)
    return deltas.groupBy(F.window(ts, width).start.alias("window_start"), *by).agg(
        F.coalesce(F.sum("delta"), F.lit(0.0)).alias("increase")
    )


def counter_rate(
    samples: DataFrame, series: Sequence[str], seconds: int, by: Sequence[str] | None = None,
    ts: str = "ts", value: str = "value", tie: str | None = None,
) -> DataFrame:
    """Per-second rate per window of ``seconds``."""
    grown = counter_increase(samples, series, f"{seconds} seconds", by, ts, value, tie)
    return grown.withColumn("rate", F.col("increase") / seconds)


def rate_share(rates: DataFrame, label: str) -> DataFrame:
    """Each label's part of the window total."""
    total = F.sum("rate").over(Window.partitionBy("window_start"))
    return rates.groupBy("window_start", label).agg(F.sum("rate").alias("rate")).withColumn(
        "share", ratio(F.col("rate"), total)
    )


def rate_ratio(top: DataFrame, bottom: DataFrame, on: Sequence[str], out: str) -> DataFrame:
    """Ratio of two rates (mean latency, success rate); NULL on an empty denominator."""
    left = top.select(*on, F.col("rate").alias("_top"))
    right = bottom.select(*on, F.col("rate").alias("_bottom"))
    joined = _join_on(right, left, list(on), "left")
    return joined.select(*on, ratio(F.col("_top"), F.col("_bottom")).alias(out))


# Upper bounds of the latency histogram, in seconds.
LATENCY_BUCKETS = (0.1, 0.25, 0.5, 1.0, 2.5, 5.0)


def bucket_counts(df: DataFrame, keys: Sequence[str], value: str, bounds: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative histogram rows ``(keys, le, n)`` including the infinite bucket."""
    edges = [*bounds, float("inf")]
    wide = df.groupBy(*keys).agg(*[F.count_if(F.col(value) <= le).alias(f"c{i}") for i, le in enumerate(edges)])
    return wide.select(
        *keys,
        F.explode(F.array(*[F.struct(F.lit(le).alias("le"), F.col(f"c{i}").alias("n")) for i, le in enumerate(edges)])).alias("b"),
    ).select(*keys, "b.*")


def histogram_quantiles(buckets: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """Quantiles from cumulative buckets, linear inside the bucket that reaches the rank.

    A rank in the infinite bucket gives the highest finite bound; the first bucket
    starts at 0. One row per bound and key is ordered, never the observations, and all
    quantiles are read from the same ladder.
    """
    ladder = buckets.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("le", "n"))).alias("b"))

    def at_rank(q: float) -> Column:
        rank = F.lit(q) * F.element_at("b", -1)["n"]
        at = F.size(F.filter("b", lambda x: x["n"] < rank))
        here, below = F.get("b", at), F.get("b", at - 1)
        low = F.when(at == 0, 0.0).otherwise(below["le"])
        seen = F.when(at == 0, F.lit(0)).otherwise(below["n"])
        inside = low + (here["le"] - low) * ratio(rank - seen, here["n"] - seen)
        return (
            F.when(F.element_at("b", -1)["n"] == 0, F.lit(None).cast("double"))
            .when(here["le"] == float("inf"), below["le"]).otherwise(inside)
        )

    return ladder.select(*keys, *[at_rank(q).alias(name) for name, q in quantiles.items()])


def histogram_quantile(buckets: DataFrame, keys: Sequence[str], q: float, out: str = "quantile") -> DataFrame:
    """One quantile of ``histogram_quantiles``."""
    return histogram_quantiles(buckets, keys, {out: q})


@dataclass(frozen=True)
class Rule:
    alert: str
    metric: str
    op: str
    threshold: float
    for_seconds: int
    severity: str
    team: str


# The alert rules.
RULES = (
    Rule("ModelAccuracyDegraded", "model_accuracy", "<", 0.85, 1800, "critical", "ml-ops"),
    Rule("HighLatency", "latency_p95_us", ">", 1_000_000, 300, "warning", "ml-ops"),
    Rule("HighErrorRate", "error_rate", ">", 0.05, 600, "critical", "ml-ops"),
    Rule("DataDriftDetected", "feature_drift_psi", ">", 0.3, 3600, "warning", "ml-ops"),
    Rule("AnomalyRateSpike", "anomaly_rate", ">", 0.10, 1800, "info", "operations"),
    Rule("GPUMemoryHigh", "gpu_memory_share", ">", 0.90, 900, "warning", "infrastructure"),
    Rule("PodCrashLooping", "restart_rate", ">", 0.0, 300, "critical", "infrastructure"),
)


def check_rules(samples: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every sample against every rule of its metric; adds the rule and ``active``.

    The rule list is a literal array filtered by metric, so a sample is expanded only to
    its own rules.
    """
    table = F.array(
        *[
            F.struct(
                F.lit(r.alert).alias("alertname"), F.lit(r.metric).alias("m"), F.lit(r.op).alias("op"),
                F.lit(float(r.threshold)).alias("threshold"), F.lit(r.for_seconds).alias("for_seconds"),
                F.lit(r.severity).alias("severity"), F.lit(r.team).alias("team"),
            )
            for r in rules
        ]
    )
    expanded = samples.withColumn("_r", F.explode(F.filter(table, lambda r: r["m"] == F.col("metric"))))
    v, limit, op = F.col("value"), F.col("_r.threshold"), F.col("_r.op")
    active = (
        F.when(op == ">", v > limit).when(op == "<", v < limit).when(op == ">=", v >= limit)
        .when(op == "<=", v <= limit).otherwise(v == limit)
    )
    return expanded.select(
        *samples.columns, "_r.alertname", "_r.threshold", "_r.for_seconds", "_r.severity", "_r.team",
        F.coalesce(active, F.lit(False)).alias("active"),
    )


def held_alerts(checked: DataFrame, series: Sequence[str], ts: str = "ts") -> DataFrame:
    """Alerts whose condition held for ``for_seconds`` without a break.

    Each unbroken run of active samples gets a number from a running count of its
    starts; the run fires at its first sample at least ``for_seconds`` after the start.
    One row per fired run: ``started_at, fired_at, ended_at``.
    """
    keys = ["alertname", "severity", "team", *series]
    narrow = stored(checked.select(*keys, ts, "for_seconds", F.col("active").cast("int").alias("_on")))
    marked = with_lags(narrow, keys, [ts], {"_was": ("_on", 1)})
    start = ((F.col("_on") == 1) & (F.coalesce("_was", F.lit(0)) == 0)).cast("int")
    runs = ordered_running(stored(marked.withColumn("_start", start)), keys, [ts], {"_run": F.col("_start")})
    active = stored(runs.where(F.col("_on") == 1).select(*keys, ts, "for_seconds", "_run"))
    bounds = active.groupBy(*keys, "_run").agg(F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"))
    timed = _join_on(active, bounds, [*keys, "_run"])
    held = F.unix_micros(ts) - F.unix_micros("started_at") >= F.col("for_seconds").cast("bigint") * 1_000_000
    return timed.where(held).groupBy(*keys, "_run", "started_at", "ended_at").agg(F.min(ts).alias("fired_at")).drop("_run")


def latest_gauges(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Newest value per series; an aggregate instead of a window."""
    return samples.groupBy(*series).agg(F.max_by(value, ts).alias(value), F.max(ts).alias(ts))


def model_table(samples: DataFrame, model: str, metric: str, metrics: Sequence[str], ts: str = "ts") -> DataFrame:
    """Latest gauges as one row per model with a column per metric."""
    newest = latest_gauges(samples, [model, metric], ts)
    return newest.groupBy(model).pivot(metric, list(metrics)).agg(F.first("value"))


def latest_runs(runs: DataFrame, keys: Sequence[str], started: str, tie: str, n: int = 1) -> DataFrame:
    return top_n_per_key(runs, keys, [F.desc(started), F.asc(tie)], n).drop("rank")
