"""Drift from mergeable sketches: a row for each (feature, hour), merged for any range.

A row holds a quantile sketch (KLL) and the moments of that hour's values. The table is
written by period (day or month): a new one costs a pass over its own rows, and a baseline of any length is
merged from rows of sketches. A rank read off a sketch of size ``k`` is off by
``rank_error(k)`` at most (with 99% confidence, however often it was merged), which bounds
the shares of the bins and so the score; ``psi_margin`` says by how much. Sketches draw at
random, so two builds agree within that bound, not digit for digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.drift import EPSILON, psi_band
from emberlog.operators.ordered import _join_on

SKETCH_SIZE = 2000


def rank_error(k: int) -> float:
    """Largest error of a share between two ranks (99% confidence) of a sketch of size k."""
    return 2.446 / k**0.9433


def hourly_sketches(df: DataFrame, ts: str, feature: str = "feature", value: str = "value", k: int = SKETCH_SIZE) -> DataFrame:
    """feature, day, hour, sketch, n, mean and m2 (squared deviations) of the non-null values."""
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    v = F.col(value).cast("double")
    return known.groupBy(feature, F.to_date(ts).alias("day"), F.hour(ts).alias("hour")).agg(
        F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"), F.count(v).alias("n"), F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(v)).alias("m2"),
    )


def write_sketches(sketches: DataFrame, path: str, period: str = "day") -> None:
    """Periods (``day`` or ``month``) in ``sketches`` replace what is stored of them; others
    are not touched."""
    placed = sketches.withColumn("period", F.trunc("day", "month") if period == "month" else F.col("day"))
    writer = placed.repartition("period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("period").parquet(path)


def read_sketches(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Days from ``first`` to ``last``, both included; files of other periods are not read."""
    out = spark.read.parquet(path)
    if first is not None:
        day = F.lit(first).cast("date")
        out = out.where((F.col("day") >= day) & (F.col("period") >= F.trunc(day, "month")))
    if last is not None:
        day = F.lit(last).cast("date")
        out = out.where((F.col("day") <= day) & (F.col("period") <= day))
    return out.drop("period")


def merged(sketches: DataFrame, feature: str = "feature") -> DataFrame:
    """feature, sketch, n, mean and std of all rows of a feature together."""
    # deviations from the common mean: those inside the rows and those between them
    total, centre = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    out = sketches.groupBy(feature).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), total.alias("n"), centre.alias("mean"), F.sum("m2").alias("_inside"),
        F.collect_list(F.struct("n", "mean")).alias("_parts"),
    )
    # a row for each hour: bounded by the range asked for
    between = F.aggregate("_parts", F.lit(0.0), lambda s, p: s + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")))
    std = F.when(F.col("n") > 1, F.sqrt((F.col("_inside") + between) / (F.col("n") - 1)))
    return out.select(feature, "sketch", "n", "mean", std.alias("std"))


def _shares(sketch: str, feature: str, edges: dict) -> Column:
    """Share of the values in each bin that a feature's edges cut; a value on an edge lies
    below. Ranks are asked for literals only, so each feature has a branch of its own."""
    ranks = [
        F.when(F.col(feature).eqNullSafe(F.lit(name)), F.kll_sketch_get_rank_double(F.col(sketch), F.array(*map(F.lit, cuts))))
        for name, cuts in edges.items()
    ]
    bounds = F.concat(F.array(F.lit(0.0)), F.coalesce(*ranks), F.array(F.lit(1.0)))
    return F.transform(F.sequence(F.lit(1), F.size(bounds) - 1), lambda i: F.greatest(F.get(bounds, i) - F.get(bounds, i - 1), F.lit(EPSILON)))


def _psi_term(p: Column, q: Column) -> Column:
    return (p - q) * F.ln(p / q)


def sketch_drift(baseline: DataFrame, current: DataFrame, feature: str = "feature", bins: int = 10, k: int = SKETCH_SIZE) -> DataFrame:
    """PSI and KL divergence per feature from two ``merged`` tables, with ``psi_margin``, how
    far the exact score of these bins can lie from ``psi``."""
    cuts = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    base = baseline.select(feature, F.col("sketch").alias("_base"), F.col("n").alias("n_base"))
    # a row for each feature
    edges = {r[0]: r[1] for r in base.select(feature, F.kll_sketch_get_quantile_double(F.col("_base"), cuts)).collect()}
    if not edges:
        edges = {None: [0.0] * (bins - 1)}
    both = _join_on(base, current.select(feature, F.col("sketch").alias("_now"), F.col("n").alias("n_now")), [feature])
    shares = both.withColumn("_pq", F.arrays_zip(_shares("_base", feature, edges).alias("p"), _shares("_now", feature, edges).alias("q")))
    total = lambda term: F.aggregate("_pq", F.lit(0.0), lambda s, b: s + term(b["p"], b["q"]))
    off = F.lit(rank_error(k))

    def widest(p: Column, q: Column) -> Column:
        """The term is convex in both shares: it is largest at a corner, and least at one too
        unless both shares can agree, where it is 0."""
        low = lambda c: F.greatest(c - off, F.lit(EPSILON))
        corners = [_psi_term(a, b) for a in (low(p), p + off) for b in (low(q), q + off)]
        meet = F.when(F.abs(p - q) <= 2 * off, _psi_term(p, q)).otherwise(0.0)
        return F.greatest(*[F.abs(c - _psi_term(p, q)) for c in corners], meet)

    out = shares.select(
        feature, "n_base", "n_now", total(_psi_term).alias("psi"), total(lambda p, q: q * F.ln(q / p)).alias("kl_divergence"),
        total(widest).alias("psi_margin"),
    )
    return out.withColumn("band", psi_band(F.col("psi")))
