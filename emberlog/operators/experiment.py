"""Experiment assignment and analysis.

Raw rows are only ever aggregated; tests are finished on one row per variant pair.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from emberlog.functions import distributions as dist
from emberlog.functions import special
from emberlog.functions.binning import ratio
from emberlog.operators.ordered import _join_on, exact_percentiles, ordered_running
from emberlog.operators.splits import hash_fraction
from emberlog.operators.stats import best_row, metrics_long, pairs_of

STICKY_SECONDS = 7 * 86400
SEQUENTIAL_FROM = 100

# ---------------------------------------------------------------- assignment


def weighted_choice(u: Column, weights: Mapping[str, float]) -> Column:
    """Variant whose cumulative weight interval holds ``u`` in [0, 1)."""
    total = sum(weights.values())
    names = list(weights)
    out: Column = F.lit(names[-1])
    upto = total
    for name in reversed(names[:-1]):
        upto -= weights[names[names.index(name) + 1]]
        out = F.when(u < round(upto / total, 12), name).otherwise(out)
    return out


def assign_variant(
    df: DataFrame, user: str, experiment: str, weights: Mapping[str, float], out: str = "variant_id"
) -> DataFrame:
    """Deterministic weighted assignment from md5(user + experiment); a pure projection."""
    u = hash_fraction(F.col(user), F.lit(experiment))
    return df.withColumn(out, weighted_choice(u, weights))


def assign_sticky(
    requests: DataFrame,
    assignments: DataFrame,
    user: str,
    ts: str,
    experiment: str,
    weights: Mapping[str, float],
    ttl_seconds: int = STICKY_SECONDS,
) -> DataFrame:
    """Keep a stored assignment ``(user, variant_id, assigned_at)`` while it is younger
    than the TTL, else assign by hash. The stored side has one row per user."""
    known = assignments.select(
        F.col(user).alias("_user"), F.col("variant_id").alias("_stored"), F.col("assigned_at").alias("_at")
    )
    joined = requests.join(known, F.col(user) == F.col("_user"), "left")
    age = F.unix_micros(F.col(ts)) - F.unix_micros("_at")
    alive = F.coalesce((age >= 0) & (age < ttl_seconds * 1_000_000), F.lit(False))
    fresh = weighted_choice(hash_fraction(F.col(user), F.lit(experiment)), weights)
    return joined.withColumns(
        {"variant_id": F.when(alive, F.col("_stored")).otherwise(fresh), "was_sticky": alive}
    ).drop("_user", "_stored", "_at")


def unassigned_users(requests: DataFrame, assignments: DataFrame, user: str) -> DataFrame:
    return requests.select(user).distinct().join(assignments.select(user), user, "left_anti")


def canary_ramp(
    df: DataFrame, user: str, ts: str, experiment: str, start: str, step_days: int,
    steps: Sequence[float] = (0.10, 0.30, 0.50, 1.00),
) -> DataFrame:
    """Share of the challenger grows step by step; a user once moved stays moved."""
    u = hash_fraction(F.col(user), F.lit(experiment))
    step = F.floor(F.date_diff(F.to_date(ts), F.lit(start).cast("date")) / step_days)
    share = F.when(step < 0, 0.0)
    for i, s in enumerate(steps[:-1]):
        share = share.when(step == i, s)
    return df.withColumn("canary_share", share.otherwise(steps[-1])).withColumn(
        "variant_id", F.when(u < F.col("canary_share"), "challenger").otherwise("control")
    )


def split_check(df: DataFrame, weights: Mapping[str, float], variant: str = "variant_id") -> DataFrame:
    """Observed against expected share per variant, with its term of the chi-square fit;
    ``split_fit`` adds them up."""
    counts = df.groupBy(variant).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    weight = None
    for name, w in weights.items():
        share = w / sum(weights.values())
        weight = F.when(F.col(variant) == name, share) if weight is None else weight.when(F.col(variant) == name, share)
    out = counts.withColumns({"share": F.col("n") / total, "expected_share": weight, "_total": total})
    expected = F.col("expected_share") * F.col("_total")
    return out.withColumn("chi_term", (F.col("n") - expected) * (F.col("n") - expected) / expected).drop("_total")


def split_fit(check: DataFrame, weights: Mapping[str, float], alpha: float = 0.05) -> DataFrame:
    """One row on a ``split_check``: chi-square of the whole split, degrees of freedom,
    p-value, and whether the split fits its weights. A variant without rows counts with all
    of its expected rows; rows of a variant without a weight are not judged."""
    total = F.sum(F.when(F.col("expected_share").isNotNull(), F.col("n") / F.nullif(F.col("share"), F.lit(0.0))))
    seen = F.count("expected_share")
    missing = F.coalesce(total / F.nullif(seen, F.lit(0)) * (1 - F.sum("expected_share")), F.lit(0.0))
    degrees = len(weights) - 1
    out = check.agg((F.sum("chi_term") + missing).alias("chi_square")).withColumn("degrees_of_freedom", F.lit(degrees))
    p = dist.chi2_sf(F.col("chi_square"), F.col("degrees_of_freedom").cast("double"))
    return out.withColumn("p_value", p).withColumn("fits", F.col("p_value") >= alpha)


# ---------------------------------------------------------------- mean tests


def moments(long: DataFrame, variant: str = "variant_id", on: Sequence[str] = ("metric",)) -> DataFrame:
    return long.groupBy(*on, variant).agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )


def mean_differences(stats: DataFrame, equal_var: bool = True, variant: str = "variant_id",
                     on: Sequence[str] = ("metric",)) -> DataFrame:
    """t statistic, degrees of freedom, standard error and Cohen's d for every pair."""
    pairs = pairs_of(stats, variant, on)
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    va, vb = F.col("std_a") * F.col("std_a"), F.col("std_b") * F.col("std_b")
    if equal_var:
        df = na + nb - 2
        pooled = F.sqrt(ratio((na - 1) * va + (nb - 1) * vb, df))
        se = pooled * F.sqrt(1 / na + 1 / nb)
        scale = pooled
    else:
        ea, eb = va / na, vb / nb
        se = F.sqrt(ea + eb)
        df = ratio((ea + eb) * (ea + eb), ratio(ea * ea, na - 1) + ratio(eb * eb, nb - 1))
        scale = F.sqrt((va + vb) / 2)
    diff = F.col("mean_a") - F.col("mean_b")

    def over(spread: Column) -> Column:
        """Without any spread a difference is infinitely many spreads wide."""
        return F.when((spread == 0) & (diff != 0), F.signum(diff) * float("inf")).otherwise(ratio(diff, spread))

    return pairs.withColumns({"difference": diff, "df": df, "se": se, "t": over(se), "effect_size": over(scale)})


def _t_finish(alpha: float) -> dict[str, Column]:
    """p-value, critical value and power of pairs as ``mean_differences`` gives them."""
    t, df, d = F.col("t"), F.col("df"), F.col("effect_size")
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    ok = t.isNotNull() & d.isNotNull() & (df > 0)
    nc, endless = d * F.sqrt(na * nb / (na + nb)), F.abs(d) == float("inf")
    pooled_df, finite = na + nb - 2, F.when(endless, 0.0).otherwise(nc)
    limit = F.col("_limit")
    upper = F.when(endless, (nc > 0).cast("double")).otherwise(1 - dist.nct_cdf(limit, pooled_df, finite))
    lower = F.when(endless, (nc < 0).cast("double")).otherwise(dist.nct_cdf(-limit, pooled_df, finite))
    return {
        "p_value": F.when(ok, dist.t_two_sided(t, df)),
        "critical": F.when(ok, dist.t_upper_quantile(alpha / 2, df)),
        "power": F.when(ok, upper),
        "power_two_sided": F.when(ok, upper + lower),
    }


# The four recommendation texts.
INCONCLUSIVE = (
    "INCONCLUSIVE: Need more data (current power: %.2f%%). Recommend collecting %d more samples per variant."
)
NO_DIFFERENCE = (
    "NO SIGNIFICANT DIFFERENCE: Variants perform similarly. "
    "Choose based on other factors (cost, complexity, etc.)"
)
SMALL_EFFECT = (
    "SIGNIFICANT BUT SMALL EFFECT: Difference is statistically significant but effect size (%.4f) "
    "is below minimum threshold ({min_effect}). Consider practical significance."
)
IMPROVEMENT = (
    "SIGNIFICANT IMPROVEMENT: Variant %s is significantly better (effect size: %.4f). "
    "RECOMMEND deploying variant %s."
)

# Fixed value: the rationale of the recommended variant.
RATIONALE = (
    "%s is recommended based on the following:\n  - Best F1 Score: %.4f\n"
    "  - Latency: %.2fms (p95: %.2fms)\n  - Statistically significant improvements in key metrics"
)


def recommendation(min_effect: float) -> Column:
    """The four outcomes; needs is_significant, power, effect_size, difference and n_a."""
    effect, better = F.abs("effect_size"), F.when(F.col("difference") > 0, "A").otherwise("B")
    return (
        F.when(
            ~F.col("is_significant") & (F.col("power") < 0.8),
            F.format_string(
                INCONCLUSIVE,
                F.col("power") * 100, F.floor(F.col("n_a") * 1.5),
            ),
        )
        .when(
            ~F.col("is_significant"),
            NO_DIFFERENCE,
        )
        .when(
            effect < min_effect,
            F.format_string(SMALL_EFFECT.replace("{min_effect}", str(min_effect)), F.col("effect_size")),
        )
        .otherwise(
            F.format_string(IMPROVEMENT, better, effect, better)
        )
    )


def t_tests(
    long: DataFrame, alpha: float = 0.05, equal_var: bool = True, min_effect: float = 0.02,
    variant: str = "variant_id", on: Sequence[str] = ("metric",),
) -> DataFrame:
    """Full test record for every variant pair and metric of a long metrics frame."""
    pairs = mean_differences(moments(long, variant, on), equal_var, variant, on)
    limit = dist.t_upper_quantile(alpha / 2, F.col("n_a").cast("double") + F.col("n_b") - 2)
    done = pairs.withColumn("_limit", limit).withColumns(_t_finish(alpha)).drop("_limit")
    margin = F.col("critical") * F.col("se")
    return done.withColumns(
        {
            "ci_low": F.col("difference") - margin,
            "ci_high": F.col("difference") + margin,
            "is_significant": F.coalesce(F.col("p_value") < alpha, F.lit(False)),
        }
    ).withColumn("recommendation", recommendation(min_effect))


# ---------------------------------------------------------------- counts


def _pair_cells(df: DataFrame, variant: str, category: str) -> DataFrame:
    """Counts ``c_a`` and ``c_b`` of each category (``_k``) for every variant pair, from the
    (variant, category) counts. Categories empty in both arms are left out."""
    counts = (
        df.select(F.col(variant).alias("_v"), F.col(category).alias("_k"))
        .where(F.col("_k").isNotNull())
        .groupBy("_v", "_k")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    totals = counts.groupBy("_v").agg(F.sum("_c").alias("n"))
    arms = totals.agg(F.sort_array(F.collect_list(F.struct(F.col("_v").alias("v"), "n"))).alias("a")).scalar()
    per_category = (
        counts.groupBy("_k")
        .agg(F.map_from_entries(F.collect_list(F.struct("_v", "_c"))).alias("m"))
        .withColumn("arms", arms)
    )
    return (
        per_category.select("_k", "m", "arms", F.posexplode("arms").alias("i", "a"))
        .select("_k", "m", "a", F.explode(F.slice("arms", F.col("i") + 2, F.size("arms"))).alias("b"))
        .select(
            "_k",
            F.col("a.v").alias("variant_a"), F.col("b.v").alias("variant_b"),
            F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"),
            F.coalesce(F.try_element_at("m", F.col("a.v")), F.lit(0)).alias("c_a"),
            F.coalesce(F.try_element_at("m", F.col("b.v")), F.lit(0)).alias("c_b"),
        )
        .where(F.col("c_a") + F.col("c_b") > 0)
    )


def contingency(df: DataFrame, variant: str, category: str) -> DataFrame:
    """The table behind the chi-square of every variant pair: observed and expected counts."""
    cells = _pair_cells(df, variant, category)
    share = (F.col("c_a") + F.col("c_b")) / (F.col("n_a") + F.col("n_b"))
    return cells.select(
        "variant_a", "variant_b", F.col("_k").alias(category), F.col("c_a").alias("observed_a"), F.col("c_b").alias("observed_b"),
        (F.col("n_a") * share).alias("expected_a"), (F.col("n_b") * share).alias("expected_b"),
    )


def chi_square_pairs(df: DataFrame, variant: str, category: str) -> DataFrame:
    """Chi-square statistic, degrees of freedom and Cramer's V for every variant pair; 2x2
    tables get the continuity correction."""
    cells = _pair_cells(df, variant, category)
    sizes = cells.groupBy("variant_a", "variant_b").agg(F.count(F.lit(1)).alias("categories"))
    n = F.col("n_a") + F.col("n_b")
    column_total = F.col("c_a") + F.col("c_b")
    parts = []
    for arm in ("a", "b"):
        expected = F.col(f"n_{arm}") * column_total / n
        off = F.abs(F.col(f"c_{arm}") - expected)
        off = F.when(F.col("categories") == 2, off - F.least(F.lit(0.5), off)).otherwise(off)
        parts.append(off * off / expected)
    return (
        cells.join(sizes, ["variant_a", "variant_b"])
        .groupBy("variant_a", "variant_b")
        .agg(
            F.sum(parts[0] + parts[1]).alias("chi_square"),
            (F.first("categories") - 1).alias("degrees_of_freedom"),
            F.first(n).alias("n"),
        )
        .withColumn("cramers_v", F.sqrt(ratio(F.col("chi_square"), F.col("n"))))
    )


def chi_square_tests(df: DataFrame, variant: str, category: str, alpha: float = 0.05) -> DataFrame:
    out = chi_square_pairs(df, variant, category)
    return out.withColumn("p_value", dist.chi2_sf(F.col("chi_square"), F.col("degrees_of_freedom").cast("double"))).withColumn(
        "is_significant", F.coalesce(F.col("p_value") < alpha, F.lit(False))
    )


# ---------------------------------------------------------------- rank test


def _variants_of(df: DataFrame, variant: str, limit: int = 64) -> list[str]:
    """Names of the arms, at most ``limit`` of them brought to the driver."""
    found = df.select(variant).where(F.col(variant).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} variants: pass the list to compare")
    return sorted(r[0] for r in found)


def rank_sums(
    long: DataFrame, variants: Sequence[str] | None = None, variant: str = "variant_id",
    on: Sequence[str] = ("metric",),
) -> DataFrame:
    """Mann-Whitney U and tie sums for all pairs in one ordered pass.

    Distinct values carry one count per arm. With running counts ``c_b`` of arm b, the
    pair statistic is ``U_a = sum n_a * (c_b - n_b / 2)`` over the values, so no per-pair
    ranking and no join on values is needed.
    """
    on = list(on)
    names = list(variants) if variants is not None else _variants_of(long, variant)
    known = long.where(F.col("value").isNotNull())
    counts = known.groupBy(*on, F.col("value").cast("double").alias("value")).agg(
        *[F.count_if(F.col(variant) == v).alias(f"n{i}") for i, v in enumerate(names)]
    )
    run = ordered_running(counts, on, ["value"], {f"c{i}": F.col(f"n{i}") for i in range(len(names))})
    sums, rows = [], []
    for i in range(len(names)):
        for j in range(i + 1, len(names)):
            tied = (F.col(f"n{i}") + F.col(f"n{j}")).cast("double")
            sums.append(F.sum(F.col(f"n{i}") * (F.col(f"c{j}") - F.col(f"n{j}") / 2.0)).alias(f"u_{i}_{j}"))
            sums.append(F.sum(tied * tied * tied - tied).alias(f"ties_{i}_{j}"))
            rows.append(
                F.struct(
                    F.lit(names[i]).alias("variant_a"), F.lit(names[j]).alias("variant_b"),
                    F.col(f"n_{i}").alias("n_a"), F.col(f"n_{j}").alias("n_b"),
                    F.col(f"u_{i}_{j}").alias("u"), F.col(f"ties_{i}_{j}").alias("ties"),
                )
            )
    sums += [F.max(f"c{i}_total").alias(f"n_{i}") for i in range(len(names))]
    return run.groupBy(*on).agg(*sums).select(*on, F.explode(F.array(*rows)).alias("r")).select(*on, "r.*")


def _exact_u_tail(u: float, m: int, n: int) -> float:
    """P(U >= u) for two untied samples, u at least the middle.

    The shares of rank arrangements by U are the coefficients of the product of
    (1 - q^(n+i)) / (1 - q^i) over the members i of the smaller arm, here scaled to add up
    to one. By symmetry the lower tail is summed, so no more than half of them is needed.
    """
    m, n = min(m, n), max(m, n)
    most = int(np.floor(m * n - u))
    if most < 0:
        return 0.0
    share = np.zeros(most + 1)
    share[0] = 1.0
    for i in range(1, m + 1):
        if n + i <= most:
            share[n + i :] -= share[: most + 1 - n - i].copy()
        padded = np.zeros(-(-(most + 1) // i) * i)
        padded[: most + 1] = share
        share = padded.reshape(-1, i).cumsum(0).ravel()[: most + 1] * (i / (n + i))
    return float(share.sum())


@pandas_udf(T.DoubleType())
def _rank_p(u: pd.Series, ties: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
    out = []
    for ui, ti, m, n in zip(u, ties, na, nb):
        if pd.isna(ui) or m == 0 or n == 0:
            out.append(np.nan)
            continue
        larger = max(ui, m * n - ui)
        if min(m, n) <= 8 and ti == 0:
            out.append(min(1.0, 2 * _exact_u_tail(larger, int(m), int(n))))
            continue
        total = m + n
        spread = np.sqrt(m * n / 12.0 * ((total + 1) - ti / (total * (total - 1))))
        z = (larger - m * n / 2.0 - 0.5) / spread if spread > 0 else 0.0
        out.append(float(np.clip(2 * special.normal_cdf(-z), 0.0, 1.0)))
    return pd.Series(out, dtype=float)


@pandas_udf(T.DoubleType())
def _z_from_p(p: pd.Series, u: pd.Series, ties: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
    """Quantile of p, by its lower tail; straight from U where p is too small to have one."""
    out = []
    for v, ui, ti, m, n in zip(p, u, ties, na, nb):
        if pd.isna(v):
            out.append(np.nan)
        elif v > 1e-290:
            out.append(-special.normal_ppf(v / 2) if v < 1 else 0.0)
        else:
            total = m + n
            spread = np.sqrt(m * n / 12.0 * ((total + 1) - ti / (total * (total - 1))))
            out.append((max(ui, m * n - ui) - m * n / 2.0 - 0.5) / spread)
    return pd.Series(out, dtype=float)


def rank_tests(
    long: DataFrame, alpha: float = 0.05, variants: Sequence[str] | None = None,
    variant: str = "variant_id", on: Sequence[str] = ("metric",),
) -> DataFrame:
    """Mann-Whitney test with effect size ``z / sqrt(N)`` and both medians."""
    medians = exact_percentiles(long, [*on, variant], "value", {"median": 0.5})
    out = rank_sums(long, variants, variant, on).withColumn("p_value", _rank_p("u", "ties", "n_a", "n_b"))
    for arm in ("a", "b"):
        side = medians.select(*on, F.col(variant).alias(f"variant_{arm}"), F.col("median").alias(f"median_{arm}"))
        out = _join_on(out, side, [*on, f"variant_{arm}"], "left")
    return out.withColumns(
        {
            "effect_size": _z_from_p("p_value", "u", "ties", "n_a", "n_b") / F.sqrt(F.col("n_a") + F.col("n_b")),
            "is_significant": F.coalesce(F.col("p_value") < alpha, F.lit(False)),
        }
    )


# ---------------------------------------------------------------- bayesian


def posteriors(df: DataFrame, success: str, variant: str = "variant_id", prior: tuple[float, float] = (1.0, 1.0)) -> DataFrame:
    """Beta posterior per variant from a 0/1 column."""
    return df.groupBy(variant).agg(
        (F.sum(success) + prior[0]).cast("double").alias("alpha"),
        (F.count(success) - F.sum(success) + prior[1]).cast("double").alias("beta"),
    ).withColumn("posterior_mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))


def bayesian_tests(
    df: DataFrame, success: str, variant: str = "variant_id", draws: int = 100_000, chunks: int = 20, seed: int = 42,
    prior: tuple[float, float] = (1.0, 1.0),
) -> DataFrame:
    """P(B > A), expected losses and credible intervals from posterior draws.

    Each (pair, chunk) draws in its own task from a seed of its own, so a lost task
    repeats the same draws.
    """
    pairs = pairs_of(posteriors(df, success, variant, prior), variant)
    work = pairs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).repartition("variant_a", "variant_b", "chunk")

    def draw(batches):
        import zlib

        for batch in batches:
            for row in batch.itertuples(index=False):
                name = f"{row.variant_a}|{row.variant_b}|{row.chunk}"
                rng = np.random.default_rng([seed, zlib.crc32(name.encode())])
                size = draws // chunks + (row.chunk < draws % chunks)
                yield pd.DataFrame(
                    {
                        "variant_a": row.variant_a, "variant_b": row.variant_b,
                        "a": rng.beta(row.alpha_a, row.beta_a, size),
                        "b": rng.beta(row.alpha_b, row.beta_b, size),
                    }
                )

    drawn = work.mapInPandas(draw, "variant_a string, variant_b string, a double, b double")
    better = F.avg((F.col("b") > F.col("a")).cast("int"))
    # a pair has exactly `draws` rows, so its percentile buffer has a fixed size
    out = drawn.groupBy("variant_a", "variant_b").agg(
        better.alias("prob_b_better"),
        F.avg(F.greatest(F.col("b") - F.col("a"), F.lit(0.0))).alias("expected_loss_a"),
        F.avg(F.greatest(F.col("a") - F.col("b"), F.lit(0.0))).alias("expected_loss_b"),
        *[
            F.percentile(arm, p).alias(f"ci_{arm}_{end}")
            for arm in ("a", "b") for end, p in (("low", 0.025), ("high", 0.975))
        ],
        F.avg("a").alias("posterior_mean_a"), F.avg("b").alias("posterior_mean_b"),
    )
    return out.withColumns(
        {
            "prob_a_better": 1 - F.col("prob_b_better"),
            "decision": F.when(F.col("prob_b_better") > 0.95, "B").when(F.col("prob_b_better") < 0.05, "A").otherwise("Inconclusive"),
        }
    )


# ---------------------------------------------------------------- sequential


def prefix_tests(
    long: DataFrame, order: str, variant: str = "variant_id", on: Sequence[str] = ("metric",),
    first: int = SEQUENTIAL_FROM,
) -> DataFrame:
    """Pooled t statistic of every equal prefix ``first <= i < min(n_a, n_b)`` of a pair.

    Running moments by position make this linear in the rows; prefixes of two arms meet
    in an equi-join on (metric, i).
    """
    on = list(on)
    value = F.col("value").cast("double")
    # around each metric's mean, or large values would swallow the spread
    known = long.where(F.col("value").isNotNull()).select(*on, variant, order, "value")
    centers = known.groupBy(*on).agg(F.avg(value).alias("_center"))
    known = _join_on(known, centers, on, "inner").withColumn("value", value - F.col("_center")).drop("_center")
    run = ordered_running(
        known, [*on, variant], [order],
        {"i": F.lit(1).cast("bigint"), "s": value, "ss": value * value},
    )
    i = F.col("i")
    prefixes = run.where((i >= first) & (i < F.col("i_total"))).select(
        *on, variant, "i", F.col("i_total").alias("n"), (F.col("s") / i).alias("mean"),
        ((F.col("ss") - F.col("s") * F.col("s") / i) / (i - 1)).alias("var"),
    )
    pairs = pairs_of(prefixes, variant, [*on, "i"]).where(i < F.least("n_a", "n_b"))
    se = F.sqrt((F.col("var_a") + F.col("var_b")) / i)
    return pairs.select(
        *on, "variant_a", "variant_b", "n_a", "n_b", "i", ratio(F.col("mean_a") - F.col("mean_b"), se).alias("t")
    )


# The two outcomes of a sequential test.
STOPPED, GOES_ON = "Significant difference detected", "Need more data"


def _t_expansion(z: float, df: Column) -> Column:
    """Quantile of t at the normal quantile ``z``, up to the third power of 1 / df."""
    a, b = (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96
    c = (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384
    return F.lit(z) + a / df + b / (df * df) + c / (df * df * df)


def sequential_tests(
    long: DataFrame, order: str, alpha: float = 0.05, looks_divisor: float = 2.0,
    variant: str = "variant_id", on: Sequence[str] = ("metric",),
) -> DataFrame:
    """First prefix significant at ``alpha / looks_divisor``, else the last p-value.

    Whether a prefix is significant is read off an expansion of the t quantile; only where t
    lies within a millionth of it a p-value decides. Otherwise p-values are computed for the
    stopping prefix and the last one only.
    """
    on = list(on)
    level = alpha / looks_divisor
    keys = [*on, "variant_a", "variant_b"]
    tests = prefix_tests(long, order, variant, on)
    last = F.col("i") == F.least("n_a", "n_b") - 1
    size, df = F.abs("t"), (2 * F.col("i") - 2).cast("double")
    limit = _t_expansion(special.normal_ppf(1 - level / 2), df)
    # the expansion's error is of order df^-4
    clear = F.col("i") >= 100
    doubtful = ~clear | (F.abs(size / limit - 1) < 1e-6)
    hit = F.when(doubtful, dist.t_two_sided(F.col("t"), df) < level).otherwise(size >= limit)
    decided = tests.withColumn("_hit", F.when(hit, F.col("i"))).groupBy(*keys).agg(
        F.min("_hit").alias("stop_at"), F.min_by("t", "_hit").alias("_stop_t"), F.max(F.when(last, F.col("t"))).alias("_last_t"),
    )
    p_at = lambda t, i: dist.t_two_sided(F.col(t), (2 * i - 2).cast("double"))
    sizes = pairs_of(
        long.where(F.col("value").isNotNull()).groupBy(*on, variant).agg(F.count(F.lit(1)).alias("n")), variant, on
    )
    out = _join_on(sizes, decided, keys, "left")
    stop = F.col("stop_at").isNotNull()
    return out.select(
        *keys,
        F.coalesce("stop_at", F.least("n_a", "n_b")).alias("sample_size"),
        F.when(stop, p_at("_stop_t", F.col("stop_at"))).otherwise(p_at("_last_t", F.least("n_a", "n_b") - 1)).alias("p_value"),
        stop.alias("stop"),
        F.when(stop, STOPPED).otherwise(GOES_ON).alias("reason"),
    )


# ---------------------------------------------------------------- sample size


def required_n(rate: Column, mde: Column, alpha: float = 0.05, power: float = 0.8) -> Column:
    z = special.normal_ppf(1 - alpha / 2) + special.normal_ppf(power)
    return required_n_for(rate, mde, F.lit(z))


def required_n_for(rate: Column, mde: Column, z_sum: Column) -> Column:
    """Samples per variant for a relative effect ``mde`` on a base ``rate``."""
    other = rate * (1 + mde)
    pooled = (rate + other) / 2
    gap = other - rate
    return F.ceil(ratio(z_sum * z_sum * 2 * pooled * (1 - pooled), gap * gap))


def sample_size_by_segment(df: DataFrame, segment: str, success: str, mde: float = 0.1, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    rates = df.groupBy(segment).agg(F.count(success).alias("n"), F.avg(success).alias("baseline_rate"))
    return rates.withColumn("required", required_n(F.col("baseline_rate"), F.lit(mde), alpha, power)).withColumn(
        "adequate", F.col("n") >= F.col("required")
    )


def achieved_power(df: DataFrame, n: str, rate: str, mde: float, alpha: float = 0.05) -> DataFrame:
    """Normal-approximation power of ``n`` samples per variant."""
    other = F.col(rate) * (1 + mde)
    pooled = (F.col(rate) + other) / 2
    z = F.abs(other - F.col(rate)) / F.sqrt(2 * pooled * (1 - pooled) / F.col(n))
    return df.withColumn("power", 1 - dist.normal_cdf(F.lit(special.normal_ppf(1 - alpha / 2)) - z))


# The effect and power steps of the planning table.
PLAN_MDE = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30)
PLAN_POWER = (0.80, 0.85, 0.90, 0.95)


def power_grid(rates: DataFrame, rate: str, alpha: float = 0.05) -> DataFrame:
    """Required sizes for every effect and power step, per row of ``rates``."""
    steps = F.array(*[
        F.struct(F.lit(int(round(p * 100))).alias("power_pct"),
                 F.lit(special.normal_ppf(1 - alpha / 2) + special.normal_ppf(p)).alias("z"))
        for p in PLAN_POWER
    ])
    effects = F.array(*[F.struct(F.lit(int(round(m * 100))).alias("mde_pct"), F.lit(m).alias("m")) for m in PLAN_MDE])
    grid = rates.withColumn("e", F.explode(effects)).withColumn("s", F.explode(steps))
    n = required_n_for(F.col(rate), F.col("e.m"), F.col("s.z"))
    return grid.withColumns({"mde_pct": F.col("e.mde_pct"), "power_pct": F.col("s.power_pct"), "n_per_variant": n}).withColumn(
        "n_total", 2 * F.col("n_per_variant")
    ).drop("e", "s")


# ---------------------------------------------------------------- reports


def variant_summary(df: DataFrame, metrics: Sequence[str], variant: str = "variant_id") -> DataFrame:
    """n, mean, std, median, p95 and p99 per (variant, metric)."""
    long = metrics_long(df, [variant], metrics)
    base = moments(long, variant)
    cuts = exact_percentiles(long, ["metric", variant], "value", {"median": 0.5, "p95": 0.95, "p99": 0.99})
    return _join_on(base, cuts, ["metric", variant], "left")


def best_variant(df: DataFrame, variant: str = "variant_id", quality: str = "f1_score", latency: str = "latency_ms") -> DataFrame:
    """Winner by ``100 * mean(quality) - 0.1 * mean(latency)``, with a rationale."""
    means = df.groupBy(variant).agg(F.avg(quality).alias("quality"), F.avg(latency).alias("latency"))
    scored = means.withColumn("score", F.col("quality") * 100 - F.col("latency") * 0.1)
    winner = best_row(scored, "score", variant)
    p95 = exact_percentiles(df, [variant], latency, {"p95": 0.95})
    return _join_on(winner, p95, [variant], "left").withColumn(
        "rationale",
        F.format_string(
            RATIONALE,
            F.col(variant), F.col("quality"), F.col("latency"), F.col("p95"),
        ),
    )


def experiment_report(
    df: DataFrame, metrics: Sequence[str] = ("f1_score", "accuracy", "latency_ms"), variant: str = "variant_id",
    alpha: float = 0.05,
) -> dict[str, DataFrame]:
    """Tables of the full report, to be written as JSON side by side."""
    return {
        "variant_summary": variant_summary(df, metrics, variant),
        "pairwise_tests": t_tests(metrics_long(df, [variant], metrics), alpha, variant=variant),
        "recommendation": best_variant(df, variant),
    }


def gauge_winner(gauges: DataFrame, variant: str, value: str, limit: float = 0.02) -> DataFrame:
    """Pairwise gauge difference, whether it is above ``limit``, and the leader."""
    pairs = pairs_of(gauges.select(variant, F.col(value).alias("g")), variant)
    return pairs.select(
        "variant_a", "variant_b", F.abs(F.col("g_a") - F.col("g_b")).alias("difference"),
        (F.abs(F.col("g_a") - F.col("g_b")) > limit).alias("significant"),
        F.when(F.col("g_a") >= F.col("g_b"), F.col("variant_a")).otherwise(F.col("variant_b")).alias("leader"),
    )
