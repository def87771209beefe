import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.functions import special
from emberlog.operators import experiment as ex
from emberlog.operators import splits as sp
from emberlog.operators import stats as st
from emberlog.operators.evaluate import evaluate_models

# Published planning table: (effect %, power %) -> samples per variant at a 10 % base rate.
PLAN = {
    (5, 80): 57764, (5, 85): 66077, (5, 90): 77330, (5, 95): 95635,
    (10, 80): 14752, (10, 85): 16875, (10, 90): 19749, (10, 95): 24424,
    (15, 80): 6694, (15, 85): 7658, (15, 90): 8962, (15, 95): 11083,
    (20, 80): 3843, (20, 85): 4395, (20, 90): 5144, (20, 95): 6361,
    (25, 80): 2508, (25, 85): 2869, (25, 90): 3358, (25, 95): 4152,
    (30, 80): 1776, (30, 85): 2031, (30, 90): 2377, (30, 95): 2939,
}


def test_special_functions():
    assert special.t_two_sided(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert special.t_ppf(0.975, np.array([1.0, 10.0, 30.0])) == pytest.approx([12.7062047, 2.2281389, 2.0422725], abs=1e-6)
    assert special.chi2_sf([3.8414588, 18.3070381, 0.0], [1, 10, 3]) == pytest.approx([0.05, 0.05, 1.0], abs=1e-7)
    assert special.nct_cdf(1.3, 7, 0.0)[0] == pytest.approx(float(special.t_cdf(1.3, 7)), abs=1e-8)
    assert special.normal_cdf(1.959963985) == pytest.approx(0.975, abs=1e-9)
    assert special.beta_inc(2, 3, 0.4) == pytest.approx(0.5248, abs=1e-9)


def test_power_grid_equals_published_table(spark):
    grid = ex.power_grid(spark.createDataFrame([(0.10,)], "p double"), "p").collect()
    assert {(r.mde_pct, r.power_pct): r.n_per_variant for r in grid} == PLAN
    assert all(r.n_total == 2 * r.n_per_variant for r in grid)


def long_frame(spark, groups):
    rows = [(v, "m", i, float(x)) for v, xs in groups.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "variant_id string, metric string, row_id int, value double")


def test_t_test_by_hand(spark):
    r = ex.t_tests(long_frame(spark, {"a": [1, 2, 3, 4, 5], "b": [2, 4, 6, 8, 10]})).first()
    assert r.t == pytest.approx(-3 / math.sqrt(2.5), rel=1e-9)
    assert r.p_value == pytest.approx(0.0943498, abs=1e-5)
    assert not r.is_significant and r.power < 0.01  # one-sided power of a negative effect
    assert r.power_two_sided > 0.3
    assert r.recommendation.startswith("INCONCLUSIVE: Need more data (current power: ")
    assert "collecting 7 more samples" in r.recommendation
    assert r.ci_low < -3 < r.ci_high


def test_t_test_edge_groups(spark):
    got = ex.t_tests(long_frame(spark, {"a": [1.0], "b": [1.0, 1.0], "c": [5.0, 5.0]})).collect()
    # one row has no spread to test with; two constant arms with different means differ for sure
    assert {(r.variant_a, r.variant_b): r.is_significant for r in got} == {("a", "b"): False, ("a", "c"): False, ("b", "c"): True}


def test_significant_recommendation(spark):
    rng = np.random.default_rng(1)
    r = ex.t_tests(long_frame(spark, {"a": rng.normal(5, 1, 400), "b": rng.normal(4, 1, 400)})).first()
    assert r.is_significant and r.power > 0.99
    assert r.recommendation.startswith("SIGNIFICANT IMPROVEMENT: Variant A is significantly better")


def test_rank_test_exact_and_ties(spark):
    r = ex.rank_tests(long_frame(spark, {"a": [1, 2, 3], "b": [4, 5, 6]})).first()
    assert (r.u, r.p_value) == (0.0, pytest.approx(0.1))
    tied = ex.rank_tests(long_frame(spark, {"a": [1.0] * 5, "b": [1.0] * 4})).first()
    assert tied.u == 10.0 and tied.p_value == 1.0


def test_chi_square_by_hand(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 20 + [("b", "y")] * 10
    r = ex.chi_square_tests(spark.createDataFrame(rows, "v string, c string"), "v", "c").first()
    assert r.chi_square == pytest.approx(4 * 4.5**2 / 15) and r.degrees_of_freedom == 1
    assert r.p_value == pytest.approx(0.0201, abs=1e-4)
    zero = ex.chi_square_tests(spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "v string, c string"), "v", "c")
    assert zero.first().chi_square >= 0


def test_bayes(spark):
    rows = [("a", int(i < 30)) for i in range(100)] + [("b", int(i < 60)) for i in range(100)]
    df = spark.createDataFrame(rows, "variant_id string, s int")
    r = ex.bayesian_tests(df, "s").first()
    again = ex.bayesian_tests(df, "s").first()
    assert r.prob_b_better > 0.99 and r.decision == "B" and r.prob_b_better == again.prob_b_better
    assert r.posterior_mean_a == pytest.approx(31 / 102, abs=2e-3)
    assert r.ci_a_low < 31 / 102 < r.ci_a_high and r.expected_loss_b < r.expected_loss_a


def brute_sequential(a, b, alpha=0.05):
    last = None
    for i in range(100, min(len(a), len(b))):
        x, y = a[:i], b[:i]
        t = (x.mean() - y.mean()) / math.sqrt((x.var(ddof=1) + y.var(ddof=1)) / i)
        last = float(special.t_two_sided(t, 2 * i - 2))
        if last < alpha / 2:
            return i, last, True
    return min(len(a), len(b)), last, False


@pytest.mark.parametrize("shift", [0.0, 0.25, 3.0])
def test_sequential_equals_loop(spark, shift):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0, 1, 320), rng.normal(shift, 1, 300)
    r = ex.sequential_tests(long_frame(spark, {"a": a, "b": b}), "row_id").first()
    n, p, stop = brute_sequential(a, b)
    assert (r.sample_size, r.stop) == (n, stop) and r.p_value == pytest.approx(p, abs=1e-9)


def test_sequential_short(spark):
    r = ex.sequential_tests(long_frame(spark, {"a": range(50), "b": range(60)}), "row_id").first()
    assert (r.sample_size, r.stop, r.p_value, r.reason) == (50, False, None, "Need more data")


def test_assignment_is_sticky_and_weighted(spark):
    users = spark.range(20000).select(F.col("id").cast("string").alias("u"))
    weights = {"a": 0.7, "b": 0.2, "c": 0.1}
    one = ex.assign_variant(users, "u", "x", weights)
    shares = {r.variant_id: r["count"] / 20000 for r in one.groupBy("variant_id").count().collect()}
    assert all(abs(shares[v] - w) < 0.02 for v, w in weights.items())
    two = ex.assign_variant(users, "u", "x", weights)
    assert one.exceptAll(two).count() == 0


def test_expired_assignment(spark):
    requests = spark.createDataFrame([("u", "2024-01-08 00:00:00"), ("u", "2024-01-07 23:59:59")], "u string, t string").select(
        "u", F.col("t").cast("timestamp").alias("t")
    )
    stored = spark.createDataFrame([("u", "old", "2024-01-01 00:00:00")], "u string, variant_id string, a string").select(
        "u", "variant_id", F.col("a").cast("timestamp").alias("assigned_at")
    )
    got = ex.assign_sticky(requests, stored, "u", "t", "e", {"new": 1.0}).orderBy("t").collect()
    assert [r.variant_id for r in got] == ["old", "new"]


def test_split_sizes_are_exact(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    got = sp.stratified_split(df, "id", "label", {"train": 0.7, "val": 0.15, "test": 0.15})
    counts = {(r.label, r.split): r["count"] for r in got.groupBy("label", "split").count().collect()}
    assert counts == {(0, "train"): 630, (0, "val"): 135, (0, "test"): 135, (1, "train"): 70, (1, "val"): 15, (1, "test"): 15}
    folds = sp.stratified_folds(df, "id", "label", 3).groupBy("label", "fold").count().collect()
    assert max(r["count"] for r in folds if r.label == 0) - min(r["count"] for r in folds if r.label == 0) <= 1


def test_metrics_edges(spark):
    rows = [("none", 1, 0, 0.2), ("none", 0, 0, 0.2), ("one", 1, 1, 0.9), ("one", 1, 1, 0.8)]
    got = {r.model: r for r in evaluate_models(spark.createDataFrame(rows, "model string, label int, prediction int, score double")).collect()}
    assert (got["none"].precision, got["none"].f1_score, got["none"].auc_roc) == (0.0, 0.0, 0.5)
    assert got["one"].auc_roc is None and got["one"].recall == 1.0


def test_auc_is_rank_invariant(spark):
    df = spark.range(500).select(
        F.lit("m").alias("model"), (F.col("id") % 3 == 0).cast("int").alias("label"),
        F.lit(0).alias("prediction"), ((F.col("id") * 7919) % 101 / 101).alias("score"),
    )
    a = evaluate_models(df).first().auc_roc
    b = evaluate_models(df.withColumn("score", F.exp(5 * F.col("score")))).first().auc_roc
    assert a == pytest.approx(b)


def test_best_row_tie(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "m string, s double")
    assert st.best_row(df, "s", "m").first().m == "a"


def test_special_functions_at_large_parameters():
    from emberlog.functions import special

    assert abs(special.t_two_sided([1.959963984540054], [1e13])[0] - 0.05) < 1e-9
    assert abs(special.t_two_sided([1.96], [9.9e5])[0] - special.t_two_sided([1.96], [1.01e6])[0]) < 1e-8
    # the median lies two thirds below k
    assert abs(special.chi2_sf([1e7], [1e7])[0] - (0.5 - 2 / 3 / np.sqrt(4 * np.pi * 1e7))) < 1e-9
    for shift in (-300.0, 0.0, 0.5, 400.0):
        near, far = (special.chi2_sf([k + shift], [k])[0] for k in (9999.0, 10001.0))
        assert abs(near - far) < 1e-4


def test_exact_rank_tail_has_no_size_switch():
    from itertools import combinations

    from emberlog.operators.experiment import _exact_u_tail

    m, n = 4, 7
    us = [sum(x) - m * (m + 1) // 2 for x in combinations(range(1, m + n + 1), m)]
    for u in range(m * n // 2, m * n + 1):
        assert abs(_exact_u_tail(u, m, n) - sum(x >= u for x in us) / len(us)) < 1e-12
    assert abs(_exact_u_tail(5 * 395 * 0.8, 5, 395) - _exact_u_tail(5 * 396 * 0.8, 5, 396)) < 1e-4


def test_no_spread_gives_an_infinite_statistic(spark):
    from emberlog.operators.experiment import t_tests

    rows = [("m", "A", 1.0)] * 5 + [("m", "B", 2.0)] * 5
    r = t_tests(spark.createDataFrame(rows, "metric string, variant_id string, value double")).first()
    assert r.t == float("-inf") and r.p_value == 0.0 and r.is_significant


def test_prefix_statistics_of_large_values(spark):
    from emberlog.operators.experiment import prefix_tests

    rng = np.random.default_rng(0)
    rows = [("m", v, i, 1e9 + float(x)) for v, shift in (("A", 0.0), ("B", 1.0)) for i, x in enumerate(rng.normal(shift, 1, 60))]
    frame = spark.createDataFrame(rows, "metric string, variant_id string, i long, value double")
    for r in prefix_tests(frame.withColumnRenamed("i", "at"), "at", first=20).collect():
        a, b = (np.array([x[3] for x in rows if x[1] == v][: r.i]) - 1e9 for v in "AB")
        want = (a.mean() - b.mean()) / np.sqrt((a.var(ddof=1) + b.var(ddof=1)) / r.i)
        assert abs(r.t - want) < 1e-3 * abs(want) + 1e-4
