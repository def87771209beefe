"""Distribution expressions against the numeric functions and known values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.functions import distributions as di
from emberlog.functions import special as sp


def values(spark, rows, schema, column):
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], schema)
    return np.array([r[0] for r in df.select(column.alias("v")).collect()])


def test_normal(spark):
    x = [-9.0, -3.3, -1.0, -1e-3, 0.0, 0.5, 1.96, 5.0]
    got = values(spark, [(v,) for v in x], "x double", di.normal_cdf(F.col("x")))
    assert np.allclose(got, sp.normal_cdf(np.array(x)), rtol=1e-11, atol=1e-18)


def test_t_tails_and_quantiles(spark):
    rows = [(t, d) for t in (0.0, 0.3, 1.7, 4.0, 12.0) for d in (1, 1.7, 3, 9.5, 40, 2500, 1e6, 1e13)]
    got = values(spark, rows, "t double, d double", di.t_two_sided(F.col("t"), F.col("d")))
    want = sp.t_two_sided(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))
    assert np.allclose(got, want, rtol=1e-8, atol=1e-17)
    df = [(1,), (2,), (7.3,), (30,), (998,), (1e13,)]
    got = values(spark, df, "d double", di.t_upper_quantile(0.025, F.col("d")))
    assert got == pytest.approx([12.706204736, 4.302652730, *sp.t_ppf(0.975, np.array([7.3, 30, 998])), 1.959963985], rel=1e-8)
    none = F.lit(None).cast("double")
    nothing = [di.t_two_sided(F.lit(2.0), F.lit(0.0)), di.t_two_sided(none, F.lit(9.0)), di.chi2_sf(none, F.lit(2.0)), di.nct_cdf(none, F.lit(9.0), F.lit(1.0)), di.normal_cdf(none)]
    assert list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(nothing)]).first()) == [None] * 5


def test_noncentral_t(spark):
    rows = [(2.0, 10, 1.5), (1.97, 300, 0.4), (-1.97, 300, 0.4), (1.96, 5e5, 3.0), (2.4, 3, 0.0)]
    got = values(spark, rows, "t double, d double, n double", di.nct_cdf(F.col("t"), F.col("d"), F.col("n")))
    assert np.allclose(got, sp.nct_cdf(*np.array(rows).T), rtol=1e-7, atol=1e-10)
    assert got[4] == pytest.approx(float(sp.t_cdf(2.4, 3)), rel=1e-8)


def test_chi_square(spark):
    rows = [(x, k) for k in (1, 2, 3, 8, 31, 1000, 5000) for x in (0.0, 0.2, 3.84, k * 1.0, k * 1.1 + 5)]
    got = values(spark, rows, "x double, k double", di.chi2_sf(F.col("x"), F.col("k")))
    want = sp.chi2_sf(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))
    assert np.allclose(got, want, rtol=1e-4, atol=1e-12) and np.allclose(got[:25], want[:25], rtol=1e-9)
    assert values(spark, [(3.841458820694124, 1)], "x double, k double", di.chi2_sf(F.col("x"), F.col("k")))[0] == pytest.approx(0.05, rel=1e-10)


def test_numeric_functions_stand_in_large_batches():
    rng = np.random.default_rng(0)
    t, d = rng.normal(0, 3, 100_000), rng.integers(1, 10**6, 100_000).astype(float)
    assert np.allclose(sp.t_two_sided(t, d)[:50], [sp.t_two_sided(a, b) for a, b in zip(t[:50], d[:50], strict=True)], rtol=1e-12)
    assert np.isfinite(sp.chi2_sf(rng.exponential(20, 100_000), rng.integers(1, 200, 100_000).astype(float))).all()
