"""Sketches of drift against exact scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.operators import drift as dr
from emberlog.operators import drift_sketches as ds


def values(spark, days, seed, shift=0.0):
    rng = np.random.default_rng(seed)
    rows = [(f, f"2024-01-{d:02d} {int(rng.integers(24)):02d}:00:00", float(rng.normal(shift * (f == "a"), 1))) for d in days for f in "ab" for _ in range(1500)]
    rows.append(("a", "2024-01-01 00:00:00", None))
    return spark.createDataFrame(rows, "feature string, ts string, value double").withColumn("ts", F.to_timestamp("ts"))


def test_scores_within_margin(spark, tmp_path):
    path = str(tmp_path / "sketches")
    base, now = values(spark, range(1, 5), 1), values(spark, range(5, 8), 2, shift=0.8)
    ds.write_sketches(ds.hourly_sketches(base, "ts"), path)
    ds.write_sketches(ds.hourly_sketches(now, "ts"), path)
    old, new = ds.merged(ds.read_sketches(spark, path, last="2024-01-04")), ds.merged(ds.read_sketches(spark, path, first="2024-01-05"))
    got = {r.feature: r for r in ds.sketch_drift(old, new).collect()}
    exact = {r.feature: r for r in dr.drift_scores(base, now).collect()}
    for f in "ab":
        assert abs(got[f].psi - exact[f].psi) <= got[f].psi_margin < 0.5
        assert (got[f].n_base, got[f].n_now) == (6000, 4500)
    assert got["a"].band == "red" and got["b"].band == "green"
    moments = {r.feature: r for r in dr.moment_comparison(base, now).collect()}
    for r in old.collect():
        assert (r["mean"], r["std"]) == pytest.approx((moments[r.feature].baseline_mean, moments[r.feature].baseline_std))


def test_a_new_day_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "sketches")
    ds.write_sketches(ds.hourly_sketches(values(spark, [1, 2], 3), "ts"), path)
    before = {r.day: r.n for r in ds.read_sketches(spark, path).groupBy("day").agg(F.sum("n").alias("n")).collect()}
    files = {f for f in spark.read.parquet(path).inputFiles() if '2024-01-01' in f}
    ds.write_sketches(ds.hourly_sketches(values(spark, [2], 4).where("value > 0 OR ts < '2024-01-02'").where("ts >= '2024-01-02'"), "ts"), path)
    after = {r.day: r.n for r in ds.read_sketches(spark, path).groupBy("day").agg(F.sum("n").alias("n")).collect()}
    assert files and {f for f in spark.read.parquet(path).inputFiles() if '2024-01-01' in f} == files
    first, second = sorted(before)
    assert after[first] == before[first] and 0 < after[second] < before[second]
