"""Ordered primitives against plain windows and pandas, on skewed data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators.ordered import (
    exact_percentiles,
    ordered_running,
    time_gaps,
    trailing_window,
    with_lags,
    with_position,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one instant and one value, a third one key."""
    rng = np.random.default_rng(7)
    n = 3000
    ts = rng.integers(0, 4 * 3600_000_000, n)
    ts[: n // 3] = 3_600_000_000
    value = np.round(rng.exponential(10, n), 2)
    value[: n // 3] = 5.0
    frame = pd.DataFrame(
        {
            "id": np.arange(n), "t": ts + 1_700_000_000_000_000, "key": rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1]),
            "value": value,
        }
    )
    frame.loc[frame.index % 17 == 0, "value"] = np.nan
    df = spark.createDataFrame(frame).withColumn("ts", F.timestamp_micros("t"))
    return frame, df.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


@pytest.mark.parametrize("slices", [1, 2, 50])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_trailing_window_equals_range_frame(skewed, slices, keys):
    _, df = skewed
    width = 300_000_000
    got = trailing_window(
        df, "ts", width,
        {"n": ("count", F.col("value")), "s": ("sum", F.col("value")), "hi": ("max", F.col("value")), "lo": ("min", F.col("value"))},
        keys, slices,
    )
    part = f"partition by {keys[0]}" if keys else ""
    w = f"over ({part} order by t range between {width - 1} preceding and current row)"
    want = df.selectExpr("id", f"count(value) {w} n", f"sum(value) {w} s", f"max(value) {w} hi", f"min(value) {w} lo")
    a = got.select("id", "n", "s", "hi", "lo").toPandas().sort_values("id", ignore_index=True)
    b = want.toPandas().sort_values("id", ignore_index=True)
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9)


def test_event_exactly_one_width_ago_is_outside(spark):
    df = spark.createDataFrame([(1, 0), (2, 300_000_000), (3, 300_000_001)], "id int, t bigint").withColumn(
        "ts", F.timestamp_micros("t")
    )
    got = {r.id: r.n for r in trailing_window(df, "ts", 300_000_000, {"n": ("count", F.lit(1))}).collect()}
    assert got == {1: 1, 2: 1, 3: 2}


def test_null_time_keeps_its_row(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, t bigint").withColumn("ts", F.timestamp_micros("t"))
    got = {r.id: r.n for r in trailing_window(df, "ts", 60_000_000, {"n": ("count", F.lit(1))}).collect()}
    assert got == {1: None, 2: 1}


def test_positions_are_exact_on_hot_values(skewed):
    frame, df = skewed
    got = with_position(df.select("id", "key", "t"), ["key"], ["t", "id"], tie="id").toPandas()
    want = frame.sort_values(["key", "t", "id"])
    want["position"] = want.groupby("key").cumcount() + 1
    merged = got.merge(want[["id", "position"]], on="id", suffixes=("", "_want"))
    assert len(merged) == len(frame)
    assert (merged.position == merged.position_want).all()


def test_running_sums_with_null_key(spark):
    rows = [(None, 1, 10.0), (None, 2, 5.0), ("x", 1, 1.0)]
    df = spark.createDataFrame(rows, "k string, o int, v double")
    got = {(r.k, r.o): (r.s, r.s_total) for r in ordered_running(df, ["k"], ["o"], {"s": F.col("v")}).collect()}
    assert got == {(None, 1): (10.0, 15.0), (None, 2): (15.0, 15.0), ("x", 1): (1.0, 1.0)}


@pytest.mark.parametrize("block", [16, 64, 100000])
def test_lags_across_blocks(skewed, block):
    frame, df = skewed
    got = with_lags(df.select("id", "key", "t"), ["key"], ["t", "id"], {"p1": ("id", 1), "p15": ("id", 15)}, tie="id", block=block)
    a = got.toPandas().set_index("id").sort_index()
    b = frame.sort_values(["t", "id"])
    for k, name in ((1, "p1"), (15, "p15")):
        want = b.assign(w=b.groupby("key")["id"].shift(k)).set_index("id").sort_index()["w"]
        assert (a[name].fillna(-1) == want.fillna(-1)).all()


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_percentiles(skewed, p):
    frame, df = skewed
    got = {r.key: r.x for r in exact_percentiles(df, ["key"], "value", {"x": p}).collect()}
    want = frame.groupby("key")["value"].quantile(p)
    for key, value in want.items():
        assert got[key] == pytest.approx(value, rel=1e-12)
    near = {r.key: r.x for r in exact_percentiles(df, ["key"], "value", {"x": p}, nearest_rank=True).collect()}
    for key, group in frame.dropna().groupby("key"):
        ordered = sorted(group["value"])
        assert near[key] == ordered[min(int(len(ordered) * p), len(ordered) - 1)]


def test_percentile_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (None,)], "v double")
    assert exact_percentiles(df, [], "v", {"m": 0.5}).first().m == 3.0


def test_gap_of_exactly_the_limit_is_no_gap(spark):
    minute = 60_000_000
    df = spark.createDataFrame([(0,), (60 * minute,), (121 * minute,)], "t bigint").withColumn("ts", F.timestamp_micros("t"))
    gaps = time_gaps(df, "ts", 60 * minute).collect()
    assert [round(g.gap_minutes, 6) for g in gaps] == [61.0]


def test_gaps_match_pandas(skewed):
    frame, df = skewed
    got = time_gaps(df, "ts", 5_000_000, block=4).toPandas()
    diff = frame["t"].sort_values().diff()
    want = diff[diff > 5_000_000]
    assert len(got) == len(want)
    assert got["gap_minutes"].sum() == pytest.approx(want.sum() / 60e6)
