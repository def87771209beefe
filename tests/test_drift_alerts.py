import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.operators import alerts as al
from emberlog.operators import drift as dr
from emberlog.operators import metrics as mx
from emberlog.operators import quality as qa

START = datetime(2024, 1, 1)


def test_psi_of_itself_is_zero(spark):
    df = spark.range(1000).select(F.lit("f").alias("feature"), (F.col("id") % 97).cast("double").alias("value"))
    r = dr.drift_scores(df, df).first()
    assert r.psi == pytest.approx(0, abs=1e-12) and r.band == "green"
    moved = dr.drift_scores(df, df.withColumn("value", F.col("value") + 60)).first()
    assert moved.band == "red" and moved.psi > 0.3


def test_counter_restart(spark):
    rows = [(START + timedelta(seconds=60 * i), "a", float(v)) for i, v in enumerate([0, 5, 9, 2, 4])]
    df = spark.createDataFrame(rows, "ts timestamp, name string, value double")
    assert mx.counter_increase(df, ["name"], "1 hour").first().increase == 5 + 4 + 2 + 2


def test_histogram_quantile_cases(spark):
    rows = [("a", 1.0, 5), ("a", 2.0, 10), ("a", float("inf"), 10), ("b", 1.0, 0), ("b", 2.0, 0), ("b", float("inf"), 4), ("c", 1.0, 0), ("c", float("inf"), 0)]
    df = spark.createDataFrame(rows, "k string, le double, n bigint")
    got = {r.k: r.quantile for r in mx.histogram_quantile(df, ["k"], 0.75).collect()}
    assert got == {"a": 1.5, "b": 2.0, "c": None}


def held(spark, states, for_seconds=120):
    rows = [("n1", START + timedelta(seconds=60 * i), "m", float(s)) for i, s in enumerate(states)]
    df = spark.createDataFrame(rows, "instance string, ts timestamp, metric string, value double")
    rule = mx.Rule("A", "m", ">", 0.5, for_seconds, "warning", "t")
    return sorted((r.fired_at - START).seconds for r in mx.held_alerts(mx.check_rules(df, [rule]), ["instance"]).collect())


def test_hold_fires_at_the_limit(spark):
    assert held(spark, [1, 1, 1, 1]) == [120]
    assert held(spark, [1, 1, 0, 1, 1]) == []
    assert held(spark, [0, 1, 1, 1, 0, 1, 1, 1]) == [180, 420]


def test_repeats(spark):
    hours = [0, 1, 11.9, 12, 12.1, 24, 24.2, 24.3]
    rows = [("A", "warning", START + timedelta(hours=h)) for h in hours] + [("B", "warning", START + timedelta(hours=1))]
    df = spark.createDataFrame(rows, "alertname string, severity string, ts timestamp")
    got = al.suppress_repeats(df).orderBy("alertname", "ts").collect()
    assert [(r.alertname, round((r.ts - START).total_seconds() / 3600, 1)) for r in got] == [("A", 0.0), ("A", 12.1), ("A", 24.2), ("B", 1.0)]


def test_repeats_against_a_plain_fold(spark):
    rng = np.random.default_rng(4)
    rows = [("hot", "warning", float(t)) for t in rng.integers(0, 400_000, 600)]
    rows += [(n, None, float(t)) for n in ("x", None) for t in rng.integers(0, 90_000, 15)]
    rows += [("edge", "critical", float(t)) for t in (0, 3600, 3601, 7201, 7202, 7202)] + [("none", "info", None)]
    df = spark.createDataFrame(rows, "alertname string, severity string, s double").withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))
    got = al.suppress_repeats(df, repeat_seconds=3600).select("alertname", "severity", (F.unix_micros("ts") / 1_000_000).alias("s"), "alerts").collect()
    want = []
    for name, severity in {(a, b) for a, b, _ in rows}:
        times, sent = [t for a, b, t in rows if (a, b) == (name, severity) and t is not None], None
        for t in sorted(set(times)):
            if sent is None or t - sent > 3600:
                sent = t
                want.append((name, severity, t, times.count(t)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    nodes = al.suppress_repeats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in nodes and "Arrow" not in nodes and "MapInPandas" not in nodes


def test_routes(spark):
    rows = [("HighErrorRate", "critical"), ("DataDriftDetected", "warning"), ("DataDriftDetected", "info"), ("X", "info")]
    df = spark.createDataFrame(rows, "alertname string, severity string")
    got = sorted((r.alertname, r.severity, r.receiver) for r in al.route_alerts(df).collect())
    assert got == [
        ("DataDriftDetected", "info", "webhook-retrain"), ("DataDriftDetected", "warning", "slack-warnings"),
        ("HighErrorRate", "critical", "pagerduty-critical"), ("HighErrorRate", "critical", "slack-critical"), ("X", "info", "default"),
    ]


def test_inhibition_needs_equal_labels(spark):
    rows = [("A", "critical", "i1", START), ("A", "warning", "i1", START), ("A", "warning", "i2", START), ("B", "warning", "i1", START)]
    df = spark.createDataFrame(rows, "alertname string, severity string, instance string, ts timestamp")
    left = {(r.alertname, r.severity, r.instance) for r in al.inhibit(df).collect()}
    assert left == {("A", "critical", "i1"), ("A", "warning", "i2"), ("B", "warning", "i1")}


def test_payload(spark):
    body = json.dumps({"alerts": [{"labels": {"alertname": "HighLatency", "severity": "warning"}, "annotations": {"description": "d"}}, {"labels": {"alertname": "Odd"}}]})
    df = spark.createDataFrame([(body,), ("broken",), ('{"alerts": []}',)], "payload string")
    got = sorted((r.alertname, r.severity, r.description, r.event_type) for r in al.alerts_from_payload(df).collect())
    assert got == [("HighLatency", "warning", "d", "latency-alert"), ("Odd", "Unknown", "No description", "generic-alert")]


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None), (None, None)], "a int, b string")
    assert qa.duplicate_count(df).first().duplicates == 2
    assert qa.duplicate_count(df, digest=True).first().duplicates == 2


def test_verdict_ignores_duplicates_and_gaps(spark):
    rows = [(START, "INFO"), (START, "INFO"), (START + timedelta(hours=3), "ERROR")]
    report = qa.validate_logs(spark.createDataFrame(rows, "timestamp timestamp, log_level string")).collect()
    state = {r.check_name: r.passed for r in report}
    assert state["overall"] and not state["duplicates"] and not state["timestamp_continuity"]
    bad = qa.validate_logs(spark.createDataFrame([(START, None)], "timestamp timestamp, log_level string")).collect()
    assert not {r.check_name: r.passed for r in bad}["overall"]
