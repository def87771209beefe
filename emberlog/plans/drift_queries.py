"""Drift, metric-stream and alert queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from emberlog.operators import alerts as al
from emberlog.operators import drift as dr
from emberlog.operators import drift_sketches as ds
from emberlog.operators import metrics as mx
from emberlog.operators import stats as st
from emberlog.operators.ordered import with_position
from emberlog.plans.quality_queries import PREDICTIONS
from emberlog.plans.registry import query
from emberlog.session import shared_folder, stored
from emberlog.sources.tables import predictions, table

_FEATURES = ("l_quantity", "l_extendedprice", "l_tax")
_HALF = "1998-06-01"

HISTOGRAMS = f"""long AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) * CASE WHEN l_shipdate >= TIMESTAMP '{_HALF}' AND '{c}' = 'l_quantity' THEN 1.5 ELSE 1 END AS value, l_shipdate < TIMESTAMP '{_HALF}' AS base FROM lineitem" for c in _FEATURES)}),
edges AS (SELECT feature, {', '.join(f'quantile_cont(value, {i / 10}) AS e{i}' for i in range(1, 10))} FROM long WHERE base GROUP BY 1),
binned AS (SELECT feature, base, {' + '.join(f'CAST(value > e{i} AS INTEGER)' for i in range(1, 10))} AS bin FROM long JOIN edges USING (feature)),
counts AS (SELECT feature, bin, sum(CAST(base AS INTEGER)) AS nb, sum(CAST(NOT base AS INTEGER)) AS nn FROM binned GROUP BY 1, 2),
hist AS (SELECT feature, bin, greatest(nb / sum(nb) OVER (PARTITION BY feature)::DOUBLE, 1e-6) AS p,
  greatest(nn / sum(nn) OVER (PARTITION BY feature)::DOUBLE, 1e-6) AS q FROM counts),
scores AS (SELECT feature, sum((p - q) * ln(p / q)) AS psi, sum(q * ln(q / p)) AS kl FROM hist GROUP BY 1)"""


def _sets(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", *_FEATURES)
    late = F.col("l_shipdate") >= F.lit(_HALF).cast("timestamp")
    lines = lines.withColumn("l_quantity", F.when(late, F.col("l_quantity") * 1.5).otherwise(F.col("l_quantity")))
    long = st.metrics_long(lines.withColumn("late", late), ["late"], _FEATURES, "feature")
    return long.where(~F.col("late")).drop("late"), long.where("late").drop("late")


@query("drift_scores", f"""WITH {HISTOGRAMS} SELECT feature, round(psi, 6) AS psi, round(kl, 6) AS kl_divergence,
  CASE WHEN psi > 0.3 THEN 'red' WHEN psi > 0.1 THEN 'yellow' ELSE 'green' END AS band FROM scores""")
def drift_scores(spark, sf_dir):
    out = dr.drift_scores(*_sets(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("psi", "kl_divergence")})


@query(
    "sketch_drift",
    f"""WITH {HISTOGRAMS} SELECT feature, count(*) FILTER (base) AS n_base, count(*) FILTER (NOT base) AS n_now,
  round(avg(value) FILTER (base), 4) AS baseline_mean, round(stddev_samp(value) FILTER (base), 4) AS baseline_std, true AS within_margin
FROM long GROUP BY 1""",
)
def sketch_drift(spark, sf_dir):
    """Scores from stored hourly sketches, held against the exact ones."""
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", *_FEATURES)
    late = F.col("l_shipdate") >= F.lit(_HALF).cast("timestamp")
    lines = lines.withColumn("l_quantity", F.when(late, F.col("l_quantity") * 1.5).otherwise(F.col("l_quantity")))
    long = st.metrics_long(lines, ["l_shipdate"], _FEATURES, "feature")
    path = f"{shared_folder(spark)}/sketches-{uuid.uuid4().hex}"
    ds.write_sketches(ds.hourly_sketches(long, "l_shipdate"), path, period="month")
    base, now = ds.merged(ds.read_sketches(spark, path, last="1998-05-31")), ds.merged(ds.read_sketches(spark, path, first=_HALF))
    exact = dr.drift_scores(*_sets(spark, sf_dir)).select("feature", F.col("psi").alias("exact"))
    moments = base.select("feature", F.round("mean", 4).alias("baseline_mean"), F.round("std", 4).alias("baseline_std"))
    scores = ds.sketch_drift(base, now).join(exact, "feature").join(moments, "feature")
    return scores.select(
        "feature", "n_base", "n_now", "baseline_mean", "baseline_std", (F.abs(F.col("psi") - F.col("exact")) <= F.col("psi_margin")).alias("within_margin")
    )


@query("drifting_features", f"""WITH {HISTOGRAMS} SELECT count(*) FILTER (psi > 0.3) AS drifting, count(*) AS features FROM scores""")
def drifting_features(spark, sf_dir):
    return dr.drifting_features(dr.drift_scores(*_sets(spark, sf_dir)))


@query("top_drifting_features", f"""WITH {HISTOGRAMS} SELECT feature, round(psi, 6) AS psi FROM scores ORDER BY psi DESC, feature LIMIT 10""")
def top_drifting(spark, sf_dir):
    out = dr.top_drifting(dr.drift_scores(*_sets(spark, sf_dir)))
    return out.select("feature", F.round("psi", 6).alias("psi"))


@query(
    "moment_comparison",
    f"""WITH {HISTOGRAMS} SELECT feature, round(avg(value) FILTER (base), 4) AS baseline_mean, round(stddev_samp(value) FILTER (base), 4) AS baseline_std,
  round(avg(value) FILTER (NOT base), 4) AS current_mean, round(stddev_samp(value) FILTER (NOT base), 4) AS current_std FROM long GROUP BY 1""",
)
def moment_comparison(spark, sf_dir):
    out = dr.moment_comparison(*_sets(spark, sf_dir))
    return out.select("feature", *[F.round(c, 4).alias(c) for c in out.columns if c != "feature"])


@query(
    "drift_heatmap",
    """SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_us, CAST(floor(round(((event_id * 37) % 350) / 1000.0 / 0.05, 9)) AS BIGINT) AS psi_slot,
  count(*) AS n FROM events GROUP BY 1, 2""",
)
def drift_heatmap(spark, sf_dir):
    scores = table(spark, sf_dir, "events").select("ts", (((F.col("event_id") * 37) % 350) / 1000.0).alias("psi"))
    out = dr.drift_heatmap(scores, "ts")
    return out.select(F.unix_micros("window_start").alias("window_us"), "psi_slot", "n")


@query(
    "concept_drift",
    """WITH b AS (SELECT avg(CAST(event_type = 'error' AS INTEGER)) AS base FROM events),
r AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS w, count(*) AS n, avg(CAST(event_type = 'error' AS INTEGER)) AS rate FROM events GROUP BY 1)
SELECT epoch_us(w) AS window_us, n, round(rate, 6) AS anomaly_rate, round(abs(rate - base) / base, 6) AS relative_change,
  abs(rate - base) / base > 0.5 AS alert FROM r, b""",
)
def concept_drift(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    hit = F.col("event_type") == "error"
    out = dr.concept_drift(events, "ts", hit, "6 hours", events.agg(F.avg(hit.cast("int")).alias("b")).scalar())
    return out.select(
        F.unix_micros("window_start").alias("window_us"), "n", F.round("anomaly_rate", 6).alias("anomaly_rate"),
        F.round("relative_change", 6).alias("relative_change"), "alert",
    )


COUNTERS = """samples AS (SELECT ts, event_id, event_type, user_id % 3 AS shard, ((row_number() OVER (PARTITION BY event_type, user_id % 3
    ORDER BY ts, event_id) - 1) % 50)::DOUBLE AS value FROM events),
deltas AS (SELECT *, CASE WHEN p IS NULL THEN NULL WHEN value >= p THEN value - p ELSE value END AS delta FROM (
  SELECT *, lag(value) OVER (PARTITION BY event_type, shard ORDER BY ts, event_id) AS p FROM samples))"""


def _counters(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "ts", "event_id", "event_type", (F.col("user_id") % 3).alias("shard")
    )
    numbered = with_position(events, ["event_type", "shard"], ["ts", "event_id"], tie="event_id", name="p")
    return stored(
        numbered.select("ts", "event_id", "event_type", "shard", ((F.col("p") - 1) % 50).cast("double").alias("value"))
    )


@query(
    "counter_rate",
    f"""WITH {COUNTERS} SELECT epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)) AS window_us, event_type,
  round(coalesce(sum(delta), 0) / 300, 6) AS rate FROM deltas GROUP BY 1, 2""",
)
def counter_rate(spark, sf_dir):
    out = mx.counter_rate(_counters(spark, sf_dir), ["event_type", "shard"], 300, ["event_type"], tie="event_id")
    return out.select(F.unix_micros("window_start").alias("window_us"), "event_type", F.round("rate", 6).alias("rate"))


@query(
    "counter_increase_day",
    f"""WITH {COUNTERS} SELECT epoch_us(time_bucket(INTERVAL 24 HOUR, ts)) AS window_us, event_type, coalesce(sum(delta), 0) AS increase
FROM deltas GROUP BY 1, 2""",
)
def counter_increase(spark, sf_dir):
    out = mx.counter_increase(_counters(spark, sf_dir), ["event_type", "shard"], "24 hours", ["event_type"], tie="event_id")
    return out.select(F.unix_micros("window_start").alias("window_us"), "event_type", "increase")


@query(
    "traffic_distribution",
    f"""WITH {COUNTERS}, r AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, event_type, coalesce(sum(delta), 0) / 3600 AS rate FROM deltas GROUP BY 1, 2)
SELECT epoch_us(w) AS window_us, event_type, round(CASE WHEN sum(rate) OVER (PARTITION BY w) > 0 THEN rate / sum(rate) OVER (PARTITION BY w) END, 6) AS share FROM r""",
)
def traffic_distribution(spark, sf_dir):
    rates = mx.counter_rate(_counters(spark, sf_dir), ["event_type", "shard"], 3600, ["event_type"], tie="event_id")
    out = mx.rate_share(rates, "event_type")
    return out.select(F.unix_micros("window_start").alias("window_us"), "event_type", F.round("share", 6).alias("share"))


@query(
    "rate_ratio",
    f"""WITH {COUNTERS}, r AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, event_type, coalesce(sum(delta), 0) / 3600 AS rate FROM deltas GROUP BY 1, 2),
t AS (SELECT w, sum(rate) AS rate FROM r GROUP BY 1)
SELECT epoch_us(t.w) AS window_us, round(CASE WHEN t.rate > 0 THEN e.rate / t.rate END, 6) AS error_ratio
FROM t LEFT JOIN r e ON e.w = t.w AND e.event_type = 'error'""",
)
def rate_ratio(spark, sf_dir):
    rates = mx.counter_rate(_counters(spark, sf_dir), ["event_type", "shard"], 3600, ["event_type"], tie="event_id")
    total = rates.groupBy("window_start").agg(F.sum("rate").alias("rate"))
    out = mx.rate_ratio(rates.where("event_type = 'error'"), total, ["window_start"], "error_ratio")
    return out.select(F.unix_micros("window_start").alias("window_us"), F.round("error_ratio", 6).alias("error_ratio"))


_LE = [*mx.LATENCY_BUCKETS, "inf"]


def _ladder(q: float) -> str:
    """Quantile by hand: scan the bounds from below."""
    cases = []
    for i, le in enumerate(_LE):
        low, seen = (("0.0", "0") if i == 0 else (str(_LE[i - 1]), f"c{i - 1}"))
        value = f"{_LE[i - 1]}::DOUBLE" if le == "inf" else f"{low} + ({le} - {low}) * ({q} * c{len(_LE) - 1} - {seen}) / (c{i} - {seen})::DOUBLE"
        cases.append(f"WHEN c{i} >= {q} * c{len(_LE) - 1} THEN {value}")
    return "CASE " + " ".join(cases) + " END"


@query(
    "histogram_quantiles",
    f"""WITH c AS (SELECT event_type, {', '.join(f"count(*) FILTER (value / 50 <= '{le}'::DOUBLE) AS c{i}" for i, le in enumerate(_LE))} FROM events GROUP BY 1)
SELECT event_type, round({_ladder(0.5)}, 6) AS p50, round({_ladder(0.95)}, 6) AS p95, round({_ladder(0.99)}, 6) AS p99 FROM c""",
)
def histogram_quantiles(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", (F.col("value") / 50).alias("seconds"))
    ladder = mx.bucket_counts(events, ["event_type"], "seconds")
    points = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    out = mx.histogram_quantiles(ladder, ["event_type"], points)
    return out.select("event_type", *[F.round(p, 6).alias(p) for p in points])


# Alert, severity and team names.
RULES = (
    mx.Rule("HighErrorRate", "error_rate", ">", 0.5, 7200, "critical", "ml-ops"),
    mx.Rule("HighErrorRate", "error_rate", ">", 0.3, 3600, "warning", "ml-ops"),
    mx.Rule("ModelAccuracyDegraded", "accuracy", "<", 0.35, 1800, "critical", "ml-ops"),
    mx.Rule("AnomalyRateSpike", "error_rate", ">=", 0.25, 10800, "info", "operations"),
)

GAUGES = """gauges AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ts, concat('node-', CAST(user_id % 7 AS VARCHAR)) AS instance, 'error_rate' AS metric,
    avg(CAST(event_type = 'error' AS INTEGER)) AS value FROM events GROUP BY 1, 2
  UNION ALL SELECT time_bucket(INTERVAL 1 HOUR, ts), concat('node-', CAST(user_id % 7 AS VARCHAR)), 'accuracy',
    avg(CAST(value > 30 AS INTEGER)) FROM events GROUP BY 1, 2),
rules(alertname, metric, op, threshold, for_seconds, severity, team) AS (VALUES
  ('HighErrorRate', 'error_rate', '>', 0.5::DOUBLE, 7200, 'critical', 'ml-ops'), ('HighErrorRate', 'error_rate', '>', 0.3, 3600, 'warning', 'ml-ops'),
  ('ModelAccuracyDegraded', 'accuracy', '<', 0.35, 1800, 'critical', 'ml-ops'), ('AnomalyRateSpike', 'error_rate', '>=', 0.25, 10800, 'info', 'operations')),
checked AS (SELECT g.ts, g.instance, g.metric, g.value, alertname, threshold, for_seconds, severity, team,
    CASE op WHEN '>' THEN g.value > threshold WHEN '<' THEN g.value < threshold ELSE g.value >= threshold END AS active
  FROM gauges g JOIN rules r USING (metric)),
runs AS (SELECT *, sum(CAST(active AND NOT was AS INTEGER)) OVER (PARTITION BY alertname, severity, instance ORDER BY ts) AS run
  FROM (SELECT *, coalesce(lag(active) OVER (PARTITION BY alertname, severity, instance ORDER BY ts), false) AS was FROM checked)),
timed AS (SELECT *, min(ts) OVER r AS started_at, max(ts) OVER r AS ended_at FROM runs WHERE active
  WINDOW r AS (PARTITION BY alertname, severity, instance, run)),
fired AS (SELECT alertname, severity, team, instance, started_at, ended_at, min(ts) AS fired_at FROM timed
  WHERE epoch(ts) - epoch(started_at) >= for_seconds GROUP BY 1, 2, 3, 4, 5, 6),
active AS (SELECT * FROM checked WHERE active)"""


def gauges(spark, sf_dir):
    """Hourly error rate and accuracy per instance."""
    hourly = table(spark, sf_dir, "events").groupBy(
        F.window("ts", "1 hour").start.alias("ts"),
        F.concat(F.lit("node-"), (F.col("user_id") % 7).cast("string")).alias("instance"),
    ).agg(
        F.avg((F.col("event_type") == "error").cast("int")).alias("error_rate"),
        F.avg((F.col("value") > 30).cast("int")).alias("accuracy"),
    )
    return st.metrics_long(hourly, ["ts", "instance"], ["error_rate", "accuracy"])


@query(
    "threshold_rules",
    f"""WITH {GAUGES} SELECT alertname, severity, count(*) AS samples, count(*) FILTER (active) AS active FROM checked GROUP BY 1, 2""",
)
def threshold_rules(spark, sf_dir):
    return mx.check_rules(gauges(spark, sf_dir), RULES).groupBy("alertname", "severity").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if("active").alias("active")
    )


@query(
    "held_alerts",
    f"""WITH {GAUGES} SELECT alertname, severity, instance, epoch_us(started_at) AS started_us, epoch_us(fired_at) AS fired_us,
  epoch_us(ended_at) AS ended_us FROM fired""",
)
def held_alerts(spark, sf_dir):
    out = mx.held_alerts(mx.check_rules(gauges(spark, sf_dir), RULES), ["instance"])
    return out.select(
        "alertname", "severity", "instance", F.unix_micros("started_at").alias("started_us"),
        F.unix_micros("fired_at").alias("fired_us"), F.unix_micros("ended_at").alias("ended_us"),
    )


def active_alerts(spark, sf_dir):
    return mx.check_rules(gauges(spark, sf_dir), RULES).where("active")


@query(
    "suppress_repeats",
    f"""WITH RECURSIVE {GAUGES},
ticks AS (SELECT alertname, severity, epoch_us(ts) AS t, count(*) AS alerts FROM active GROUP BY 1, 2, 3),
sent AS (SELECT alertname, severity, min(t) AS t FROM ticks GROUP BY 1, 2
  UNION ALL SELECT s.alertname, s.severity, (SELECT min(k.t) FROM ticks k WHERE k.alertname = s.alertname AND k.severity = s.severity
      AND k.t - s.t > 43200000000) FROM sent s
    WHERE EXISTS (SELECT 1 FROM ticks k WHERE k.alertname = s.alertname AND k.severity = s.severity AND k.t - s.t > 43200000000))
SELECT alertname, severity, t AS ts_us, alerts FROM sent JOIN ticks USING (alertname, severity, t)""",
)
def suppress_repeats(spark, sf_dir):
    out = al.suppress_repeats(active_alerts(spark, sf_dir))
    return out.select("alertname", "severity", F.unix_micros("ts").alias("ts_us"), "alerts")


@query(
    "route_alerts",
    f"""WITH {GAUGES}, routed AS (
  SELECT *, 'pagerduty-critical' AS receiver FROM active WHERE severity = 'critical'
  UNION ALL SELECT *, 'slack-critical' FROM active WHERE severity = 'critical'
  UNION ALL SELECT *, 'slack-warnings' FROM active WHERE severity = 'warning'
  UNION ALL SELECT *, CASE WHEN alertname IN ('DataDriftDetected', 'ModelAccuracyDegraded') THEN 'webhook-retrain' ELSE 'default' END
    FROM active WHERE severity NOT IN ('critical', 'warning'))
SELECT receiver, alertname, severity, count(*) AS n FROM routed GROUP BY 1, 2, 3""",
)
def route_alerts(spark, sf_dir):
    return al.route_alerts(active_alerts(spark, sf_dir)).groupBy("receiver", "alertname", "severity").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "inhibit_alerts",
    f"""WITH {GAUGES} SELECT alertname, severity, instance, epoch_us(ts) AS ts_us FROM active a WHERE NOT (severity = 'warning' AND EXISTS (
  SELECT 1 FROM active c WHERE c.severity = 'critical' AND c.alertname = a.alertname AND c.instance = a.instance AND c.ts = a.ts))""",
)
def inhibit_alerts(spark, sf_dir):
    out = al.inhibit(active_alerts(spark, sf_dir))
    return out.select("alertname", "severity", "instance", F.unix_micros("ts").alias("ts_us"))


_PAYLOAD = """CASE WHEN event_id % 50 = 0 THEN '{"alerts": []}' ELSE
  concat('{"alerts": [{"labels": {"alertname": "', CASE event_id % 5 WHEN 0 THEN 'DataDriftDetected' WHEN 1 THEN 'ModelAccuracyDegraded'
    WHEN 2 THEN 'HighErrorRate' WHEN 3 THEN 'HighLatency' ELSE 'DiskFull' END,
  '", "severity": "warning"}, "annotations": {"description": "event ', CAST(event_id AS VARCHAR(20)), '"}}, {"labels": {}}]}') END"""


@query(
    "alert_event_types",
    """SELECT alertname, event_type, count(*) AS n FROM (
  SELECT CASE event_id % 5 WHEN 0 THEN 'DataDriftDetected' WHEN 1 THEN 'ModelAccuracyDegraded' WHEN 2 THEN 'HighErrorRate' WHEN 3 THEN 'HighLatency'
    ELSE 'DiskFull' END AS alertname, CASE event_id % 5 WHEN 0 THEN 'data-drift-alert' WHEN 1 THEN 'performance-drift-alert'
    WHEN 2 THEN 'error-rate-alert' WHEN 3 THEN 'latency-alert' ELSE 'generic-alert' END AS event_type FROM events WHERE event_id % 50 <> 0
  UNION ALL SELECT 'Unknown', 'generic-alert' FROM events WHERE event_id % 50 <> 0) GROUP BY 1, 2""",
)
def alert_event_types(spark, sf_dir):
    payloads = table(spark, sf_dir, "events").select(F.expr(_PAYLOAD.replace("VARCHAR(20)", "STRING")).alias("payload"))
    return al.alerts_from_payload(payloads).groupBy("alertname", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "latest_gauges",
    f"""WITH {GAUGES} SELECT instance, metric, round(max_by(value, ts), 6) AS value, epoch_us(max(ts)) AS ts_us FROM gauges GROUP BY 1, 2""",
)
def latest_gauges(spark, sf_dir):
    out = mx.latest_gauges(gauges(spark, sf_dir), ["instance", "metric"])
    return out.select("instance", "metric", F.round("value", 6).alias("value"), F.unix_micros("ts").alias("ts_us"))


@query(
    "model_comparison_table",
    f"""WITH {GAUGES} SELECT instance, round(max_by(value, ts) FILTER (metric = 'accuracy'), 6) AS accuracy,
  round(max_by(value, ts) FILTER (metric = 'error_rate'), 6) AS error_rate FROM gauges GROUP BY 1""",
)
def model_comparison_table(spark, sf_dir):
    out = mx.model_table(gauges(spark, sf_dir), "instance", "metric", ["accuracy", "error_rate"])
    return out.select("instance", F.round("accuracy", 6).alias("accuracy"), F.round("error_rate", 6).alias("error_rate"))


@query(
    "latest_run_per_model",
    f"""WITH {PREDICTIONS} SELECT model, id FROM scored QUALIFY row_number() OVER (PARTITION BY model ORDER BY ts DESC, id) = 1""",
)
def latest_run(spark, sf_dir):
    return mx.latest_runs(predictions(spark, sf_dir), ["model"], "timestamp", "id").select("model", "id")


@query(
    "top_trials",
    """SELECT p_partkey AS number, p_retailprice AS value, round(1.0 / 3, 6) AS weight FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 3""",
)
def top_trials(spark, sf_dir):
    from emberlog.operators.models import top_trials as top

    trials = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("number"), F.col("p_retailprice").alias("value"))
    return top(trials, 3).select("number", "value", F.round("weight", 6).alias("weight"))
