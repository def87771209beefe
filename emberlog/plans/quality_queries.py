"""Quality, summary, evaluation and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlog.operators import evaluate as ev
from emberlog.operators import quality as qa
from emberlog.operators import splits as sp
from emberlog.operators import stats as st
from emberlog.operators.ordered import exact_percentiles, time_gaps
from emberlog.plans.log_queries import parsed
from emberlog.plans.log_sql import PARSED
from emberlog.plans.registry import query
from emberlog.sources.logs import keep_recent, list_streams, scan_events
from emberlog.sources.tables import log_events, predictions, table

PREDICTIONS = """preds AS (
  SELECT event_id AS id, ts, CAST(event_type = 'error' AS INTEGER) AS label, m.model,
    CASE m.model
      WHEN 'booster_a' THEN round(CAST(event_type = 'error' AS INTEGER) * 0.4 + ((event_id * 7919) % 1000) / 2000.0, 4)
      WHEN 'booster_b' THEN round(CAST(event_type = 'error' AS INTEGER) * 0.3 + ((event_id * 104729) % 700) / 1000.0, 4)
      ELSE round(((event_id * 31) % 100) / 100.0, 2) END AS score
  FROM events, (VALUES ('booster_a'), ('booster_b'), ('isolation')) m(model)),
scored AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM preds),
confusion AS (SELECT model,
    CAST(sum(CAST(label = 1 AND prediction = 1 AS INTEGER)) AS BIGINT) AS tp,
    CAST(sum(CAST(label = 0 AND prediction = 1 AS INTEGER)) AS BIGINT) AS fp,
    CAST(sum(CAST(label = 0 AND prediction = 0 AS INTEGER)) AS BIGINT) AS tn,
    CAST(sum(CAST(label = 1 AND prediction = 0 AS INTEGER)) AS BIGINT) AS fn FROM scored GROUP BY 1),
ranked AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
    + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r FROM scored),
aucs AS (SELECT model, (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2.0)
    / (sum(label) * (count(*) - sum(label))) AS auc FROM ranked GROUP BY 1),
metrics AS (SELECT c.*, (tp + tn) / (tp + fp + tn + fn)::DOUBLE AS accuracy,
    coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1_score,
    coalesce(fp / nullif(fp + tn, 0)::DOUBLE, 0) AS false_positive_rate, auc AS auc_roc
  FROM confusion c JOIN aucs USING (model))"""


@query(
    "missing_percent",
    f"""WITH {PARSED}, m AS (SELECT
  {', '.join(f"100.0 * avg(CAST({c} IS NULL AS INTEGER)) AS {c}" for c in ('log_stream', 'request_id', 'duration', 'memory_used', 'error_type'))}
FROM parsed) SELECT column_name, round(pct, 6) AS missing_percent FROM (UNPIVOT m ON COLUMNS(*) INTO NAME column_name VALUE pct)""",
)
def missing_percent(spark, sf_dir):
    columns = ["log_stream", "request_id", "duration", "memory_used", "error_type"]
    out = qa.missing_percent(parsed(spark, sf_dir), columns)
    return out.select("column_name", F.round("missing_percent", 6).alias("missing_percent"))


@query(
    "out_of_range",
    """SELECT 'l_quantity' AS column_name, count(*) FILTER (l_quantity < 5 OR l_quantity > 45) AS out_of_range FROM lineitem
UNION ALL SELECT 'l_discount', count(*) FILTER (l_discount < 0.01 OR l_discount > 0.05) FROM lineitem
UNION ALL SELECT 'l_returnflag', count(*) * 0 FROM lineitem""",
)
def out_of_range(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return qa.out_of_range(lines, {"l_quantity": (5, 45), "l_discount": (0.01, 0.05), "l_returnflag": (0, 1), "absent": (0, 1)})


@query("duplicate_texts", "SELECT count(*) - count(DISTINCT text) AS duplicates FROM documents")
def duplicate_texts(spark, sf_dir):
    return qa.duplicate_count(table(spark, sf_dir, "documents").select("text"), digest=True)


@query(
    "duplicate_rows",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem
GROUP BY l_suppkey, l_quantity, l_returnflag)""",
)
def duplicate_rows(spark, sf_dir):
    return qa.duplicate_count(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_quantity", "l_returnflag"])


@query(
    "unexpected_values",
    """SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders
WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 2""",
)
def unexpected_values(spark, sf_dir):
    return qa.unexpected_values(
        table(spark, sf_dir, "orders"), {"o_orderstatus": ["O", "F"], "o_orderpriority": ["1-URGENT", "2-HIGH"]}
    )


@query(
    "value_set_difference",
    "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45 AND l_partkey IS NOT NULL)",
)
def value_set_difference(spark, sf_dir):
    large = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return qa.missing_values_difference(table(spark, sf_dir, "part"), large, "p_partkey")


@query(
    "time_gaps",
    """SELECT epoch_us(ts) AS ts_us, round((epoch_us(ts) - epoch_us(p)) / 1e6, 6) AS gap_seconds
FROM (SELECT ts, lag(ts) OVER (ORDER BY ts) AS p FROM events) WHERE epoch_us(ts) - epoch_us(p) > 600000000""",
)
def gaps(spark, sf_dir):
    found = time_gaps(table(spark, sf_dir, "events"), "ts", 600_000_000)
    return found.select(F.unix_micros("timestamp").alias("ts_us"), F.round(60 * F.col("gap_minutes"), 6).alias("gap_seconds"))


@query(
    "time_gaps_by_user",
    """SELECT user_id, epoch_us(ts) AS ts_us, round((epoch_us(ts) - epoch_us(p)) / 1e6, 6) AS gap_seconds
FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events)
WHERE epoch_us(ts) - epoch_us(p) > 86400000000""",
)
def gaps_by_user(spark, sf_dir):
    found = time_gaps(table(spark, sf_dir, "events"), "ts", 86_400_000_000, ["user_id"])
    return found.select("user_id", F.unix_micros("timestamp").alias("ts_us"), F.round(60 * F.col("gap_minutes"), 6).alias("gap_seconds"))


@query(
    "out_of_order",
    """SELECT count(*) AS rows, count(*) FILTER (o_orderdate < p) AS out_of_order
FROM (SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderkey) AS p FROM orders)""",
)
def out_of_order(spark, sf_dir):
    return qa.out_of_order_count(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate")


_OUTLIERS = ("l_quantity", "l_extendedprice", "l_tax")


@query(
    "outlier_percent",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, 0.0::DOUBLE AS missing_percent,
  round(100.0 * avg(CAST({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) AS INTEGER)), 6) AS outlier_percent
FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)"""
        for c in _OUTLIERS
    ),
)
def outlier_percent(spark, sf_dir):
    out = qa.outlier_percent(table(spark, sf_dir, "lineitem"), _OUTLIERS)
    return out.select("column_name", "missing_percent", F.round("outlier_percent", 6).alias("outlier_percent"))


@query(
    "validate_logs",
    f"""WITH {PARSED} SELECT 'overall' AS check_name, count(*) FILTER (ts IS NULL OR log_level IS NULL) = 0
  AND count(*) FILTER (log_level NOT IN ('DEBUG', 'INFO', 'WARN', 'ERROR', 'FATAL')) = 0 AS passed, NULL::DOUBLE AS metric FROM parsed
UNION ALL SELECT 'duplicates', count(*) - count(DISTINCT event_id) = 0, (count(*) - count(DISTINCT event_id))::DOUBLE FROM parsed
UNION ALL SELECT 'timestamp_continuity', false, (epoch_us(ts) - epoch_us(p))::DOUBLE
  FROM (SELECT ts, lag(ts) OVER (ORDER BY ts) AS p FROM events) WHERE epoch_us(ts) - epoch_us(p) > 3600000000
UNION ALL SELECT 'missing_values', column_name NOT IN ('timestamp', 'log_level') OR pct = 0, round(pct, 6)
  FROM (UNPIVOT (SELECT {', '.join(f"100.0 * avg(CAST({s} IS NULL AS INTEGER)) AS {c}" for c, s in [('event_id', 'event_id'), ('timestamp', 'ts'), ('ingestion_time', 'ts'), ('message', 'message'), ('log_stream', 'log_stream'), ('service_name', 'service_name'), ('log_level', 'log_level'), ('request_id', 'request_id'), ('duration', 'duration'), ('memory_used', 'memory_used'), ('error_type', 'error_type'), ('error_message', 'error_message'), ('raw_json', "CASE WHEN message LIKE '{%' THEN 1 END")])}
  FROM parsed) ON COLUMNS(*) INTO NAME column_name VALUE pct)""",
)
def validate_logs(spark, sf_dir):
    report = qa.validate_logs(parsed(spark, sf_dir))
    # gaps in whole microseconds: minutes would have to be rounded, and two engines may differ
    gap_us = F.round(F.col("metric") * 60_000_000)
    metric = F.when(F.col("check_name") == "timestamp_continuity", gap_us).otherwise(F.round("metric", 6))
    return report.select("check_name", "passed", metric.alias("metric"))


@query(
    "validate_ranges_types",
    """SELECT 'overall' AS check_name, CAST(NULL AS VARCHAR) AS column_name, false AS passed
UNION ALL SELECT 'data_types', 'l_quantity', true UNION ALL SELECT 'data_types', 'l_returnflag', false
UNION ALL SELECT 'data_types', 'nothing', false
UNION ALL SELECT 'value_ranges', 'l_quantity', count(*) FILTER (l_quantity < 0 OR l_quantity > 40) = 0 FROM lineitem
UNION ALL SELECT DISTINCT 'categorical_values', 'l_returnflag', false FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')""",
)
def validate_ranges_types(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    report = qa.validate_all(
        lines, types={"l_quantity": "double", "l_returnflag": "bigint", "nothing": "int"},
        ranges={"l_quantity": (0, 40)}, categories={"l_returnflag": ["A", "N"]},
    )
    deciding = report.where(~F.col("check_name").isin("missing_values", "duplicates"))
    return deciding.select("check_name", "column_name", "passed")


@query(
    "percentiles_by_type",
    """SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1""",
)
def percentiles_by_type(spark, sf_dir):
    points = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    out = exact_percentiles(table(spark, sf_dir, "events"), ["event_type"], "value", points)
    return out.select("event_type", *[F.round(p, 6).alias(p) for p in points])


@query(
    "nearest_rank_percentiles",
    """SELECT o_orderpriority, max(CASE WHEN i = floor(n * 0.5) THEN v END) AS p50,
  max(CASE WHEN i = floor(n * 0.95) THEN v END) AS p95, max(CASE WHEN i = floor(n * 0.99) THEN v END) AS p99
FROM (SELECT o_orderpriority, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i,
  count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) GROUP BY 1""",
)
def nearest_rank(spark, sf_dir):
    points = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return exact_percentiles(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice", points, nearest_rank=True)


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, sf_dir):
    return st.value_counts(table(spark, sf_dir, "events"), "event_type")


@query("success_rate", "SELECT o_orderpriority, count(*) AS n, round(avg(CAST(o_orderstatus = 'F' AS INTEGER)), 6) AS success_rate FROM orders GROUP BY 1")
def success_rate(spark, sf_dir):
    out = st.success_rate(table(spark, sf_dir, "orders"), ["o_orderpriority"], F.col("o_orderstatus") == "F")
    return out.withColumn("success_rate", F.round("success_rate", 6))


@query("confusion_matrix", f"WITH {PREDICTIONS} SELECT * FROM confusion")
def confusion_matrix(spark, sf_dir):
    return ev.confusion(predictions(spark, sf_dir))


_METRICS = ("accuracy", "precision", "recall", "f1_score", "false_positive_rate", "auc_roc")


@query(
    "evaluate_models",
    f"WITH {PREDICTIONS} SELECT model, tp, fp, tn, fn, {', '.join(f'round({m}, 6) AS {m}' for m in _METRICS)} FROM metrics",
)
def evaluate_models(spark, sf_dir):
    out = ev.evaluate_models(predictions(spark, sf_dir))
    return out.select("model", "tp", "fp", "tn", "fn", *[F.round(m, 6).alias(m) for m in _METRICS])


@query(
    "roc_curve",
    f"""WITH {PREDICTIONS}, steps AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1, 2)
SELECT model, score AS threshold,
  round(sum(neg) OVER w / sum(neg) OVER (PARTITION BY model)::DOUBLE, 6) AS fpr,
  round(sum(pos) OVER w / sum(pos) OVER (PARTITION BY model)::DOUBLE, 6) AS tpr
FROM steps WINDOW w AS (PARTITION BY model ORDER BY score DESC)""",
)
def roc_curve(spark, sf_dir):
    return ev.roc_points(predictions(spark, sf_dir)).select(
        "model", "threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr")
    )


@query(
    "normalised_scores",
    f"""WITH {PREDICTIONS}, iso AS (SELECT id, score FROM preds WHERE model = 'isolation')
SELECT id, round((max(score) OVER () - score) / (max(score) OVER () - min(score) OVER ()), 6) AS probability FROM iso""",
)
def normalised_scores(spark, sf_dir):
    scores = predictions(spark, sf_dir).where("model = 'isolation'").select("id", "score")
    return ev.normalise_scores(scores, "score").select("id", F.round("probability", 6).alias("probability"))


@query(
    "score_summary",
    f"""WITH {PREDICTIONS} SELECT model, count(*) AS n_samples, CAST(sum(prediction) AS BIGINT) AS n_anomalies,
  round(avg(prediction), 6) AS anomaly_rate, min(score) AS score_min, max(score) AS score_max,
  round(avg(score), 6) AS score_mean, round(stddev_pop(score), 6) AS score_std FROM scored GROUP BY 1""",
)
def score_summary(spark, sf_dir):
    out = ev.score_summary(predictions(spark, sf_dir), "score", "prediction", ["model"])
    return out.withColumns({c: F.round(c, 6) for c in ("anomaly_rate", "score_mean", "score_std")})


@query(
    "newest_confusion",
    f"""WITH {PREDICTIONS}, last AS (SELECT * FROM scored WHERE model = 'booster_a' ORDER BY ts DESC, id DESC LIMIT 1000)
SELECT model, {', '.join(f"CAST(sum(CAST({c} AS INTEGER)) AS BIGINT) AS {n}" for n, c in [('tp', 'label = 1 AND prediction = 1'), ('fp', 'label = 0 AND prediction = 1'), ('tn', 'label = 0 AND prediction = 0'), ('fn', 'label = 1 AND prediction = 0')])}
FROM last GROUP BY 1""",
)
def newest_confusion(spark, sf_dir):
    rows = predictions(spark, sf_dir).where("model = 'booster_a'")
    return ev.confusion(ev.newest_rows(rows, "timestamp", "id", 1000))


@query(
    "predictions_with_truth",
    """SELECT quality, CAST(d.n_chars > 1000 AS INTEGER) AS prediction, count(*) AS n
FROM documents d JOIN labels USING (doc_id) GROUP BY 1, 2""",
)
def predictions_with_truth(spark, sf_dir):
    guesses = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("prediction"))
    joined = ev.join_truth(guesses, table(spark, sf_dir, "labels"), "doc_id")
    return joined.groupBy("quality", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query(
    "model_disagreement",
    f"""WITH {PREDICTIONS} SELECT count(*) AS compared, count(*) FILTER (a.prediction <> b.prediction) AS different,
  round(avg(CAST(a.prediction <> b.prediction AS INTEGER)), 6) AS disagreement_rate
FROM scored a JOIN scored b ON a.id = b.id AND a.model = 'booster_a' AND b.model = 'booster_b'""",
)
def model_disagreement(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    out = ev.disagreement(rows.where("model = 'booster_a'"), rows.where("model = 'booster_b'"), "id")
    return out.withColumn("disagreement_rate", F.round("disagreement_rate", 6))


@query(
    "best_model",
    f"WITH {PREDICTIONS} SELECT model, round(f1_score, 6) AS f1_score FROM metrics ORDER BY f1_score DESC, model LIMIT 1",
)
def best_model(spark, sf_dir):
    best = st.best_row(ev.evaluate_models(predictions(spark, sf_dir)), "f1_score", "model")
    return best.select("model", F.round("f1_score", 6).alias("f1_score"))


@query(
    "readiness_check",
    f"""WITH {PREDICTIONS}, best AS (SELECT * FROM metrics ORDER BY f1_score DESC, model LIMIT 1)
SELECT model, metric, round(value, 6) AS value, required, CASE WHEN value >= required THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT model, 'accuracy' AS metric, accuracy AS value, 0.85::DOUBLE AS required FROM best
  UNION ALL SELECT model, 'f1_score', f1_score, 0.80 FROM best
  UNION ALL SELECT model, 'precision', precision, 0.85 FROM best
  UNION ALL SELECT model, 'recall', recall, 0.75 FROM best)""",
)
def readiness_check(spark, sf_dir):
    out = ev.readiness(ev.evaluate_models(predictions(spark, sf_dir)))
    return out.select("model", "metric", F.round("value", 6).alias("value"), "required", "status")


@query(
    "mean_time_to_resolution",
    """SELECT o_orderpriority, round(avg((epoch_us(s) - epoch_us(o_orderdate)) / 60e6), 4) AS mttr_minutes, count(s) AS resolved
FROM (SELECT o_orderkey, o_orderpriority, o_orderdate, max(l_shipdate) AS s FROM orders
  LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate GROUP BY 1, 2, 3) GROUP BY 1""",
)
def mean_time_to_resolution(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    later = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate"))
    closed = orders.join(lines, later, "left").groupBy("o_orderkey", "o_orderpriority", "o_orderdate").agg(
        F.max("l_shipdate").alias("s")
    )
    out = st.resolution_time(closed, "o_orderdate", "s", ["o_orderpriority"])
    return out.withColumn("mttr_minutes", F.round("mttr_minutes", 4))


_SPLIT = """h AS (SELECT *, CAST('0x' || substr(md5(concat(CAST({id} AS VARCHAR), ':42')), 1, 13) AS BIGINT) AS hv FROM {t}),
placed AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY hv, {id}) AS place,
  count(*) OVER (PARTITION BY {label}) AS n FROM h)"""


@query(
    "stratified_split_80_20",
    f"""WITH {_SPLIT.format(id='o_orderkey', t='orders', label='o_orderstatus')}
SELECT o_orderkey, CASE WHEN place <= floor(n * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS split FROM placed""",
)
def split_80_20(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sp.stratified_split(orders, "o_orderkey", "o_orderstatus", {"train": 0.8, "test": 0.2}).select("o_orderkey", "split")


@query(
    "stratified_split_70_15_15",
    f"""WITH {_SPLIT.format(id='event_id', t='events', label='event_type')}
SELECT event_id, CASE WHEN place <= floor(n * 0.7 + 0.5) THEN 'train' WHEN place <= floor(n * 0.85 + 0.5) THEN 'val'
  ELSE 'test' END AS split FROM placed""",
)
def split_70_15_15(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    shares = {"train": 0.7, "val": 0.15, "test": 0.15}
    return sp.stratified_split(events, "event_id", "event_type", shares).select("event_id", "split")


@query(
    "stratified_folds",
    f"""WITH {_SPLIT.format(id='event_id', t='events', label='event_type')}
SELECT event_id, CAST((place - 1) % 3 AS INTEGER) AS fold FROM placed""",
)
def folds(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return sp.stratified_folds(events, "event_id", "event_type").select("event_id", "fold")


@query(
    "label_priority_union",
    """SELECT doc_id, label, source FROM (
  SELECT doc_id, toxic AS label, 0 AS source FROM labels
  UNION ALL SELECT doc_id, CAST(lang = 'en' AS INTEGER), 1 FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT doc_id, CAST(n_chars > 1000 AS INTEGER), 2 FROM documents)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY source) = 1""",
)
def label_priority_union(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    original = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    manual = docs.where("doc_id % 3 = 0").select("doc_id", (F.col("lang") == "en").cast("int").alias("label"))
    pseudo = docs.select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("label"))
    return sp.label_priority_union([original, manual, pseudo], "doc_id", ["label"])


_STRATUM = """CASE WHEN event_type = 'error' AND user_id % 4 = 0 THEN 'critical_service' WHEN value > 150 THEN 'low_confidence'
  WHEN value > 80 THEN 'borderline_normal' ELSE 'other' END"""


@query(
    "review_sample",
    f"""SELECT event_id, stratum FROM (SELECT event_id, {_STRATUM} AS stratum,
  CAST('0x' || substr(md5(concat(CAST(event_id AS VARCHAR), ':42')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM events)
WHERE u < CASE stratum WHEN 'critical_service' THEN 1.0 WHEN 'low_confidence' THEN 0.2 WHEN 'borderline_normal' THEN 0.05 END""",
)
def review_sample(spark, sf_dir):
    rates = {"critical_service": 1.0, "low_confidence": 0.2, "borderline_normal": 0.05}
    return sp.review_sample(table(spark, sf_dir, "events"), "event_id", F.expr(_STRATUM), rates).select("event_id", "stratum")


@query(
    "confidence_tiers",
    """SELECT tier, count(*) AS n FROM (SELECT CASE WHEN s < -0.6 THEN 'high_anomaly' WHEN s < -0.3 THEN 'medium_anomaly'
  WHEN s < 0 THEN 'low_anomaly' WHEN s < 0.3 THEN 'low_normal' ELSE 'high_normal' END AS tier
  FROM (SELECT (event_id % 201 - 100) / 100.0 AS s FROM events)) GROUP BY 1""",
)
def confidence_tiers(spark, sf_dir):
    from emberlog.operators.labels import confidence_tier

    scored = table(spark, sf_dir, "events").select(((F.col("event_id") % 201 - 100) / 100.0).alias("score"))
    return confidence_tier(scored).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


@query(
    "high_confidence_anomalies",
    f"WITH {PREDICTIONS} SELECT model, id FROM scored WHERE prediction = 1 AND score > 0.85",
)
def high_confidence_anomalies(spark, sf_dir):
    from emberlog.operators.labels import high_confidence

    return high_confidence(predictions(spark, sf_dir).withColumnRenamed("score", "probability")).select("model", "id")


@query(
    "retrain_window",
    """SELECT event_type, count(*) AS n FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 14 DAY GROUP BY 1""",
)
def retrain_window(spark, sf_dir):
    return keep_recent(table(spark, sf_dir, "events"), 14, "ts").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "list_log_streams",
    f"""WITH {PARSED} SELECT log_stream, epoch_us(max(ts)) AS last_us, count(*) AS events FROM parsed
WHERE log_stream IS NOT NULL GROUP BY 1 ORDER BY max(ts) DESC, log_stream LIMIT 50""",
)
def list_log_streams(spark, sf_dir):
    out = list_streams(log_events(spark, sf_dir))
    return out.select("log_stream", F.unix_micros("last_event").alias("last_us"), "events")


@query(
    "bounded_log_scan",
    f"""WITH {PARSED} SELECT event_id, message FROM parsed WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-12'
  AND message LIKE '%ERROR%' ORDER BY ts, event_id LIMIT 10000""",
)
def bounded_log_scan(spark, sf_dir):
    from datetime import datetime

    found = scan_events(log_events(spark, sf_dir), datetime(2024, 1, 10), datetime(2024, 1, 12), "ERROR", limit=10000)
    return found.select("event_id", "message")
