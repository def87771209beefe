"""Parsing, feature and label queries over the log events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.binning import bucketize, is_finite
from emberlog.functions.parsing import (
    level_from_text,
    matches_filter,
    parse_epoch,
    parse_text_timestamp,
    service_from_stream,
    to_number,
)
from emberlog.operators import features as ft
from emberlog.operators.labels import label_anomalies, label_cutoffs
from emberlog.operators.parse import parse_logs
from emberlog.plans.log_sql import FEATURES, LABELLED, PARSED, RAW
from emberlog.plans.registry import query
from emberlog.session import stored
from emberlog.sources.tables import log_events, table

SERVICES = ("apigateway", "batch", "ecs", "lambda", "rds", "unknown")


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_logs(log_events(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    rows = parsed(spark, sf_dir) if rows is None else rows
    return ft.create_features(rows, services=SERVICES)


def cutoffs(rows: DataFrame) -> DataFrame:
    return label_cutoffs(rows.transform(ft.performance_features).transform(ft.fill_zero))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with labels. The parsed rows feed the features, the windows and the
    cutoffs, so they are parsed once and stored."""
    rows = stored(parsed(spark, sf_dir))
    return label_anomalies(features(spark, sf_dir, rows), cutoffs(rows))


@query(
    "anomalies_by_service_day",
    f"""WITH {LABELLED}
SELECT service_name, strftime(ts, '%Y-%m-%d') AS day, count(*) AS events,
  CAST(sum(is_anomaly) AS BIGINT) AS anomalies, round(avg(error_rate), 9) AS mean_error_rate
FROM labelled GROUP BY 1, 2""",
)
def anomalies_by_service_day(spark, sf_dir):
    return (
        labelled(spark, sf_dir)
        .groupBy("service_name", F.date_format("timestamp", "yyyy-MM-dd").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("is_anomaly").alias("anomalies"),
            F.round(F.avg("error_rate"), 9).alias("mean_error_rate"),
        )
    )


@query(
    "parse_log_entries",
    f"""WITH {PARSED}
SELECT event_id, ts_us, service_name, log_level, request_id, duration, memory_used, error_type, error_message,
  CASE WHEN message LIKE '{{%' THEN message END AS raw_json
FROM parsed""",
)
def parse_log_entries(spark, sf_dir):
    return parsed(spark, sf_dir).select(
        "event_id", F.unix_micros("timestamp").alias("ts_us"), "service_name", "log_level", "request_id",
        "duration", "memory_used", "error_type", "error_message", "raw_json",
    )


@query(
    "parse_json_objects",
    f"""WITH {PARSED}
SELECT (message LIKE '{{%') AS is_json, log_level, count(*) AS n FROM parsed GROUP BY 1, 2""",
)
def parse_json_objects(spark, sf_dir):
    return (
        parsed(spark, sf_dir)
        .groupBy(F.col("raw_json").isNotNull().alias("is_json"), "log_level")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "extract_levels_from_text",
    """SELECT CASE WHEN regexp_matches(lower(text), 'error|exception|failed|timeout|cannot|unable|denied') THEN 'ERROR'
         WHEN regexp_matches(lower(text), 'warning|warn|deprecated|retry') THEN 'WARN'
         WHEN lower(text) LIKE '%info%' THEN 'INFO'
         WHEN lower(text) LIKE '%debug%' THEN 'DEBUG' ELSE 'INFO' END AS log_level,
       lang, count(*) AS n FROM documents GROUP BY 1, 2""",
)
def extract_levels_from_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy(level_from_text(F.col("text")).alias("log_level"), "lang").agg(F.count(F.lit(1)).alias("n"))


@query(
    "extract_service_names",
    f"""WITH {RAW} SELECT CASE WHEN len(string_split(log_stream, '/')) >= 3
  THEN string_split(log_stream, '/')[3] ELSE 'unknown' END AS service_name, count(*) AS n
FROM raw GROUP BY 1""",
)
def extract_service_names(spark, sf_dir):
    logs = log_events(spark, sf_dir)
    return logs.groupBy(service_from_stream(F.col("log_stream")).alias("service_name")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "parse_timestamps",
    """SELECT event_id, epoch_us(date_trunc('second', ts)) AS from_seconds,
  epoch_us(date_trunc('millisecond', ts)) AS from_millis,
  epoch_us(CASE WHEN event_id % 3 = 1 THEN date_trunc('second', ts) ELSE ts END) AS from_text
FROM events""",
)
def parse_timestamps(spark, sf_dir):
    ts = F.col("ts")
    text = (
        F.when(F.col("event_id") % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(F.col("event_id") % 3 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_micros(parse_epoch(F.unix_seconds(ts))).alias("from_seconds"),
        F.unix_micros(parse_epoch(F.unix_millis(ts))).alias("from_millis"),
        F.unix_micros(parse_text_timestamp(text)).alias("from_text"),
    )


@query(
    "coerce_numbers",
    """SELECT event_type, count(n) AS good, count(*) - count(n) AS bad, round(sum(n), 4) AS total
FROM (SELECT event_type, TRY_CAST(CASE WHEN event_id % 4 = 0 THEN event_type
  ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS n FROM events) GROUP BY 1""",
)
def coerce_numbers(spark, sf_dir):
    mixed = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    numbers = table(spark, sf_dir, "events").select("event_type", to_number(mixed).alias("n"))
    return numbers.groupBy("event_type").agg(
        F.count("n").alias("good"),
        (F.count(F.lit(1)) - F.count("n")).alias("bad"),
        F.round(F.sum("n"), 4).alias("total"),
    )


@query(
    "time_features",
    f"""WITH {FEATURES} SELECT event_id, hour, day_of_week, day_of_month, month, year, is_weekend,
  is_business_hours, time_of_day FROM features""",
)
def time_features(spark, sf_dir):
    return ft.time_features(log_events(spark, sf_dir)).select(
        "event_id", "hour", "day_of_week", "day_of_month", "month", "year", "is_weekend",
        "is_business_hours", "time_of_day",
    )


@query(
    "bucketize_values",
    """SELECT band, count(*) AS n, round(sum(value), 4) AS total FROM (
  SELECT value, CASE WHEN value < 0 OR value > 500 THEN NULL WHEN value <= 10 THEN 'low' WHEN value <= 100 THEN 'mid'
    ELSE 'high' END AS band FROM events) GROUP BY 1""",
)
def bucketize_values(spark, sf_dir):
    band = bucketize(F.col("value"), [0, 10, 100, 500], ["low", "mid", "high"])
    return table(spark, sf_dir, "events").groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query(
    "level_features",
    f"""WITH {FEATURES} SELECT event_id, log_severity,
  {', '.join(f"coalesce(log_level = '{v}', false) AS log_level_{v}" for v in ft.LEVELS)} FROM features""",
)
def level_features(spark, sf_dir):
    return ft.level_features(parsed(spark, sf_dir)).select(
        "event_id", "log_severity", *[f"log_level_{v}" for v in ft.LEVELS]
    )


_OCCURRING = ("CLICK", "PURCHASE", "SIGNUP", "VIEW")


@query(
    "occurring_level_features",
    f"""SELECT event_id, {', '.join(f"coalesce(upper(event_type) = '{v}', false) AS log_level_{v}" for v in (*ft.LEVELS, *_OCCURRING))} FROM events""",
)
def occurring_level_features(spark, sf_dir):
    """Levels outside the fixed vocabulary get columns of their own."""
    logs = table(spark, sf_dir, "events").select("event_id", F.upper("event_type").alias("log_level"))
    return ft.level_features(logs, ft.occurring_levels(logs)).drop("log_level", "log_severity")


@query(
    "error_features",
    f"""WITH {FEATURES} SELECT event_id, has_error, error_type_encoded, error_message_length FROM features""",
)
def error_features(spark, sf_dir):
    logs = ft.error_features(parsed(spark, sf_dir))
    return ft.encode_ordinal(logs, "error_type", "error_type_encoded", null_as="None").select(
        "event_id", "has_error", "error_type_encoded", "error_message_length"
    )


@query(
    "performance_features",
    f"""WITH {FEATURES} SELECT event_id, round(duration_log, 6) AS duration_log, is_slow,
  round(memory_used_mb, 6) AS memory_used_mb FROM features""",
)
def performance_features(spark, sf_dir):
    return ft.performance_features(parsed(spark, sf_dir)).select(
        "event_id", F.round("duration_log", 6).alias("duration_log"), "is_slow",
        F.round("memory_used_mb", 6).alias("memory_used_mb"),
    )


@query(
    "service_features",
    f"""WITH {FEATURES} SELECT event_id, service_encoded,
  {', '.join(f"CAST(service_name = '{v}' AS INTEGER) AS service_{v}" for v in SERVICES)} FROM features""",
)
def service_features(spark, sf_dir):
    return ft.service_features(parsed(spark, sf_dir)).select(
        "event_id", "service_encoded", *[f"service_{v}" for v in SERVICES]
    )


@query(
    "top_values_one_hot",
    """WITH top AS (SELECT text, row_number() OVER (ORDER BY count(*) DESC, text) AS place
  FROM (SELECT concat(c_mktsegment, '|', CAST(c_nationkey AS VARCHAR)) AS text FROM customer) GROUP BY text
  QUALIFY place <= 10)
SELECT place, text AS value, count(*) AS hits FROM top
JOIN (SELECT concat(c_mktsegment, '|', CAST(c_nationkey AS VARCHAR)) AS text FROM customer) USING (text)
GROUP BY 1, 2""",
)
def top_values_one_hot(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.concat_ws("|", "c_mktsegment", "c_nationkey").alias("text"))
    names = ft.vocabulary(rows, "text", 10)
    hot = ft.one_hot(rows, "text", names, "v")
    counted = hot.agg(*[F.sum(F.col(f"`v_{v}`")).alias(f"p{i}") for i, v in enumerate(names)])
    return counted.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i + 1).cast("bigint").alias("place"), F.lit(v).alias("value"), F.col(f"p{i}").alias("hits"))
                    for i, v in enumerate(names)
                ]
            )
        ).alias("r")
    ).select("r.*")


@query(
    "ordinal_codes",
    """SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS code FROM part""",
)
def ordinal_codes(spark, sf_dir):
    return ft.encode_ordinal(table(spark, sf_dir, "part"), "p_name", "code", limit=100).select("p_partkey", "code")


@query(
    "text_features",
    f"""WITH {FEATURES} SELECT event_id, message_length, word_count,
  {', '.join(f'has_{n}' for n in ft.KEYWORD_PATTERNS)} FROM features""",
)
def text_features(spark, sf_dir):
    return ft.text_features(log_events(spark, sf_dir)).select(
        "event_id", "message_length", "word_count", *[f"has_{n}" for n in ft.KEYWORD_PATTERNS]
    )


_DOC_FLAGS = ", ".join(
    f"CAST(sum(CAST(regexp_matches(lower(text), '{p}') AS INTEGER)) AS BIGINT) AS has_{n}"
    for n, p in ft.KEYWORD_PATTERNS.items()
)


@query(
    "document_keywords",
    f"""SELECT lang, {_DOC_FLAGS}, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1""",
)
def document_keywords(spark, sf_dir):
    docs = ft.text_features(table(spark, sf_dir, "documents").withColumnRenamed("text", "message"))
    return docs.groupBy("lang").agg(
        *[F.sum(f"has_{n}").alias(f"has_{n}") for n in ft.KEYWORD_PATTERNS],
        F.sum("message_length").alias("chars"),
    )


_ROLLING = """event_id, CAST(error_count AS BIGINT) AS error_count, round(error_rate, 6) AS error_rate,
  request_count, round(avg_duration, 6) AS avg_duration, max_duration"""


@query("rolling_features", f"WITH {FEATURES} SELECT {_ROLLING} FROM features")
def rolling_features(spark, sf_dir):
    rolled = ft.error_features(parsed(spark, sf_dir)).transform(ft.rolling_features).transform(ft.fill_zero)
    return rolled.select(
        "event_id", "error_count", F.round("error_rate", 6).alias("error_rate"), "request_count",
        F.round("avg_duration", 6).alias("avg_duration"), "max_duration",
    )


_NUMERIC = [
    "duration", "memory_used", "hour", "day_of_week", "day_of_month", "month", "year", "is_weekend",
    "is_business_hours", "log_severity", "has_error", "error_type_encoded", "error_message_length",
    "is_slow", "service_encoded", "message_length", "word_count",
    *[f"has_{n}" for n in ft.KEYWORD_PATTERNS], "request_count", "max_duration",
]


@query(
    "all_features",
    f"""WITH {FEATURES} SELECT event_id, {', '.join(_NUMERIC)}, CAST(error_count AS BIGINT) AS error_count,
  round(error_rate, 6) AS error_rate, round(avg_duration, 6) AS avg_duration,
  round(duration_log, 6) AS duration_log, round(memory_used_mb, 6) AS memory_used_mb, time_of_day FROM features""",
)
def all_features(spark, sf_dir):
    rounded = ["error_rate", "avg_duration", "duration_log", "memory_used_mb"]
    return features(spark, sf_dir).select(
        "event_id", *_NUMERIC, "error_count", *[F.round(c, 6).alias(c) for c in rounded], "time_of_day"
    )


@query(
    "label_cutoffs",
    f"""WITH {LABELLED} SELECT round(mc, 6) AS memory_cut, round(dc, 6) AS duration_cut FROM cuts""",
)
def label_cutoff_values(spark, sf_dir):
    return cutoffs(parsed(spark, sf_dir)).select(
        F.round("memory_cut", 6).alias("memory_cut"), F.round("duration_cut", 6).alias("duration_cut")
    )


@query("label_anomalies", f"WITH {LABELLED} SELECT event_id, is_anomaly FROM labelled")
def label_rows(spark, sf_dir):
    return labelled(spark, sf_dir).select("event_id", "is_anomaly")


@query(
    "label_ratio",
    f"WITH {LABELLED} SELECT count(*) AS n, round(avg(is_anomaly), 6) AS anomaly_ratio FROM labelled",
)
def label_ratio(spark, sf_dir):
    return labelled(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("is_anomaly"), 6).alias("anomaly_ratio")
    )


_SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "standard_scaling",
    "WITH s AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)
    + " FROM lineitem) SELECT l_returnflag, "
    + ", ".join(f"round(avg(({c} - m_{c}) / s_{c}), 5) AS {c}_mean, round(stddev_pop(({c} - m_{c}) / s_{c}), 5) AS {c}_spread" for c in _SCALED)
    + " FROM lineitem, s GROUP BY 1",
)
def standard_scaling(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", *_SCALED)
    scaled = ft.apply_scaler(lines, ft.fit_scaler(lines, _SCALED), _SCALED)
    return scaled.groupBy("l_returnflag").agg(
        *[F.round(F.avg(c), 5).alias(f"{c}_mean") for c in _SCALED],
        *[F.round(F.stddev_pop(c), 5).alias(f"{c}_spread") for c in _SCALED],
    )


@query(
    "clean_vectors",
    """SELECT event_id, CASE WHEN event_id % 10 IN (0, 1, 2) THEN 0.0 ELSE value END AS first,
  CAST(user_id AS DOUBLE) AS second FROM events""",
)
def clean_vectors(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    kind = F.col("event_id") % 10
    dirty = (
        F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, F.lit(float("-inf"))).when(kind == 2, F.lit(None))
        .otherwise(F.col("value"))
    )
    rows = table(spark, sf_dir, "events").select("event_id", dirty.alias("a"), F.col("user_id").alias("b"))
    vectors = ft.clean_vector(rows, ["a", "b"]).withColumn("v", vector_to_array("features"))
    return vectors.select("event_id", F.col("v")[0].alias("first"), F.col("v")[1].alias("second"))


@query(
    "finite_value_check",
    """SELECT event_type, count(*) AS n, CAST(sum(CASE WHEN event_id % 10 < 2 THEN 0 ELSE 1 END) AS BIGINT) AS finite
FROM events GROUP BY 1""",
)
def finite_value_check(spark, sf_dir):
    kind = F.col("event_id") % 10
    dirty = (
        F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, F.lit(float("inf"))).otherwise(-F.col("value"))
    )
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_finite(dirty)).alias("finite")
    )


@query(
    "lag_features",
    """SELECT event_id, lag(value, 1) OVER w AS value_lag_1, lag(value, 5) OVER w AS value_lag_5,
  lag(value, 15) OVER w AS value_lag_15
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
)
def lag_features(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return ft.lag_features(events, ["event_type"], ["ts", "event_id"], "value").select(
        "event_id", "value_lag_1", "value_lag_5", "value_lag_15"
    )


@query(
    "rate_of_change",
    """SELECT event_id, round(CASE WHEN p <> 0 THEN (value - p) / p END, 6) AS value_change FROM (
  SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)""",
)
def rate_of_change(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return ft.rate_of_change(events, ["user_id"], ["ts", "event_id"], "value").select(
        "event_id", F.round("value_change", 6).alias("value_change")
    )


@query(
    "rolling_statistics",
    """SELECT event_id, round(avg(value) OVER w, 5) AS value_mean, round(stddev_samp(value) OVER w, 5) AS value_std,
  min(value) OVER w AS value_min, max(value) OVER w AS value_max, round(sum(value) OVER w, 5) AS value_sum
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)""",
)
def rolling_statistics(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    rolled = ft.rolling_statistics(events, "ts", "value", 3_600_000_000, ["event_type"])
    return rolled.select(
        "event_id", F.round("value_mean", 5).alias("value_mean"), F.round("value_std", 5).alias("value_std"),
        "value_min", "value_max", F.round("value_sum", 5).alias("value_sum"),
    )


@query(
    "rolling_anomaly_percent",
    """SELECT event_id, round(100 * avg(CAST(event_type = 'error' AS INTEGER)) OVER w, 6) AS anomaly_percent
FROM events WINDOW w AS (ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)""",
)
def rolling_anomaly_percent(spark, sf_dir):
    from emberlog.operators.ordered import trailing_window

    hit = (F.col("event_type") == "error").cast("int")
    rolled = trailing_window(
        table(spark, sf_dir, "events").select("event_id", "ts", "event_type"), "ts", 3_600_000_000,
        {"hits": ("sum", hit), "rows": ("count", F.lit(1))},
    )
    return rolled.select("event_id", F.round(100 * F.col("hits") / F.col("rows"), 6).alias("anomaly_percent"))


@query(
    "filter_time_range_and_text",
    f"""WITH {RAW} SELECT event_id, epoch_us(ts) AS ts_us, message FROM raw
WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20 12:00:00'
  AND message LIKE '%connect%' AND NOT message LIKE '%level%' AND (message LIKE '%timeout%' OR message LIKE '%retry%')""",
)
def filter_time_range_and_text(spark, sf_dir):
    from emberlog.sources.logs import in_time_range

    logs = in_time_range(log_events(spark, sf_dir), "2024-01-05", "2024-01-20 12:00:00")
    return logs.where(matches_filter(F.col("message"), "connect -level ?timeout ?retry")).select(
        "event_id", F.unix_micros("timestamp").alias("ts_us"), "message"
    )
