"""Streaming queries, run once over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberlog.operators.experiment import weighted_choice
from emberlog.operators.features import error_features, performance_features
from emberlog.operators.parse import parse_logs
from emberlog.operators.splits import hash_fraction
from emberlog.plans.log_sql import PARSED
from emberlog.plans.registry import query
from emberlog.sources.tables import LOG_STREAM_SQL, MESSAGE_SQL
from emberlog.streaming import logs as sl
from emberlog.streaming import stateful as ss


def log_stream(spark, sf_dir):
    events = sl.stream_table(spark, sf_dir, "events")
    raw = events.select(
        "event_id", F.col("ts").alias("timestamp"), "user_id", "event_type", "value",
        F.expr(MESSAGE_SQL.replace("VARCHAR(20)", "STRING")).alias("message"),
        F.expr(LOG_STREAM_SQL.replace("VARCHAR(20)", "STRING")).alias("log_stream"),
    )
    return parse_logs(raw)


@query(
    "stream_tail",
    f"WITH {PARSED} SELECT event_id, service_name, log_level FROM parsed WHERE message LIKE '%connect%'",
)
def stream_tail(spark, sf_dir):
    tail = log_stream(spark, sf_dir).where(F.col("message").contains("connect"))
    return sl.run_once(tail.select("event_id", "service_name", "log_level"))


@query("stream_deduplicate", "SELECT event_id, epoch_us(ts) AS ts_us FROM events")
def stream_deduplicate(spark, sf_dir):
    events = sl.stream_table(spark, sf_dir, "events").select("event_id", "ts")
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    unique = sl.drop_boundary_duplicates(twice, "event_id", "ts").drop("copy")
    return sl.run_once(unique).select("event_id", F.unix_micros("ts").alias("ts_us"))


@query(
    "stream_windowed_rates",
    f"""WITH {PARSED}, w AS (SELECT ts, log_level, CAST(log_level = 'ERROR' OR error_type IS NOT NULL AS INTEGER) AS has_error, duration,
    unnest(range(0, 5)) AS back FROM parsed),
s AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) - back * INTERVAL 1 MINUTE AS start, log_level, has_error, duration FROM w)
SELECT epoch_us(start) AS window_us, count(log_level) AS request_count, CAST(sum(has_error) AS BIGINT) AS error_count,
  round(avg(has_error), 6) AS error_rate, round(avg(duration), 6) AS avg_duration, max(duration) AS max_duration
FROM s GROUP BY 1""",
)
def stream_windowed_rates(spark, sf_dir):
    stream = log_stream(spark, sf_dir).transform(error_features).transform(performance_features)
    # update mode: the newest windows, which no later event closes, are in the result too
    updates = sl.run_once(sl.windowed_rates(stream), mode="update")
    out = sl.latest_update(updates, ["window_start", "window_end"])
    return out.select(
        F.unix_micros("window_start").alias("window_us"), "request_count", "error_count",
        F.round("error_rate", 6).alias("error_rate"), F.round("avg_duration", 6).alias("avg_duration"), "max_duration",
    )


@query(
    "stream_daily_counters",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, CAST(value > 50 AS INTEGER) AS prediction, count(*) AS predictions,
  round(sum(value), 4) AS total_latency FROM events GROUP BY 1, 2, 3""",
)
def stream_daily_counters(spark, sf_dir):
    stream = sl.stream_table(spark, sf_dir, "events").withColumn("prediction", (F.col("value") > 50).cast("int"))
    updates = sl.run_once(sl.daily_counters(stream, "ts", "event_type", "prediction", "value"), mode="update")
    out = sl.latest_update(updates, ["day", "event_type", "prediction"])
    return out.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "prediction", "predictions",
        F.round("total_latency", 4).alias("total_latency"),
    )


@query(
    "late_rows",
    """WITH a AS (SELECT event_id, epoch_us(ts) AS t, epoch_us(ts) + (event_id % 11) * 300000000 AS arrived FROM events),
s AS (SELECT *, max(t) OVER (ORDER BY arrived RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM a)
SELECT event_id, coalesce(t < newest - 600000000, false) AS is_late FROM s""",
)
def late_rows(spark, sf_dir):
    from emberlog.sources.tables import table

    delay = F.make_dt_interval(mins=(F.col("event_id") % 11 * 5).cast("int"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("ts") + delay).alias("arrived"))
    return sl.split_late(events, "ts", "arrived").select("event_id", "is_late")


@query(
    "stream_sticky_assignment",
    """WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, epoch_us(ts) AS t, CASE WHEN CAST('0x' || substr(md5(
    concat(CAST(user_id AS VARCHAR), CAST(CAST(ts AS DATE) AS VARCHAR))), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.5 THEN 'a' ELSE 'b' END AS offered FROM events),
taken(user_id, at_us) AS (SELECT user_id, min(t) FROM e GROUP BY 1
  UNION ALL SELECT k.user_id, (SELECT min(t) FROM e WHERE e.user_id = k.user_id AND t - k.at_us >= 604800000000) FROM taken k
    WHERE EXISTS (SELECT 1 FROM e WHERE e.user_id = k.user_id AND t - k.at_us >= 604800000000)),
named AS (SELECT k.user_id, k.at_us, e.offered FROM taken k JOIN e ON e.user_id = k.user_id AND e.t = k.at_us)
SELECT e.user_id, e.event_id AS row_id, n.offered AS variant_id, e.t > n.at_us AS was_sticky
FROM e ASOF JOIN named n ON e.user_id = n.user_id AND e.t >= n.at_us""",
)
def stream_sticky_assignment(spark, sf_dir):
    events = sl.stream_table(spark, sf_dir, "events")
    # the offered variant depends on the day, so that only the state keeps it stable
    offered = weighted_choice(hash_fraction(F.col("user_id"), F.to_date("ts")), {"a": 0.5, "b": 0.5})
    requests = events.select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_id").alias("row_id"),
        F.col("ts").alias("timestamp"), offered.alias("offered"),
    )
    return sl.run_once(ss.sticky_assignments(requests))


@query("stream_alert_notices")
def stream_alert_notices(spark, sf_dir):
    events = sl.stream_table(spark, sf_dir, "events")
    samples = events.select(
        F.concat(F.lit("user-"), (F.col("user_id") % 20).cast("string")).alias("series"), "ts",
        (F.col("event_type") != "error").alias("active"), F.lit(3600).alias("for_seconds"),
    )
    return sl.run_once(ss.held_alert_notices(samples))
