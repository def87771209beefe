"""SQL building blocks shared by the log oracles."""

from emberlog.operators.features import KEYWORD_PATTERNS
from emberlog.sources.tables import LOG_STREAM_SQL, MESSAGE_SQL

RAW = f"""raw AS (
  SELECT event_id, ts, epoch_us(ts) AS ts_us, user_id, event_type, value,
         {MESSAGE_SQL} AS message, {LOG_STREAM_SQL} AS log_stream
  FROM events)"""

PARSED = f"""{RAW},
parsed AS (
  SELECT event_id, ts, ts_us, message, log_stream,
    CASE WHEN len(string_split(log_stream, '/')) >= 3
         THEN string_split(log_stream, '/')[3] ELSE 'unknown' END AS service_name,
    CASE WHEN message LIKE '{{%' THEN coalesce(json_extract_string(message, '$.level'), 'INFO')
         WHEN regexp_matches(lower(message), 'error|exception|failed|timeout|cannot|unable|denied') THEN 'ERROR'
         WHEN regexp_matches(lower(message), 'warning|warn|deprecated|retry') THEN 'WARN'
         WHEN lower(message) LIKE '%info%' THEN 'INFO'
         WHEN lower(message) LIKE '%debug%' THEN 'DEBUG' ELSE 'INFO' END AS log_level,
    CASE WHEN message LIKE '{{%' THEN json_extract_string(message, '$.requestId') END AS request_id,
    CASE WHEN message LIKE '{{%' THEN CAST(json_extract_string(message, '$.duration') AS DOUBLE) END AS duration,
    CASE WHEN message LIKE '{{%' THEN CAST(json_extract_string(message, '$.memoryUsed') AS DOUBLE) END AS memory_used,
    CASE WHEN message LIKE '{{%' THEN json_extract_string(message, '$.errorType') END AS error_type,
    CASE WHEN message LIKE '{{%' THEN json_extract_string(message, '$.errorMessage') END AS error_message
  FROM raw)"""

_KEYWORDS = ",\n    ".join(
    f"CAST(regexp_matches(lower(message), '{p}') AS INTEGER) AS has_{n}" for n, p in KEYWORD_PATTERNS.items()
)

FEATURES = f"""{PARSED},
errs AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code
         FROM (SELECT DISTINCT coalesce(error_type, 'None') AS v FROM parsed)),
svcs AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code
         FROM (SELECT DISTINCT service_name AS v FROM parsed)),
base AS (
  SELECT p.*, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, day(ts) AS day_of_month,
    month(ts) AS month, year(ts) AS year,
    CAST(isodow(ts) IN (6, 7) AS INTEGER) AS is_weekend,
    CAST(hour(ts) >= 9 AND hour(ts) < 17 AND isodow(ts) < 6 AS INTEGER) AS is_business_hours,
    CASE WHEN hour(ts) <= 6 THEN 'night' WHEN hour(ts) <= 12 THEN 'morning'
         WHEN hour(ts) <= 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day,
    CASE log_level WHEN 'DEBUG' THEN 1 WHEN 'INFO' THEN 2 WHEN 'WARN' THEN 3
                   WHEN 'ERROR' THEN 4 WHEN 'FATAL' THEN 5 ELSE 2 END AS log_severity,
    CAST(coalesce(log_level = 'ERROR', false) OR error_type IS NOT NULL AS INTEGER) AS has_error,
    errs.code AS error_type_encoded,
    length(coalesce(error_message, '')) AS error_message_length,
    ln(1 + coalesce(duration, 0)) AS duration_log,
    CAST(coalesce(duration > 3000, false) AS INTEGER) AS is_slow,
    memory_used / 1048576 AS memory_used_mb,
    coalesce(svcs.code, -1) AS service_encoded,
    length(message) AS message_length,
    len(regexp_extract_all(message, '\\S+')) AS word_count,
    {_KEYWORDS}
  FROM parsed p
  LEFT JOIN errs ON errs.v = coalesce(p.error_type, 'None')
  LEFT JOIN svcs ON svcs.v = p.service_name),
rolled AS (
  SELECT *, sum(has_error) OVER w AS error_count, avg(has_error) OVER w AS error_rate,
    count(log_level) OVER w AS request_count, avg(duration) OVER w AS avg_duration0,
    max(duration) OVER w AS max_duration0
  FROM base WINDOW w AS (ORDER BY ts_us RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW)),
features AS (
  SELECT * REPLACE (coalesce(duration, 0) AS duration, coalesce(memory_used, 0) AS memory_used),
    coalesce(avg_duration0, 0) AS avg_duration, coalesce(max_duration0, 0) AS max_duration
  FROM rolled)"""

LABELLED = f"""{FEATURES},
cuts AS (SELECT quantile_cont(memory_used_mb, 0.95) AS mc, quantile_cont(duration, 0.95) AS dc FROM features),
labelled AS (
  SELECT f.*, CAST(coalesce(log_level = 'ERROR', false) OR has_error = 1 OR error_rate > 0.1 OR is_slow = 1
    OR coalesce(memory_used_mb > mc, false) OR coalesce(duration > dc, false) AS INTEGER) AS is_anomaly
  FROM features f, cuts)"""
