"""The registered queries as DuckDB SQL over the same tables.

Doubles are compared in single precision (CAST to REAL and back), as `queries.single` does.
"""

from __future__ import annotations

from tidegauge.operators.iforest import average_path
from tidegauge.schema import ML_FEATURES

# The log view over `events`.
LOGS = """
base AS (
  SELECT event_id,
         make_timestamp(epoch_us(TIMESTAMP '2024-01-01') + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 600) AS event_timestamp,
         user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
logs AS (
  SELECT event_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
         CAST(hour(event_timestamp) AS INTEGER) AS hour,
         CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS day_of_week,
         '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS source_ip,
         CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'GET' END AS method,
         '/' || event_type || '/' || (k % 7) AS url,
         CAST(CASE WHEN event_type = 'error' THEN CASE k % 4 WHEN 0 THEN 404 WHEN 1 THEN 429 WHEN 2 THEN 500 ELSE 503 END
              WHEN k % 10 = 0 THEN 301 ELSE 200 END AS INTEGER) AS status_code,
         CAST(k * 100 AS INTEGER) AS bytes_sent,
         value / 20 AS response_time,
         CASE k % 9 WHEN 0 THEN 'curl/7.68.0' WHEN 1 THEN 'bot/1.0' ELSE 'Mozilla/5.0' END AS user_agent
  FROM base)"""

WINDOWED = LOGS + """,
slid AS (
  SELECT l.*, date_trunc('minute', event_timestamp) - to_minutes(i) AS window_start
  FROM logs l, (SELECT unnest(range(5)) AS i)),
wstats AS (
  SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, source_ip,
         count(*) AS request_count, avg(response_time) AS avg_response_time,
         count(*) FILTER (status_code >= 400) AS error_count, count(DISTINCT url) AS url_diversity,
         max(status_code) AS max_status_code, min(status_code) AS min_status_code, avg(bytes_sent) AS avg_bytes_sent
  FROM slid GROUP BY window_start, source_ip),
wrates AS (SELECT *, error_count / request_count AS error_rate, request_count / 5.0 AS requests_per_minute FROM wstats),
wflags AS (
  SELECT *, requests_per_minute > 1.6 AS is_high_request_rate, error_rate > 0.7 AS is_high_error_rate,
         avg_response_time > 5.0 AS is_slow_response, requests_per_minute > 0.2 AND url_diversity = 1 AS is_scanning
  FROM wrates),
walerts AS (
  SELECT *, concat_ws(',', CASE WHEN is_high_request_rate THEN 'HIGH_REQUEST_RATE' END,
                           CASE WHEN is_high_error_rate THEN 'HIGH_ERROR_RATE' END,
                           CASE WHEN is_slow_response THEN 'SLOW_RESPONSE' END,
                           CASE WHEN is_scanning THEN 'SCANNING_BEHAVIOR' END) AS alert_types,
         CASE WHEN is_high_request_rate THEN 'HIGH' WHEN is_high_error_rate THEN 'MEDIUM'
              WHEN is_slow_response THEN 'LOW' ELSE 'MEDIUM' END AS severity,
         'spark_streaming' AS detection_method
  FROM wflags WHERE is_high_request_rate OR is_high_error_rate OR is_slow_response OR is_scanning)"""

ROLLING = """,
seen AS (SELECT *, CAST(row_number() OVER (PARTITION BY source_ip, url ORDER BY event_timestamp, event_id) = 1 AS INTEGER) AS new_url FROM logs),
rolled AS (
  SELECT event_id, source_ip, event_timestamp,
         row_number() OVER o - count(*) OVER (PARTITION BY source_ip ORDER BY event_timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 60 SECONDS PRECEDING) AS request_rate,
         row_number() OVER o - count(*) OVER (PARTITION BY source_ip ORDER BY event_timestamp RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 10 SECONDS PRECEDING) AS burst_rate,
         avg(CASE WHEN status_code >= 400 THEN 1.0 ELSE 0.0 END) OVER (o ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS error_rate_10,
         avg(response_time) OVER (o ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS avg_rt_10,
         CAST(sum(new_url) OVER (o ROWS UNBOUNDED PRECEDING) AS BIGINT) AS url_diversity,
         avg(CASE WHEN status_code >= 400 THEN 1.0 ELSE 0.0 END) OVER w AS error_rate,
         avg(CASE WHEN status_code BETWEEN 400 AND 499 THEN 1.0 ELSE 0.0 END) OVER w AS error_4xx_rate,
         avg(CASE WHEN status_code >= 500 THEN 1.0 ELSE 0.0 END) OVER w AS error_5xx_rate,
         avg(response_time) OVER w AS avg_response_time, max(response_time) OVER w AS max_response_time,
         stddev_pop(response_time) OVER w AS std_response_time,
         avg(bytes_sent) OVER w AS avg_bytes, CAST(sum(bytes_sent) OVER w AS BIGINT) AS total_bytes,
         CAST(len(list_distinct(list(method) OVER w)) AS INTEGER) AS method_diversity,
         avg(CASE WHEN method = 'GET' THEN 1.0 ELSE 0.0 END) OVER w AS get_ratio,
         CAST(len(list_distinct(list(user_agent) OVER w)) AS INTEGER) AS agent_diversity,
         max(CAST(lower(user_agent) LIKE '%bot%' AS INTEGER)) OVER w AS is_bot
  FROM seen
  WINDOW o AS (PARTITION BY source_ip ORDER BY event_timestamp, event_id),
         w AS (PARTITION BY source_ip ORDER BY event_timestamp, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""

RULES = ROLLING + """,
ralerts AS (
  SELECT *, concat_ws(',', CASE WHEN request_rate > 3 THEN 'high_request_rate:HIGH' END,
                           CASE WHEN error_rate_10 > 0.4 THEN 'high_error_rate:MEDIUM' END,
                           CASE WHEN avg_rt_10 > 4.0 THEN 'slow_response:LOW' END,
                           CASE WHEN request_rate > 1 AND url_diversity = 1 THEN 'scanning_behavior:MEDIUM' END) AS items,
         CASE WHEN request_rate > 3 THEN 'HIGH'
              WHEN error_rate_10 > 0.4 OR (request_rate > 1 AND url_diversity = 1) THEN 'MEDIUM' ELSE 'LOW' END AS severity
  FROM rolled
  WHERE request_rate > 3 OR error_rate_10 > 0.4 OR avg_rt_10 > 4.0 OR (request_rate > 1 AND url_diversity = 1))"""

STORE = WINDOWED + RULES + """,
canonical AS (
  SELECT event_timestamp AS alert_ts, source_ip, severity, 'rule_based' AS detection_method,
         regexp_replace(items, ':[A-Z]+', '', 'g') AS alert_types, CAST(request_rate AS DOUBLE) AS rate, error_rate_10 AS err,
         CAST(event_id AS VARCHAR) AS alert_id
  FROM ralerts
  UNION ALL
  SELECT window_end, source_ip, severity, detection_method, alert_types, requests_per_minute, error_rate,
         strftime(window_start, '%Y%m%d%H%M%S%f') FROM walerts),
keyed AS (SELECT strftime(alert_ts, '%Y%m%d%H%M%S%f') || '_' || replace(source_ip, '.', '_') || '_' || detection_method || '_' || alert_id AS rowkey, * FROM canonical),
store AS (SELECT DISTINCT ON (rowkey) * FROM keyed),
stats AS (
  SELECT source_ip, count(*) AS alert_count, max(alert_ts) AS last_alert_time, arg_max(severity, rowkey) AS last_severity
  FROM store GROUP BY source_ip)"""

COUNTERS = LOGS + """,
rates AS (
  SELECT source_ip, count(*) AS requests, count(*) FILTER (status_code >= 400) / count(*) * 100 AS error_pct,
         avg(response_time) AS avg_response_time, max(event_timestamp) AS last_seen
  FROM logs GROUP BY source_ip),
scores AS (
  SELECT source_ip, requests, error_pct, avg_response_time,
         least(100.0::DOUBLE, error_pct * 0.4::DOUBLE + least(requests, 200) * 0.3::DOUBLE + least(avg_response_time, 10.0::DOUBLE) * 10) AS threat_score,
         last_seen, (error_pct > 50 OR requests > 100 OR avg_response_time > 5) AS is_suspicious
  FROM rates)"""

PROFILE = LOGS + """,
profile AS (
  SELECT source_ip, count(*) AS total_requests, count(DISTINCT url) AS unique_urls,
         avg(response_time) AS avg_response_time, max(response_time) AS max_response_time,
         count(*) FILTER (status_code >= 400) AS error_count, count(*) FILTER (status_code >= 500) AS server_error_count,
         CAST(sum(bytes_sent) AS BIGINT) AS total_bytes, min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen
  FROM logs GROUP BY source_ip),
timed AS (
  SELECT *, error_count / total_requests AS error_rate,
         CAST(floor(epoch(last_seen)) - floor(epoch(first_seen)) AS BIGINT) AS duration_seconds
  FROM profile),
paced AS (
  SELECT *, CASE WHEN duration_seconds > 0 THEN total_requests / (duration_seconds / 60) ELSE total_requests END AS requests_per_minute
  FROM timed)"""

PROFILE_COLUMNS = """source_ip, total_requests, unique_urls, CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(CAST(max_response_time AS REAL) AS DOUBLE) AS max_response_time, error_count, server_error_count, total_bytes, first_seen, last_seen,
  CAST(CAST(error_rate AS REAL) AS DOUBLE) AS error_rate, duration_seconds, CAST(CAST(requests_per_minute AS REAL) AS DOUBLE) AS requests_per_minute"""

RISK = LOGS + """,
risk AS (
  SELECT source_ip, count(*) AS total_requests, count(*) FILTER (status_code BETWEEN 400 AND 499) AS client_errors,
         count(*) FILTER (status_code >= 500) AS server_errors, count(DISTINCT url) AS unique_urls,
         count(DISTINCT user_agent) AS unique_agents, avg(response_time) AS avg_response_time, max(response_time) AS max_response_time
  FROM logs GROUP BY source_ip),
scored AS (
  SELECT *, total_requests / 10 + server_errors * 2 + CASE WHEN unique_urls = 1 THEN 50 ELSE 0 END + max_response_time * 5 AS risk_score
  FROM risk)"""

URLS = LOGS + """,
urls AS (
  SELECT url, count(*) AS access_count, count(DISTINCT source_ip) AS unique_ips,
         CAST(CAST(avg(response_time) AS REAL) AS DOUBLE) AS avg_response_time, count(*) FILTER (status_code = 404) AS not_found_count
  FROM logs GROUP BY url)"""

TUMBLED = LOGS + """,
tumbled AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start, source_ip, count(*) AS request_count,
         avg(response_time) AS avg_response_time, max(response_time) AS max_response_time,
         coalesce(stddev_samp(response_time), 0) AS stddev_response_time, CAST(sum(bytes_sent) AS BIGINT) AS bytes_sent_total,
         avg(bytes_sent) AS avg_bytes_sent, count(DISTINCT url) AS url_diversity,
         count(*) FILTER (status_code BETWEEN 400 AND 499) AS status_4xx_count,
         count(*) FILTER (status_code >= 500) AS status_5xx_count, avg(hour) AS hour_of_day
  FROM logs GROUP BY 1, 2),
v1 AS (
  SELECT *, request_count / 5.0 AS request_rate, (status_4xx_count + status_5xx_count) / request_count AS error_rate FROM tumbled),
labelled AS (SELECT *, CAST(request_rate > 1.0 AND error_rate > 0.3 AS DOUBLE) AS is_attack FROM v1)"""


def _with(ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{select}"


def _last(n: int, ctes: str = LOGS) -> str:
    return ctes + f""",
recent AS (SELECT * FROM logs ORDER BY event_timestamp DESC, event_id DESC LIMIT {n})"""


Z_COLUMNS = (
    "request_count",
    "requests_per_minute",
    "avg_response_time",
    "max_response_time",
    "stddev_response_time",
    "error_count",
    "error_rate",
    "avg_bytes_sent",
    "url_diversity",
)

ORACLE: dict[str, str] = {
    "log_view": _with(LOGS, """SELECT * REPLACE (CAST(CAST(response_time AS REAL) AS DOUBLE) AS response_time),
  CAST(status_code >= 400 AS INTEGER) AS is_error, CAST(method = 'GET' AS INTEGER) AS is_get,
  CAST(method = 'POST' AS INTEGER) AS is_post FROM logs"""),
    "archive_partitions": _with(LOGS, """SELECT strftime(event_timestamp, '%Y') AS year, strftime(event_timestamp, '%m') AS month,
  strftime(event_timestamp, '%d') AS day, strftime(event_timestamp, '%H') AS hour, count(*) AS rows
FROM logs GROUP BY 1, 2, 3, 4"""),
    "traffic_overview": _with(LOGS, """SELECT count(*) AS total_requests, count(DISTINCT source_ip) AS unique_ips,
  min(event_date) AS first_date, max(event_date) AS last_date,
  CAST(CAST(count(*) / count(DISTINCT source_ip) AS REAL) AS DOUBLE) AS requests_per_ip FROM logs"""),
    "traffic_by_hour": _with(LOGS, "SELECT hour, count(*) AS request_count FROM logs GROUP BY hour"),
    "traffic_by_dow": _with(LOGS, "SELECT day_of_week, count(*) AS request_count FROM logs GROUP BY day_of_week"),
    "method_distribution": _with(LOGS, 'SELECT method, count(*) AS "count" FROM logs GROUP BY method'),
    "status_distribution": _with(LOGS, 'SELECT status_code, count(*) AS "count" FROM logs GROUP BY status_code'),
    "minute_stats": _with(LOGS, """SELECT date_trunc('minute', event_timestamp) AS window_start, count(*) AS total_logs,
  count(DISTINCT source_ip) AS unique_ips, CAST(CAST(avg(response_time) AS REAL) AS DOUBLE) AS avg_response_time,
  count(*) FILTER (status_code >= 400) AS total_errors FROM logs GROUP BY 1"""),
    "rate_5s": _with(LOGS + """,
counts AS (SELECT time_bucket(INTERVAL 5 SECOND, event_timestamp) AS b, count(*) AS n FROM logs GROUP BY 1),
bins AS (SELECT unnest(generate_series((SELECT min(b) FROM counts), (SELECT max(b) FROM counts), INTERVAL 5 SECOND)) AS bin_start)""",
        "SELECT bin_start, coalesce(n, 0) AS requests FROM bins LEFT JOIN counts ON b = bin_start"),
    "ip_profile": _with(PROFILE, f"SELECT {PROFILE_COLUMNS} FROM paced"),
    "suspicious_ips": _with(PROFILE, f"""SELECT {PROFILE_COLUMNS} FROM paced
WHERE requests_per_minute > 1.1 OR (error_rate > 0.25 AND total_requests > 60) OR (unique_urls = 1 AND total_requests > 100)"""),
    "risk_profiles": _with(RISK, """SELECT source_ip, total_requests, client_errors, server_errors, unique_urls, unique_agents,
  CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time, CAST(CAST(max_response_time AS REAL) AS DOUBLE) AS max_response_time,
  CAST(CAST(risk_score AS REAL) AS DOUBLE) AS risk_score FROM scored"""),
    "high_risk_ips": _with(RISK, """SELECT source_ip, total_requests, server_errors, unique_urls, CAST(CAST(risk_score AS REAL) AS DOUBLE) AS risk_score
FROM scored WHERE risk_score > 100"""),
    "bot_agents": _with(LOGS, """SELECT DISTINCT source_ip, user_agent FROM logs
WHERE regexp_matches(lower(user_agent), 'bot|crawler|spider|curl|wget')"""),
    "url_stats": _with(URLS, "SELECT * FROM urls"),
    "scanned_urls": _with(URLS, "SELECT * FROM urls WHERE not_found_count > 10 AND not_found_count / access_count > 0.25"),
    "response_summary": _with(LOGS, """SELECT CAST(CAST(avg(response_time) AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(CAST(quantile_disc(response_time, 0.5) AS REAL) AS DOUBLE) AS median_response_time, CAST(CAST(quantile_disc(response_time, 0.95) AS REAL) AS DOUBLE) AS p95_response_time,
  CAST(CAST(quantile_disc(response_time, 0.99) AS REAL) AS DOUBLE) AS p99_response_time, CAST(CAST(max(response_time) AS REAL) AS DOUBLE) AS max_response_time FROM logs"""),
    "response_by_hour": _with(LOGS, """SELECT hour, CAST(CAST(avg(response_time) AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(CAST(quantile_disc(response_time, 0.95) AS REAL) AS DOUBLE) AS p95_response_time, count(*) AS request_count FROM logs GROUP BY hour"""),
    "slow_request_ips": _with(LOGS + """,
t AS (SELECT quantile_disc(response_time, 0.95) AS threshold FROM logs)""", """SELECT source_ip, count(*) AS slow_request_count,
  CAST(CAST(max(threshold) AS REAL) AS DOUBLE) AS threshold FROM logs, t WHERE response_time > threshold GROUP BY source_ip"""),
    "slow_request_total": _with(LOGS + """,
t AS (SELECT quantile_disc(response_time, 0.95) AS threshold FROM logs)""", """SELECT CAST(CAST(max(threshold) AS REAL) AS DOUBLE) AS threshold,
  count(*) FILTER (response_time > threshold) AS slow_request_count, count(*) AS request_count FROM logs, t"""),
    "response_histogram": _with(LOGS + """,
s AS (SELECT min(response_time) AS lo, max(response_time) AS hi FROM logs),
b AS (SELECT CAST(least(floor((response_time - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bucket, lo, hi FROM logs, s)""",
        """SELECT bucket, CAST(CAST(lo + bucket * ((hi - lo) / 20) AS REAL) AS DOUBLE) AS low, CAST(CAST(lo + (bucket + 1) * ((hi - lo) / 20) AS REAL) AS DOUBLE) AS high,
  count(*) AS "count" FROM b GROUP BY bucket, lo, hi"""),
    "windowed_stats": _with(WINDOWED, """SELECT * REPLACE (CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(CAST(avg_bytes_sent AS REAL) AS DOUBLE) AS avg_bytes_sent, CAST(CAST(error_rate AS REAL) AS DOUBLE) AS error_rate, CAST(CAST(requests_per_minute AS REAL) AS DOUBLE) AS requests_per_minute) FROM wrates"""),
    "windowed_alerts": _with(WINDOWED, """SELECT * REPLACE (CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(CAST(avg_bytes_sent AS REAL) AS DOUBLE) AS avg_bytes_sent, CAST(CAST(error_rate AS REAL) AS DOUBLE) AS error_rate, CAST(CAST(requests_per_minute AS REAL) AS DOUBLE) AS requests_per_minute) FROM walerts"""),
    "alert_payload": _with(WINDOWED, """SELECT source_ip AS key, severity, detection_method, split_part(alert_types, ',', 1) AS first_type,
  window_start, request_count, CAST(CAST(error_rate AS REAL) AS DOUBLE) AS error_rate, url_diversity FROM walerts"""),
    "attack_windows": _with(TUMBLED, """SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, source_ip, request_count,
  CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time, status_5xx_count AS server_errors FROM tumbled
WHERE request_count > 8 OR (status_5xx_count > 2 AND avg_response_time > 2.5)"""),
    "window_features_v1": _with(TUMBLED, """SELECT window_start, source_ip, request_count, CAST(CAST(request_rate AS REAL) AS DOUBLE) AS request_rate,
  CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time, CAST(CAST(max_response_time AS REAL) AS DOUBLE) AS max_response_time,
  CAST(CAST(stddev_response_time AS REAL) AS DOUBLE) AS stddev_response_time, bytes_sent_total, url_diversity, status_4xx_count, status_5xx_count,
  CAST(CAST(hour_of_day AS REAL) AS DOUBLE) AS hour_of_day, CAST(CAST(error_rate AS REAL) AS DOUBLE) AS error_rate, is_attack FROM labelled"""),
    "window_features_v2": _with(TUMBLED, """SELECT source_ip, window_start, request_count, CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(CAST(max_response_time AS REAL) AS DOUBLE) AS max_response_time, CAST(CAST(stddev_response_time AS REAL) AS DOUBLE) AS stddev_response_time,
  status_4xx_count + status_5xx_count AS error_count, CAST(CAST(avg_bytes_sent AS REAL) AS DOUBLE) AS avg_bytes_sent, url_diversity,
  CAST(CAST(error_rate AS REAL) AS DOUBLE) AS error_rate, CAST(CAST(request_rate AS REAL) AS DOUBLE) AS requests_per_minute FROM v1"""),
    "class_balance": _with(TUMBLED, """SELECT count(*) AS total, count(*) FILTER (is_attack = 1) AS attacks, count(*) FILTER (is_attack = 0) AS normal,
  CAST(CAST(count(*) FILTER (is_attack = 1) / count(*) * 100 AS REAL) AS DOUBLE) AS attack_pct FROM labelled"""),
    "url_entropy": _with(LOGS + """,
c AS (SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start, source_ip, url, count(*) AS n FROM logs GROUP BY 1, 2, 3),
p AS (SELECT *, n / sum(n) OVER (PARTITION BY window_start, source_ip) AS p FROM c)""",
        "SELECT window_start, source_ip, CAST(CAST(abs(sum(p * log2(p))) AS REAL) AS DOUBLE) AS url_entropy FROM p GROUP BY 1, 2"),
    "rolling_basic": _with(LOGS + ROLLING, """SELECT event_id, source_ip, event_timestamp, request_rate, CAST(CAST(error_rate_10 AS REAL) AS DOUBLE) AS error_rate,
  CAST(CAST(avg_rt_10 AS REAL) AS DOUBLE) AS avg_response_time, url_diversity, CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day,
  CAST(isodow(event_timestamp) - 1 AS INTEGER) AS day_of_week FROM rolled"""),
    "rolling_ml": _with(LOGS + ROLLING, """SELECT event_id, source_ip, event_timestamp, request_rate, burst_rate, CAST(CAST(error_rate AS REAL) AS DOUBLE) AS error_rate,
  CAST(CAST(error_4xx_rate AS REAL) AS DOUBLE) AS error_4xx_rate, CAST(CAST(error_5xx_rate AS REAL) AS DOUBLE) AS error_5xx_rate, CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(CAST(max_response_time AS REAL) AS DOUBLE) AS max_response_time, CAST(CAST(std_response_time AS REAL) AS DOUBLE) AS std_response_time, CAST(CAST(avg_bytes AS REAL) AS DOUBLE) AS avg_bytes,
  total_bytes, url_diversity, CAST(CAST(log2(url_diversity) AS REAL) AS DOUBLE) AS url_entropy, method_diversity, CAST(CAST(get_ratio AS REAL) AS DOUBLE) AS get_ratio,
  agent_diversity, is_bot, CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day,
  CAST(hour(event_timestamp) BETWEEN 9 AND 17 AS INTEGER) AS is_business_hours, CAST(isodow(event_timestamp) >= 6 AS INTEGER) AS is_weekend FROM rolled"""),
    "pseudo_labels": _with(LOGS + ROLLING, """SELECT event_id,
  CAST((request_rate > 3 AND error_rate > 0.4) OR burst_rate > 2 AS INTEGER) AS is_attack FROM rolled"""),
    "rule_alerts": _with(LOGS + RULES, "SELECT event_id, source_ip, event_timestamp, items AS alert_types, severity FROM ralerts"),
    "cooldown_alerts": _with(LOGS + RULES + """,
numbered AS (SELECT *, row_number() OVER (PARTITION BY source_ip ORDER BY event_timestamp, event_id) AS rn FROM ralerts),
chain AS (
  SELECT source_ip, rn, event_id, event_timestamp, items, severity, event_timestamp AS last_kept, TRUE AS kept FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.source_ip, n.rn, n.event_id, n.event_timestamp, n.items, n.severity,
         CASE WHEN n.event_timestamp - c.last_kept >= INTERVAL 120 SECONDS THEN n.event_timestamp ELSE c.last_kept END,
         n.event_timestamp - c.last_kept >= INTERVAL 120 SECONDS
  FROM chain c JOIN numbered n ON n.source_ip = c.source_ip AND n.rn = c.rn + 1)""",
        "SELECT event_id, source_ip, event_timestamp, items AS alert_types, severity FROM chain WHERE kept", recursive=True),
    "alert_display": _with(LOGS + RULES, """SELECT event_id, event_timestamp AS alert_ts, source_ip, request_rate, CAST(CAST(error_rate_10 AS REAL) AS DOUBLE) AS error_rate,
  CAST(CAST(avg_rt_10 AS REAL) AS DOUBLE) AS avg_response_time, url_diversity, '[' || split_part(item, ':', 2) || '] ' || split_part(item, ':', 1) AS rule
FROM (SELECT *, unnest(string_split(items, ',')) AS item FROM ralerts)"""),
    "window_alert_display": _with(WINDOWED, """SELECT window_end AS alert_timestamp, source_ip, alert_types, severity,
  CAST(CAST(requests_per_minute AS REAL) AS DOUBLE) AS requests_per_minute, CAST(CAST(error_rate AS REAL) AS DOUBLE) AS error_rate,
  CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time FROM walerts"""),
    "alert_store": _with(STORE, "SELECT rowkey, alert_ts, source_ip, severity, detection_method, alert_types FROM store"),
    "ip_statistics": _with(STORE, "SELECT * FROM stats"),
    "merged_statistics": _with(STORE, "SELECT * FROM stats"),
    "alerts_by_ip": _with(STORE, """SELECT rowkey, alert_ts, source_ip, severity, detection_method FROM store
WHERE source_ip = '10.0.0.7' ORDER BY rowkey DESC LIMIT 10"""),
    "recent_alerts": _with(STORE, "SELECT alert_ts, source_ip, severity, detection_method FROM store ORDER BY rowkey DESC LIMIT 50"),
    "trends_severity": _with(STORE, """SELECT severity AS key, count(*) AS "count", CAST(CAST(count(*) / sum(count(*)) OVER () * 100 AS REAL) AS DOUBLE) AS pct FROM store GROUP BY 1"""),
    "trends_method": _with(STORE, """SELECT detection_method AS key, count(*) AS "count", CAST(CAST(count(*) / sum(count(*)) OVER () * 100 AS REAL) AS DOUBLE) AS pct FROM store GROUP BY 1"""),
    "trends_hour": _with(STORE, """SELECT strftime(alert_ts, '%Y-%m-%d %H:00') AS key, count(*) AS "count", CAST(CAST(count(*) / sum(count(*)) OVER () * 100 AS REAL) AS DOUBLE) AS pct
FROM store GROUP BY 1"""),
    "top_offenders": _with(STORE, """SELECT CAST(row_number() OVER (ORDER BY alert_count DESC, source_ip) AS INTEGER) AS rank, * FROM stats
ORDER BY alert_count DESC, source_ip LIMIT 20"""),
    "ip_history": _with(STORE, """SELECT alert_ts, severity, detection_method, CAST(CAST(rate AS REAL) AS DOUBLE) AS request_rate, CAST(CAST(err AS REAL) AS DOUBLE) AS error_rate,
  (SELECT alert_count FROM stats WHERE source_ip = '10.0.0.7') AS alert_count
FROM store WHERE source_ip = '10.0.0.7' ORDER BY rowkey DESC LIMIT 50"""),
    "threat_report": _with(STORE + """,
f AS (SELECT count(*) AS total, count(*) FILTER (severity IN ('HIGH', 'CRITICAL')) AS strong,
             count(*) FILTER (detection_method = 'spark_streaming') AS windows, count(*) FILTER (detection_method = 'rule_based') AS rules FROM store),
s AS (SELECT count(*) AS sources, count(*) FILTER (alert_count >= 5) AS critical FROM stats),
r(section, key, value) AS (
  SELECT 'overall', 'total_alerts', CAST(total AS DOUBLE) FROM f
  UNION ALL SELECT 'overall', 'unique_sources', sources FROM s
  UNION ALL SELECT 'overall', 'avg_alerts_per_source', total / greatest(sources, 1) FROM f, s
  UNION ALL SELECT 'critical', 'critical_sources', critical FROM s
  UNION ALL SELECT 'recommendation', 'block_critical_sources', CAST(critical > 0 AS INTEGER) FROM s
  UNION ALL SELECT 'recommendation', 'high_severity_rate', CAST(strong > total * 0.3 AS INTEGER) FROM f
  UNION ALL SELECT 'recommendation', 'use_more_detectors', CAST(windows < rules * 0.5 AS INTEGER) FROM f
  UNION ALL SELECT 'severity_count', severity, count(*) FROM store GROUP BY severity
  UNION ALL SELECT 'severity_pct', severity, count(*) / any_value(total) * 100 FROM store, f GROUP BY severity
  UNION ALL SELECT 'method_count', detection_method, count(*) FROM store GROUP BY detection_method
  UNION ALL SELECT 'method_pct', detection_method, count(*) / any_value(total) * 100 FROM store, f GROUP BY detection_method)""",
        "SELECT section, key, CAST(CAST(value AS REAL) AS DOUBLE) AS value FROM r"),
    "timeline": _with(WINDOWED + """,
both_ AS (
  SELECT date_trunc('minute', event_timestamp) AS bin_start, 1 AS l, 0 AS a FROM logs
  UNION ALL SELECT date_trunc('minute', window_end), 0, 1 FROM walerts)""",
        "SELECT bin_start, CAST(sum(l) AS BIGINT) AS logs, CAST(sum(a) AS BIGINT) AS alerts FROM both_ GROUP BY 1"),
    "threat_scores": _with(COUNTERS, """SELECT * REPLACE (CAST(CAST(error_pct AS REAL) AS DOUBLE) AS error_pct, CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(CAST(threat_score AS REAL) AS DOUBLE) AS threat_score) FROM scores"""),
    "suspicious_scores": _with(COUNTERS, """SELECT * REPLACE (CAST(CAST(error_pct AS REAL) AS DOUBLE) AS error_pct, CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(floor(threat_score) AS INTEGER) AS threat_score, TRUE AS is_suspicious)
FROM scores WHERE error_pct > 25 OR requests > 75 OR scores.avg_response_time > 2.6"""),
    "top_sources": _with(COUNTERS, """SELECT * REPLACE (CAST(CAST(error_pct AS REAL) AS DOUBLE) AS error_pct, CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time)
FROM rates ORDER BY requests DESC, source_ip LIMIT 10"""),
    "normal_ips": _with(COUNTERS, """SELECT * REPLACE (CAST(CAST(error_pct AS REAL) AS DOUBLE) AS error_pct, CAST(CAST(avg_response_time AS REAL) AS DOUBLE) AS avg_response_time)
FROM rates WHERE error_pct < 20 AND requests < 100 AND rates.avg_response_time < 3"""),
    "score_histogram": _with(COUNTERS + """,
s AS (SELECT min(threat_score) AS lo, max(threat_score) AS hi FROM scores),
b AS (SELECT CAST(least(floor((threat_score - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bucket, lo, hi FROM scores, s)""",
        """SELECT bucket, CASE WHEN lo + bucket * ((hi - lo) / 20) >= 70 THEN 'high' WHEN lo + bucket * ((hi - lo) / 20) >= 40 THEN 'medium' ELSE 'low' END AS band,
  count(*) AS "count" FROM b GROUP BY bucket, lo, hi"""),
    "top_urls_share": _with(_last(200), """SELECT url, count(*) AS "count", CAST(CAST(count(*) / sum(count(*)) OVER () * 100 AS REAL) AS DOUBLE) AS pct
FROM recent GROUP BY url ORDER BY 2 DESC, url LIMIT 8"""),
    "traffic_intensity": _with(_last(100), """SELECT count(*) AS requests, CAST(sum(bytes_sent) AS BIGINT) AS total_bytes,
  CAST(CAST(avg(response_time) AS REAL) AS DOUBLE) AS avg_response_time FROM recent"""),
    "threat_level": _with(_last(100) + """,
c AS (SELECT count(*) AS n, count(*) FILTER (status_code >= 400) AS errors, count(*) FILTER (response_time > 5) AS slow,
             count(*) FILTER (lower(user_agent) LIKE '%bot%') AS bots FROM recent),
i AS (SELECT *, CAST(errors > n * 0.3 AS INTEGER) + CAST(slow > n * 0.2 AS INTEGER) + CAST(bots > n * 0.1 AS INTEGER) AS indicators FROM c)""",
        """SELECT errors, slow, bots, indicators, CASE WHEN indicators >= 2 THEN 'HIGH' WHEN indicators = 1 THEN 'MEDIUM' ELSE 'LOW' END AS level FROM i"""),
    "attack_rate": _with(TUMBLED + """,
a AS (SELECT count(*) AS alerts FROM tumbled WHERE request_count > 8 OR (status_5xx_count > 2 AND avg_response_time > 2.5)),
p AS (SELECT (SELECT count(*) FROM logs) AS logs, alerts, alerts / (SELECT count(*) FROM logs) * 100 AS attack_pct FROM a)""",
        """SELECT logs, alerts, CAST(CAST(attack_pct AS REAL) AS DOUBLE) AS attack_pct,
  CASE WHEN attack_pct > 10 THEN 'HIGH' WHEN attack_pct > 5 THEN 'MEDIUM' ELSE 'LOW' END AS threat_level,
  CASE WHEN attack_pct > 10 THEN 'Critical' WHEN attack_pct > 5 THEN 'Elevated' ELSE 'Normal' END AS rate_level FROM p"""),
    "capture_stats": _with(LOGS, """SELECT count(*) AS rows, CAST(coalesce(sum(bytes_sent), 0) AS BIGINT) AS total_bytes,
  CAST(CAST(avg(response_time) AS REAL) AS DOUBLE) AS avg_response_time, CAST(count(*) > 0 AS BIGINT) AS protocols, count(DISTINCT source_ip) AS unique_ips
FROM logs WHERE contains(source_ip, '0.1') AND status_code BETWEEN 400 AND 499"""),
    "log_display": _with(_last(100), """SELECT CAST(row_number() OVER (ORDER BY event_timestamp, event_id) AS INTEGER) AS no,
  strftime(event_timestamp, '%H:%M:%S') AS time, source_ip, 'HTTP' AS protocol, method, url AS request_uri, status_code AS status,
  CAST(CAST(response_time AS REAL) AS DOUBLE) AS response_s, bytes_sent AS length_bytes,
  method || ' ' || url || ' → ' || status_code || ' (' || bytes_sent || ' bytes, ' || response_time || 's)' AS info FROM recent"""),
    "scaled_features": _with(TUMBLED + """,
v2 AS (SELECT *, request_rate AS requests_per_minute, status_4xx_count + status_5xx_count AS error_count FROM v1)""",
        "SELECT source_ip, window_start, " + ", ".join(
            f"CAST(CAST((v2.{c} - avg(v2.{c}) OVER ()) / stddev_samp(v2.{c}) OVER () AS REAL) AS DOUBLE) AS z_{c}" for c in Z_COLUMNS
        ) + " FROM v2"),
}

# The ordered top-n forms of full results.
ORACLE["top_high_risk_ips"] = ORACLE["high_risk_ips"] + " ORDER BY scored.risk_score DESC, source_ip LIMIT 20"
ORACLE["top_suspicious_ips"] = f"SELECT * FROM ({ORACLE['suspicious_ips']}) ORDER BY requests_per_minute DESC, source_ip LIMIT 20"
ORACLE["top_urls"] = f"SELECT * FROM ({ORACLE['url_stats']}) ORDER BY access_count DESC, url LIMIT 20"
ORACLE["top_slow_request_ips"] = f"SELECT * FROM ({ORACLE['slow_request_ips']}) ORDER BY slow_request_count DESC, source_ip LIMIT 10"
ORACLE["top_attack_windows"] = (
    f"SELECT * FROM ({ORACLE['attack_windows']}) ORDER BY request_count DESC, window_start, source_ip LIMIT 20"
)
ORACLE["top_suspicious_scores"] = f"SELECT * FROM ({ORACLE['suspicious_scores']}) ORDER BY threat_score DESC, source_ip LIMIT 10"

# A drained stream ends with its last windows.
ORACLE["stream_windowed_stats"] = ORACLE["windowed_stats"]
ORACLE["stream_minute_stats"] = ORACLE["minute_stats"]
ORACLE["stream_alert_topic"] = _with(WINDOWED, """SELECT source_ip AS key, window_start, severity,
  split_part(alert_types, ',', 1) AS first_type, request_count, CAST(CAST(error_rate AS REAL) AS DOUBLE) AS error_rate FROM walerts""")
ORACLE["stream_alert_store"] = _with(WINDOWED, """SELECT source_ip, count(*) AS alert_count, max(window_end) AS last_alert_time,
  arg_max(severity, window_end) AS last_severity FROM walerts GROUP BY source_ip""")
ORACLE["stream_archive"] = ORACLE["archive_partitions"]
ORACLE["stream_rolling"] = ORACLE["rolling_basic"]
ORACLE["stream_cooldown"] = ORACLE["cooldown_alerts"]
ORACLE["stream_rolling_ml"] = ORACLE["rolling_ml"]
ORACLE["metrics_of_rule"] = _with(TUMBLED + """,
c AS (SELECT is_attack AS label, CAST(error_rate > 0.4 AS DOUBLE) AS prediction FROM labelled),
k AS (SELECT DISTINCT label AS class FROM c UNION SELECT DISTINCT prediction FROM c),
n AS (SELECT class, (SELECT count(*) FROM c WHERE label = class) AS actual, (SELECT count(*) FROM c WHERE prediction = class) AS predicted,
             (SELECT count(*) FROM c WHERE label = class AND prediction = class) AS tp FROM k),
m AS (SELECT sum(tp) / sum(actual) AS r, sum(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END * actual) / sum(actual) AS p FROM n)""",
    """SELECT CAST(CAST(r AS REAL) AS DOUBLE) AS accuracy, CAST(CAST(p AS REAL) AS DOUBLE) AS weighted_precision,
  CAST(CAST(r AS REAL) AS DOUBLE) AS weighted_recall, CAST(CAST(2 * p * r / (p + r) AS REAL) AS DOUBLE) AS f1 FROM m""")
ORACLE["profile_of_rule"] = _with(TUMBLED, """SELECT CAST(request_count > 5 AS INTEGER) + 2 * CAST(error_rate > 0.3 AS INTEGER) AS cluster,
  count(*) AS "count", CAST(CAST(avg(request_count) AS REAL) AS DOUBLE) AS avg_requests, CAST(CAST(avg(request_rate) AS REAL) AS DOUBLE) AS avg_requests_per_minute,
  CAST(CAST(avg(error_rate) AS REAL) AS DOUBLE) AS avg_error_rate, CAST(CAST(avg(avg_response_time) AS REAL) AS DOUBLE) AS avg_response_time,
  CAST(CAST(avg(url_diversity) AS REAL) AS DOUBLE) AS avg_url_diversity, avg(request_rate) > 1.2 OR avg(error_rate) > 0.5 AS is_anomaly
FROM v1 GROUP BY 1""")
ORACLE["votes_of_scores"] = _with(LOGS + ROLLING + """,
v AS (
  SELECT event_id, avg_response_time AS d, 0.2 - error_rate AS s, burst_rate > 1 AS b, get_ratio * 100 AS pct FROM rolled),
a AS (
  SELECT event_id,
         concat_ws(',', CASE WHEN d > 3.5 THEN 'kmeans_anomaly:HIGH' END, CASE WHEN s < 0 THEN 'isolation_forest_anomaly:MEDIUM' END,
                   CASE WHEN b THEN 'random_forest_classification:' || CASE WHEN pct > 80 THEN 'HIGH' ELSE 'MEDIUM' END END) AS items,
         CAST(d > 3.5 AS INTEGER) + CAST(s < 0 AS INTEGER) + CAST(b AS INTEGER) AS n,
         CASE WHEN d > 3.5 THEN least(100, d * 20) ELSE 0 END + CASE WHEN s < 0 THEN least(100, abs(s) * 50) ELSE 0 END + CASE WHEN b THEN pct ELSE 0 END AS total
  FROM v)""", """SELECT event_id, items AS alert_types, CAST(CAST(total / n AS REAL) AS DOUBLE) AS confidence, n AS models_used FROM a WHERE n > 0""")
ORACLE["model_round_trip"] = _with(TUMBLED, "SELECT count(*) AS windows, CAST(0 AS BIGINT) AS moved FROM v1")

ORACLE["trends_24_hours"] = ORACLE["trends_hour"] + " ORDER BY 1 DESC LIMIT 24"
ORACLE["lookup_by_ip"] = ORACLE["alerts_by_ip"]
ORACLE["lookup_recent"] = ORACLE["recent_alerts"]
ORACLE["lookup_history"] = ORACLE["ip_history"]

SPOILED = LOGS + """,
spoiled AS (
  SELECT event_id, event_timestamp, CASE WHEN event_id % 97 = 5 THEN 'unreadable' WHEN event_id % 89 = 7 THEN 'stray' END AS reason FROM logs)"""
ORACLE["quarantine_rows"] = _with(SPOILED, """SELECT event_id, CASE reason WHEN 'unreadable' THEN 'yesterday' ELSE '1999-01-01T00:00:00' END AS "timestamp", reason
FROM spoiled WHERE reason IS NOT NULL""")
ORACLE["stream_late_rows"] = _with(SPOILED + """,
ends AS (SELECT event_id % 4 AS part, max(event_timestamp) AS latest FROM spoiled WHERE reason IS NULL GROUP BY 1),
marks AS (SELECT p.part, (SELECT max(latest) FROM ends e WHERE e.part < p.part) - INTERVAL 10 MINUTE AS watermark FROM (SELECT unnest(range(4)) AS part) p)""",
    """SELECT event_id, CASE WHEN reason IS NOT NULL THEN 'quarantine' WHEN event_timestamp <= watermark THEN 'late' ELSE 'ontime' END AS part, reason,
  CASE WHEN reason IS NULL AND event_timestamp <= watermark THEN watermark END AS watermark
FROM spoiled JOIN marks m ON m.part = event_id % 4""")
ORACLE["archive_read"] = _with(LOGS, """SELECT strftime(event_timestamp, '%Y') AS year, strftime(event_timestamp, '%m') AS month,
  strftime(event_timestamp, '%d') AS day, strftime(event_timestamp, '%H') AS hour, count(*) AS rows, CAST(sum(bytes_sent) AS BIGINT) AS total_bytes,
  count(DISTINCT source_ip) AS sources
FROM logs WHERE event_timestamp >= TIMESTAMP '2024-01-01 00:10:00' AND event_timestamp < TIMESTAMP '2024-01-01 01:05:00' GROUP BY 1, 2, 3, 4""")
ORACLE["storage_listing"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows, true AS with_size FROM {name}"
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)

# Scaled windows, centres of four groups, the nearest centre and its distance.
ASSIGNED = TUMBLED + """,
v2 AS (SELECT *, request_rate AS requests_per_minute, status_4xx_count + status_5xx_count AS error_count FROM v1),
z AS (
  SELECT source_ip, window_start, CAST(request_count > 5 AS INTEGER) + 2 * CAST(error_rate > 0.3 AS INTEGER) AS grp, [""" + ", ".join(
    f"(v2.{c} - avg(v2.{c}) OVER ()) / stddev_samp(v2.{c}) OVER ()" for c in Z_COLUMNS
) + """] AS x FROM v2),
centres AS (SELECT grp AS cluster, [""" + ", ".join(f"avg(x[{i + 1}])" for i in range(len(Z_COLUMNS))) + """] AS c FROM z GROUP BY grp),
near AS (
  SELECT source_ip, window_start, any_value(x) AS x, arg_min(cluster, (list_distance(x, c), cluster)) AS cluster, min(list_distance(x, c)) AS distance
  FROM z, centres GROUP BY source_ip, window_start)"""
ORACLE["cluster_assignment"] = _with(ASSIGNED, "SELECT source_ip, window_start, cluster, CAST(CAST(distance AS REAL) AS DOUBLE) AS distance FROM near")
ORACLE["outlier_distance"] = _with(ASSIGNED, """SELECT source_ip, window_start, cluster, CAST(CAST(distance AS REAL) AS DOUBLE) AS distance,
  CAST(CAST(least(100, distance * 20) AS REAL) AS DOUBLE) AS confidence FROM near WHERE distance > 4""")
ORACLE["silhouette_by_cluster"] = _with(ASSIGNED + """,
m AS (
  SELECT cluster, count(*) AS n, sum(list_dot_product(x, x)) AS q, [""" + ", ".join(f"sum(x[{i + 1}])" for i in range(len(Z_COLUMNS))) + """] AS s FROM near GROUP BY cluster),
d AS (
  SELECT source_ip, window_start, near.cluster AS own, m.cluster AS other, m.n, list_dot_product(x, x) + q / n - 2 * list_dot_product(x, s) / n AS d FROM near, m),
ab AS (
  SELECT source_ip, window_start, own, max(n) FILTER (own = other) AS n, max(d) FILTER (own = other) AS a, min(d) FILTER (own != other) AS b FROM d GROUP BY ALL)""",
    """SELECT own AS cluster, count(*) AS points, CAST(CAST(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a * n / (n - 1)) / greatest(b, a * n / (n - 1)) END) AS REAL) AS DOUBLE) AS silhouette
FROM ab GROUP BY own""")

# A forest of complete trees whose splits follow from the numbers of tree and node, walked from the roots.
ORACLE["forest_scores"] = _with(LOGS + ROLLING + """,
featured AS (
  SELECT *, log2(url_diversity) AS url_entropy, hour(event_timestamp) AS hour_of_day,
         CAST(hour(event_timestamp) BETWEEN 9 AND 17 AS INTEGER) AS is_business_hours, CAST(isodow(event_timestamp) >= 6 AS INTEGER) AS is_weekend
  FROM rolled),
x AS (SELECT event_id, [""" + ", ".join(f"CAST({c} AS DOUBLE)" for c in ML_FEATURES) + """] AS v FROM featured),
ends AS (SELECT i AS feature, min(v[i + 1]) AS lo, max(v[i + 1]) AS hi FROM x, (SELECT unnest(range(19)) AS i) GROUP BY i),
nodes AS (
  SELECT tree, node, feature, lo + (hi - lo) * (((tree * 13 + node * 29) % 97 + 1) / 98) AS threshold
  FROM (SELECT unnest(range(10)) AS tree), (SELECT unnest(range(15)) AS node), ends WHERE feature = (tree * 7 + node * 5) % 19),
walk AS (
  SELECT event_id, tree, 0::BIGINT AS node, 0 AS step FROM x, (SELECT unnest(range(10)) AS tree)
  UNION ALL
  SELECT w.event_id, w.tree, 2 * w.node + CASE WHEN x.v[n.feature + 1] <= n.threshold THEN 1 ELSE 2 END, w.step + 1
  FROM walk w JOIN x ON x.event_id = w.event_id JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE w.step < 4),
paths AS (SELECT event_id, avg(4 + (tree % 3) * 0.5 + (node % 5) * 0.25) AS mean FROM walk WHERE step = 4 GROUP BY event_id)""",
    f"SELECT event_id, CAST(CAST(pow(2.0::DOUBLE, -mean / {float(average_path(16))!r}) AS REAL) AS DOUBLE) AS score FROM paths", recursive=True)
ORACLE["training_check"] = _with(LOGS + ROLLING + """,
l AS (SELECT (request_rate > 3 AND error_rate > 0.4) OR burst_rate > 2 AS attack FROM rolled)""", """SELECT count(*) AS rows, count(*) FILTER (attack) AS attacks,
  count(*) FILTER (NOT attack) AS others, count(*) >= 100 AS enough_rows, count(*) FILTER (attack) > 10 AND count(*) FILTER (NOT attack) > 0 AS enough_attacks FROM l""")
