"""SQL twins of the registered queries, for DuckDB over the same tables.

The log queries rebuild the lines as text and parse them in SQL. The package queries take
the expected columns straight from `events`, so they also check the way through JSON.
"""

from __future__ import annotations

from skyledger.bindings.queries import AS_OF, LEDGER_CUT, RANGE, SERIES_DAY, WANTED_PACKAGE

_BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def _lines(before: str | None = None) -> str:
    cut = f"WHERE ts < TIMESTAMP '{before}'" if before else ""
    return rf"""
parts AS (
  SELECT event_id AS e, event_type AS kind, value AS v, user_id AS u,
    'keypool_' || strftime(ts, '%Y%m%d') || '.log' AS log_file,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS seconds,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS millis,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS micros,
    md5(CAST(user_id AS VARCHAR)) AS digest,
    '[worker-1] KeySyncServiceImpl : METRIC_KEY_SYNC_LATENCY MS=' AS sync,
    '[worker-1] KeyPoolServiceImpl : createKey: KeyPoolService successfully created key with ' AS created
  FROM events {cut}
),
heads AS (
  SELECT *,
    millis || '+0000 SiteId: ' || CAST(u % 5 + 101 AS VARCHAR) || '  INFO 26 ' AS head,
    'sequence number ' || CAST(e AS VARCHAR) || ', and KeyPool {{Source site identity = '''
      || CAST(u % 5 + 101 AS VARCHAR) || ''', Destination site identity = '''
      || CAST(u % 3 + 201 AS VARCHAR) || ''', and KeyPoolType name = '''
      || CASE e % 3 WHEN 0 THEN 'PUBLIC' WHEN 1 THEN 'PRIVATE' ELSE 'SHARED' END || '''}}' AS pool,
    substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-' || substr(digest, 13, 4) || '-'
      || substr(digest, 17, 4) || '-' || substr(digest, 21, 12) AS uuid
  FROM parts
),
lines AS (
  SELECT e AS ord, log_file, CASE kind
    WHEN 'purchase' THEN head || created || 'identity = ''' || uuid || ''', ' || pool
    WHEN 'view' THEN head || sync || CAST(CAST(floor(v) AS BIGINT) AS VARCHAR)
    WHEN 'click' THEN head || '[worker-1] KeySyncServiceImpl : METRIC_RECEIVED_PUBLIC_KEY_COUNT BITS='
      || CAST((u % 10 + 1) * 256 AS VARCHAR) || ' KEYS=' || CAST(u % 10 + 1 AS VARCHAR)
    WHEN 'signup' THEN head || '[exec-1] KeyPoolController : Handling qnl db sync with remote site '
      || CAST(u % 5 + 101 AS VARCHAR)
    ELSE CASE e % 9
      WHEN 0 THEN 'Invalid log line'
      WHEN 1 THEN head || 'Unknown event'
      WHEN 2 THEN head || created || pool
      WHEN 3 THEN seconds || '+0000 SiteId: 101  INFO 26 ' || sync || '7'
      WHEN 4 THEN head || sync || '99999999999'
      WHEN 5 THEN millis || '-0500 SiteId: 101  INFO 26 ' || sync || '8'
      WHEN 6 THEN chr(9) || ' ' || replace(head || sync || CAST(CAST(floor(v) AS BIGINT) AS VARCHAR), ' ', chr(160))
        || ' ' || chr(160)
      WHEN 7 THEN ' ' || chr(9) || chr(160) || ' '
      ELSE micros || '+0000 SiteId: 101  INFO 26 ' || sync || '9' END
    END AS value
  FROM heads
),
stripped AS (
  SELECT ord, log_file, value, regexp_replace(value, '^{_BLANKS}|{_BLANKS}$', '', 'g') AS raw_line FROM lines
),
tokens AS (
  SELECT *, string_split_regex(raw_line, '{_BLANKS}') AS t FROM stripped WHERE raw_line <> ''
),
typed AS (
  SELECT *, CASE
    WHEN len(t) < 5 THEN NULL
    WHEN contains(raw_line, 'createKey') AND contains(raw_line, 'sequence number') THEN 'KEY_CREATION'
    WHEN contains(raw_line, 'METRIC_KEY_SYNC_LATENCY') THEN 'SYNC_LATENCY'
    WHEN contains(raw_line, 'METRIC_RECEIVED_PUBLIC_KEY_COUNT') THEN 'KEY_COUNT'
    WHEN contains(raw_line, 'KeyPoolController') AND contains(raw_line, 'remote site') THEN 'CONTROLLER_SYNC'
    ELSE 'UNKNOWN' END AS log_type,
    CASE WHEN len(t) >= 5 THEN t[1] END AS time_text,
    CASE WHEN len(t) >= 5 THEN t[3] END AS site_id
  FROM tokens
),
texts AS (
  SELECT *,
    nullif(regexp_extract(raw_line, 'identity = ''([a-f0-9-]{{36}})''', 1), '') AS identity_t,
    nullif(regexp_extract(raw_line, 'sequence number ([0-9]+)', 1), '') AS sequence_t,
    nullif(regexp_extract(raw_line, 'Source site identity = ''([0-9]+)''', 1), '') AS source_t,
    nullif(regexp_extract(raw_line, 'Destination site identity = ''([0-9]+)''', 1), '') AS destination_t,
    nullif(regexp_extract(raw_line, 'KeyPoolType name = ''(PUBLIC|PRIVATE|SHARED)''', 1), '') AS pool_t,
    nullif(regexp_extract(raw_line, 'MS=([0-9]+)', 1), '') AS ms_t,
    nullif(regexp_extract(raw_line, 'BITS=([0-9]+)', 1), '') AS bits_t,
    nullif(regexp_extract(raw_line, 'KEYS=([0-9]+)', 1), '') AS keys_t,
    nullif(regexp_extract(raw_line, 'SiteId: ([0-9]+)', 1), '') AS local_t,
    nullif(regexp_extract(raw_line, 'remote site ([0-9]+)', 1), '') AS remote_t,
    CASE WHEN regexp_full_match(split_part(time_text, '+', 1),
      '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}T[0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}[.][0-9]{{1,6}}')
      THEN TRY_CAST(split_part(time_text, '+', 1) AS TIMESTAMP) END AS moment
  FROM typed
),
entries AS (
  SELECT *, CASE
    WHEN log_type IS NULL THEN 'too_few_tokens'
    WHEN log_type = 'UNKNOWN' THEN 'unknown'
    WHEN (log_type = 'KEY_CREATION' AND (identity_t IS NULL OR sequence_t IS NULL OR source_t IS NULL
           OR destination_t IS NULL OR pool_t IS NULL))
      OR (log_type = 'SYNC_LATENCY' AND ms_t IS NULL)
      OR (log_type = 'KEY_COUNT' AND (bits_t IS NULL OR keys_t IS NULL))
      OR (log_type = 'CONTROLLER_SYNC' AND (local_t IS NULL OR remote_t IS NULL)) THEN 'missing_fields'
    WHEN moment IS NULL THEN 'bad_timestamp'
    WHEN (log_type = 'KEY_CREATION' AND (TRY_CAST(sequence_t AS INTEGER) IS NULL
           OR TRY_CAST(source_t AS INTEGER) IS NULL OR TRY_CAST(destination_t AS INTEGER) IS NULL))
      OR (log_type = 'SYNC_LATENCY' AND TRY_CAST(ms_t AS INTEGER) IS NULL)
      OR (log_type = 'KEY_COUNT' AND (TRY_CAST(bits_t AS INTEGER) IS NULL OR TRY_CAST(keys_t AS INTEGER) IS NULL))
      OR (log_type = 'CONTROLLER_SYNC' AND (TRY_CAST(local_t AS INTEGER) IS NULL
           OR TRY_CAST(remote_t AS INTEGER) IS NULL)) THEN 'out_of_range'
    END AS reason
  FROM texts
),
creations AS (
  SELECT ord, identity_t AS key_identity, CAST(sequence_t AS INTEGER) AS sequence_number,
    CAST(source_t AS INTEGER) AS source_site_id, CAST(destination_t AS INTEGER) AS destination_site_id,
    pool_t AS key_pool_type, moment AS timestamp, log_file
  FROM entries WHERE log_type = 'KEY_CREATION' AND reason IS NULL
),
latencies AS (
  SELECT ord, CAST(ms_t AS INTEGER) AS latency_ms, moment AS timestamp, log_file
  FROM entries WHERE log_type = 'SYNC_LATENCY' AND reason IS NULL
),
counts AS (
  SELECT ord, CAST(bits_t AS INTEGER) AS bits, CAST(keys_t AS INTEGER) AS keys_count, moment AS timestamp, log_file
  FROM entries WHERE log_type = 'KEY_COUNT' AND reason IS NULL
),
syncs AS (
  SELECT ord, CAST(local_t AS INTEGER) AS local_site_id, CAST(remote_t AS INTEGER) AS remote_site_id,
    moment AS timestamp, log_file
  FROM entries WHERE log_type = 'CONTROLLER_SYNC' AND reason IS NULL
),
keys AS (
  SELECT * EXCLUDE (a, z, ord) FROM (
    SELECT * REPLACE (last_value(sequence_number) OVER (PARTITION BY key_identity ORDER BY ord
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS sequence_number),
      row_number() OVER (PARTITION BY key_identity ORDER BY ord) AS a, 0 AS z
    FROM creations) WHERE a = 1
),
sizes AS (
  SELECT log_file AS filename, CAST(sum(strlen(value) + 1) AS BIGINT) AS file_size FROM lines GROUP BY 1
),
stats AS (
  SELECT log_file AS filename, count(*) AS total_lines,
    count(*) FILTER (log_type = 'KEY_CREATION' AND reason IS NULL) AS key_creations,
    count(*) FILTER (log_type = 'SYNC_LATENCY' AND reason IS NULL) AS sync_latency,
    count(*) FILTER (log_type = 'KEY_COUNT' AND reason IS NULL) AS key_counts,
    count(*) FILTER (log_type = 'CONTROLLER_SYNC' AND reason IS NULL) AS controller_syncs,
    CAST(0 AS BIGINT) AS unknown,
    count(*) FILTER (reason IN ('missing_fields', 'bad_timestamp', 'out_of_range')) AS db_errors
  FROM entries GROUP BY 1
)"""


_PACKAGES = """
raw AS (
  SELECT event_id AS e, user_id AS u, value AS v, ts, event_type AS kind, (event_id // 50) % 5 AS turn,
    TIMESTAMP '2024-01-01' + to_seconds(event_id * 5) AS delivered,
    strftime(TIMESTAMP '2024-01-01' + to_seconds((event_id // 2) * 10), '%Y-%m-%dT%H:%M:%S.%fZ') AS package_timestamp
  FROM events
),
packages AS (
  SELECT *, 'package_' || strftime(delivered, '%Y%m%d_%H%M%S') || '.json' AS file_name,
    'collector-' || CAST(u % 4 AS VARCHAR) AS collector_id, 'http://station:5000' AS ogs_provider,
    'pass-' || CAST(e // 20 AS VARCHAR) AS own_pass,
    e % 50 = 0 AND turn = 0 AS no_environment, e % 50 = 0 AND turn = 1 AS no_link,
    e % 50 = 0 AND turn = 2 AS no_summary, e % 50 = 0 AND turn = 3 AS no_alerts,
    e % 50 = 0 AND turn = 4 AS no_schedule, e % 50 = 7 AS early
  FROM raw
),
status AS (
  SELECT *, NOT (no_environment OR early) AS environment_ok, NOT (no_link OR early) AS link_ok,
    NOT (no_summary OR early) AS summary_ok, NOT no_alerts AS alerts_ok,
    NOT (no_schedule OR early) AS schedule_ok
  FROM packages
),
ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY package_timestamp ORDER BY environment_ok DESC, e) AS environment_n,
    row_number() OVER (PARTITION BY package_timestamp ORDER BY link_ok DESC, e) AS link_n,
    row_number() OVER (PARTITION BY package_timestamp ORDER BY summary_ok DESC, e) AS summary_n,
    row_number() OVER (PARTITION BY package_timestamp ORDER BY alerts_ok DESC, e) AS alerts_n,
    row_number() OVER (PARTITION BY package_timestamp ORDER BY schedule_ok DESC, e) AS schedule_n
  FROM status
),
settled AS (
  SELECT package_timestamp, min(e) AS ord, arg_min(file_name, e) AS file_name,
    arg_min(collector_id, e) AS collector_id, count(*) AS deliveries,
    max(e) FILTER (environment_n = 1) AS environment_ord, max(e) FILTER (link_n = 1) AS link_ord,
    max(e) FILTER (summary_n = 1) AS summary_ord, max(e) FILTER (alerts_n = 1) AS alerts_ord,
    max(e) FILTER (schedule_n = 1) AS schedule_ord
  FROM ranked GROUP BY 1
),
environment AS (
  SELECT e AS ord, date_trunc('second', ts) AS timestamp, 'OGS-00' || CAST(u % 3 + 1 AS VARCHAR) AS ogs_id,
    e % 4 <> 0 AS dome_open, e % 4 = 1 AS dome_anomaly, v / 10 AS temperature, v / 50 AS wind_speed,
    CAST(e % 360 AS INTEGER) AS wind_direction, v / 5 AS humidity, v / 50 + 1000 AS air_pressure,
    CAST(e % 100 AS INTEGER) AS cloud_cover, e % 10 = 0 AS precipitation,
    CAST(e % 50000 AS INTEGER) AS brightness
  FROM ranked WHERE environment_n = 1 AND environment_ok
),
link AS (
  SELECT e AS ord, date_trunc('second', ts) AS timestamp, own_pass AS pass_id, e % 20 <> 0 AS quantum_locked,
    CASE e % 3 WHEN 0 THEN 'TRACKING' WHEN 1 THEN 'LOST' ELSE 'LOCKED' END AS tracking_status,
    CASE WHEN e % 11 <> 0 THEN v / 10000 END AS qber, v / 100 AS link_power_margin,
    -(v / 10) AS received_power, -(v / 20) AS uplink_power, -(v / 30) AS fso_uplink_power,
    -(v / 40) AS fso_downlink_power, CASE WHEN e % 4 = 0 THEN 'idle' ELSE 'active' END AS fso_status
  FROM ranked WHERE link_n = 1 AND link_ok
),
summary AS (
  SELECT e AS ord, own_pass AS pass_id, 'SAT-' || CAST(u % 2 + 1 AS VARCHAR) AS satellite_id,
    date_trunc('second', ts - INTERVAL 15 MINUTE) AS start_time, date_trunc('second', ts) AS end_time,
    900 AS total_duration_sec, CAST(e % 900 AS INTEGER) AS locked_duration_sec,
    CASE WHEN e % 7 <> 0 THEN v / 10 END AS lock_percentage, CAST(e % 4 AS INTEGER) AS lost_tracking_events,
    v / 8 AS avg_tracking_stability, CAST(u AS INTEGER) AS keys_distilled,
    CASE e % 3 WHEN 0 THEN 128 WHEN 1 THEN 256 ELSE 512 END AS key_size_bits,
    e % 9 <> 0 AS key_distillation_success, v / 50 AS avg_wind_speed, v / 10 AS avg_temperature,
    v / 5 AS avg_humidity, e % 10 = 0 AS precipitation_during_pass, e % 4 = 0 AS dome_closed_during_pass,
    kind AS notes
  FROM ranked WHERE summary_n = 1 AND summary_ok
),
summary_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY pass_id ORDER BY ord) AS a,
    row_number() OVER (PARTITION BY pass_id ORDER BY ord DESC) AS z
  FROM summary
),
passes AS (
  SELECT f.ord, f.pass_id, f.satellite_id, f.start_time, l.end_time, f.total_duration_sec, f.locked_duration_sec,
    l.lock_percentage, f.lost_tracking_events, f.avg_tracking_stability, l.keys_distilled, f.key_size_bits,
    f.key_distillation_success, f.avg_wind_speed, f.avg_temperature, f.avg_humidity,
    f.precipitation_during_pass, f.dome_closed_during_pass, f.notes
  FROM summary_numbered f JOIN summary_numbered l ON f.pass_id = l.pass_id AND f.a = 1 AND l.z = 1
),
alert_items AS (
  SELECT e, 0 AS pos, date_trunc('second', ts) AS timestamp,
    CASE WHEN e % 50 <> 3 THEN md5(CAST(e % 500 AS VARCHAR)) END AS alert_id,
    CASE e % 5 WHEN 0 THEN 'unknown-' || CAST(e AS VARCHAR) WHEN 1 THEN NULL
      WHEN 2 THEN 'pass-' || CAST(e // 20 + 1 AS VARCHAR) ELSE own_pass END AS related_pass_id, u, kind
  FROM ranked WHERE alerts_n = 1 AND alerts_ok AND kind = 'error' AND NOT early
  UNION ALL
  SELECT e, 1, CASE WHEN e % 6 <> 0 THEN date_trunc('second', ts) END,
    md5('second-' || CAST(e AS VARCHAR)), own_pass, u, kind
  FROM ranked WHERE alerts_n = 1 AND alerts_ok AND kind = 'error' AND e % 3 = 0 AND NOT early
),
alert_rows AS (
  SELECT e, pos, timestamp, alert_id,
    CASE WHEN e % 13 = 0 THEN 'info' WHEN e % 2 = 0 THEN 'warning' ELSE 'critical' END AS severity,
    CAST(e % 2 + 2 AS INTEGER) AS severity_code,
    CASE e % 3 WHEN 0 THEN 'weather_monitoring' WHEN 1 THEN 'link_tracking' ELSE 'dome_control' END AS component,
    'SCU-0' || CAST(e % 3 + 1 AS VARCHAR) AS component_id, kind || ' ' || CAST(u AS VARCHAR) AS description,
    'logged' AS action_taken, related_pass_id
  FROM alert_items
),
offered AS (
  SELECT * FROM (
    SELECT *, min(e) FILTER (environment_ok AND link_ok AND summary_ok AND alerts_ok)
      OVER (PARTITION BY package_timestamp) AS done_e FROM ranked
  ) WHERE alerts_ok AND (done_e IS NULL OR e <= done_e)
),
offered_items AS (
  SELECT e, 0 AS pos, date_trunc('second', ts) AS timestamp,
    CASE WHEN e % 50 <> 3 THEN md5(CAST(e % 500 AS VARCHAR)) END AS alert_id,
    CASE e % 5 WHEN 0 THEN 'unknown-' || CAST(e AS VARCHAR) WHEN 1 THEN NULL
      WHEN 2 THEN 'pass-' || CAST(e // 20 + 1 AS VARCHAR) ELSE own_pass END AS related_pass_id, u, kind
  FROM offered WHERE kind = 'error' AND (e % 50 <> 3 OR alerts_n = 1)
  UNION ALL
  SELECT e, 1, CASE WHEN e % 6 <> 0 THEN date_trunc('second', ts) END,
    md5('second-' || CAST(e AS VARCHAR)), own_pass, u, kind
  FROM offered WHERE kind = 'error' AND e % 3 = 0
),
offered_rows AS (
  SELECT e, pos, timestamp, alert_id,
    CASE WHEN e % 13 = 0 THEN 'info' WHEN e % 2 = 0 THEN 'warning' ELSE 'critical' END AS severity,
    CAST(e % 2 + 2 AS INTEGER) AS severity_code,
    CASE e % 3 WHEN 0 THEN 'weather_monitoring' WHEN 1 THEN 'link_tracking' ELSE 'dome_control' END AS component,
    'SCU-0' || CAST(e % 3 + 1 AS VARCHAR) AS component_id, kind || ' ' || CAST(u AS VARCHAR) AS description,
    'logged' AS action_taken, related_pass_id
  FROM offered_items
),
linked AS (
  SELECT a.* FROM offered_rows a WHERE a.timestamp IS NOT NULL AND (a.related_pass_id IS NULL
    OR EXISTS (SELECT 1 FROM passes p WHERE p.pass_id = a.related_pass_id AND p.ord <= a.e))
),
alerts AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY e, pos) AS n FROM linked
  ) WHERE n = 1 OR alert_id IS NULL
),
planned AS (
  SELECT e, o, u, v, ts, CASE o WHEN 1 THEN 'pass-' || CAST(e // 20 + 1 AS VARCHAR)
      WHEN 2 THEN CASE WHEN e % 40 <> 5 THEN 'pass-' || CAST(e // 20 + 2 AS VARCHAR) END END AS pass_id
  FROM ranked, (VALUES (1), (2)) AS offsets(o) WHERE schedule_n = 1 AND schedule_ok
),
schedule_rows AS (
  SELECT e, CAST(o - 1 AS INTEGER) AS pos, 'OGS-00' || CAST(u % 3 + 1 AS VARCHAR) AS ogs_id,
    date_trunc('second', ts) AS generated_at, pass_id, 'SAT-' || CAST(u % 2 + 1 AS VARCHAR) AS satellite_id,
    date_trunc('second', ts + to_minutes(o * 100 - 90)) AS start_time,
    date_trunc('second', ts + to_minutes(o * 100 - 75)) AS end_time,
    v / 7 + o AS max_elevation, v / 50 + o AS predicted_wind_speed, e % 10 = o AS predicted_precipitation,
    CAST(e % 20 + o AS INTEGER) AS predicted_cloud_cover, v / 10000 AS estimated_qber,
    CAST(u + o AS INTEGER) AS estimated_keys, e % 6 <> o AS pass_viable
  FROM planned WHERE pass_id IS NOT NULL
),
schedule_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY pass_id ORDER BY e, pos) AS a,
    row_number() OVER (PARTITION BY pass_id ORDER BY e DESC, pos DESC) AS z
  FROM schedule_rows
),
schedule AS (
  SELECT f.pass_id, f.satellite_id, f.ogs_id, f.start_time, f.end_time, f.max_elevation, f.pass_viable,
    l.predicted_wind_speed, l.predicted_precipitation, l.predicted_cloud_cover, l.estimated_qber,
    l.estimated_keys, l.generated_at
  FROM schedule_numbered f JOIN schedule_numbered l ON f.pass_id = l.pass_id AND f.a = 1 AND l.z = 1
),
alert_counts AS (
  SELECT e, count(*) FILTER (timestamp IS NOT NULL) AS n FROM alert_rows GROUP BY 1
),
ledger AS (
  SELECT s.package_timestamp, s.collector_id, s.deliveries,
    CAST(CAST(en.environment_ok AS INTEGER) + CAST(li.link_ok AS INTEGER) + CAST(su.summary_ok AS INTEGER)
      + coalesce(c.n, 0) AS INTEGER) AS records_inserted,
    en.environment_ok AS environment_done, li.link_ok AS link_done, su.summary_ok AS summary_done,
    al.alerts_ok AS alerts_done, sc.schedule_ok AS schedule_done
  FROM settled s JOIN status en ON en.e = s.environment_ord JOIN status li ON li.e = s.link_ord
    JOIN status su ON su.e = s.summary_ord JOIN status al ON al.e = s.alerts_ord
    JOIN status sc ON sc.e = s.schedule_ord LEFT JOIN alert_counts c ON c.e = s.alerts_ord
)"""

_PASS_COLUMNS = (
    "pass_id, satellite_id, start_time, end_time, total_duration_sec, locked_duration_sec, lock_percentage, "
    "lost_tracking_events, avg_tracking_stability, keys_distilled, key_size_bits, key_distillation_success, "
    "avg_wind_speed, avg_temperature, avg_humidity, precipitation_during_pass, dome_closed_during_pass, notes"
)
_ALERT_COLUMNS = (
    "timestamp, alert_id, severity, severity_code, component, component_id, description, action_taken, "
    "related_pass_id"
)
_SCHEDULE_COLUMNS = (
    "ogs_id, generated_at, pass_id, satellite_id, start_time, end_time, max_elevation, predicted_wind_speed, "
    "predicted_precipitation, predicted_cloud_cover, estimated_qber, estimated_keys, pass_viable"
)
_LEDGER_COLUMNS = (
    "f.filename, l.file_size, l.total_lines, f.key_creations AS key_creations_count, "
    "f.sync_latency AS sync_latency_count, f.key_counts AS key_count_count, "
    "f.controller_syncs AS controller_sync_count"
)
_NEWEST = "ORDER BY timestamp DESC, ord DESC"
_AT = f"TIMESTAMP '{AS_OF}'"
_SPAN = f"timestamp BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}'"


def _log(select: str, before: str | None = None) -> str:
    return f"WITH {_lines(before)}\n{select}"


def _station(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([_PACKAGES, *more]) + f"\n{select}"


def _renamed(before: str, suffix: str) -> str:
    """The CTEs of an earlier state of the log files, under other names."""
    import re

    ctes = _lines(before)
    for name in re.findall(r"(?m)^(\w+) AS \($", ctes):
        ctes = re.sub(rf"(?m)(^|FROM ){name}\b(?= AS \(| |$|\))", rf"\g<1>{name}{suffix}", ctes)
    return ctes


def _two_runs(select: str) -> str:
    return f"WITH {_lines()},\n{_renamed(LEDGER_CUT, '_1')}\n{select}"


def oracle_sql() -> dict[str, str]:
    passes = f"SELECT {_PASS_COLUMNS} FROM passes"
    alerts = f"SELECT {_ALERT_COLUMNS} FROM alerts"
    head = (
        "SELECT file_name, package_timestamp, collector_id, ogs_provider, "
        "CASE WHEN NOT no_environment AND NOT early THEN v / 10 END AS temperature, "
        "CAST(e AS INTEGER) AS total_fetches FROM packages"
    )
    creations = _log("SELECT * FROM keys")
    latest_link = _station(
        "SELECT timestamp, pass_id, quantum_locked, tracking_status, qber, link_power_margin, received_power "
        f"FROM link {_NEWEST} LIMIT 100"
    )
    reason = (
        "SELECT e AS ord, package_timestamp, '{s}' AS section, CASE WHEN no_{s} THEN 'missing_section' "
        "ELSE 'missing_required' END AS reason FROM status WHERE NOT {s}_ok"
    )
    sections = ("environment", "link", "summary", "alerts", "schedule")
    counts = {
        "key_creations": "keys", "sync_latency_metrics": "latencies", "key_count_metrics": "counts",
        "controller_syncs": "syncs", "ogs_environment_data": "environment", "ogs_link_data": "link",
        "ogs_pass_summary": "passes", "ogs_alerts": "alerts", "ogs_pass_schedule": "schedule",
        "ogs_processed_packages": "ledger",
    }
    twins = {
        "log_classify_counts": _log(
            "SELECT coalesce(log_type, 'NO_ENTRY') AS log_type, count(*) AS lines FROM entries GROUP BY 1"
        ),
        "log_header_fields": _log("SELECT ord, log_file, time_text, site_id, log_type, raw_line FROM entries"),
        "key_creation_parse": _log("SELECT * FROM creations"),
        "sync_latency_parse": _log("SELECT * FROM latencies"),
        "key_count_parse": _log("SELECT * FROM counts"),
        "controller_sync_parse": _log("SELECT * FROM syncs"),
        "rejected_lines": _log(
            "SELECT ord, log_file, log_type, raw_line, reason AS reject_reason FROM entries WHERE reason IS NOT NULL"
        ),
        "file_stats": _log(
            "SELECT s.filename, s.file_size, coalesce(total_lines, 0) AS total_lines, "
            "coalesce(key_creations, 0) AS key_creations, coalesce(sync_latency, 0) AS sync_latency, "
            "coalesce(key_counts, 0) AS key_counts, coalesce(controller_syncs, 0) AS controller_syncs, "
            "coalesce(unknown, 0) AS unknown, coalesce(db_errors, 0) AS db_errors "
            "FROM sizes s LEFT JOIN stats USING (filename)"
        ),
        "key_creation_upsert": creations,
        "log_catalogue": _log(
            "SELECT filename, file_size AS size, '/logs/' || filename AS download_url FROM sizes ORDER BY 1"
        ),
        "log_file_scan": creations,
        "stream_log_ingest": creations,
        "stream_sync_latency": _log("SELECT * EXCLUDE (ord) FROM latencies"),
        "stream_key_count": _log("SELECT * EXCLUDE (ord) FROM counts"),
        "stream_controller_sync": _log("SELECT * EXCLUDE (ord) FROM syncs"),
        "stream_file_ledger": _log(
            "SELECT s.filename, s.file_size, coalesce(total_lines, 0) AS total_lines, "
            "coalesce(key_creations, 0) AS key_creations_count, coalesce(sync_latency, 0) AS sync_latency_count, "
            "coalesce(key_counts, 0) AS key_count_count, coalesce(controller_syncs, 0) AS controller_sync_count "
            "FROM sizes s LEFT JOIN stats USING (filename)"
        ),
        "file_ledger_upsert": _two_runs(
            f"SELECT {_LEDGER_COLUMNS} FROM (SELECT * FROM stats_1 UNION ALL "
            "SELECT * FROM stats WHERE filename NOT IN (SELECT filename FROM stats_1)) f "
            "JOIN (SELECT filename, total_lines, file_size FROM stats JOIN sizes USING (filename)) l USING (filename)"
        ),
        "new_files": _two_runs(
            "SELECT filename, file_size FROM sizes WHERE filename NOT IN (SELECT filename FROM stats_1)"
        ),
        "key_creation_summary": _log(
            "SELECT key_pool_type, source_site_id, destination_site_id, CAST(timestamp AS DATE) AS date, "
            "count(*) AS total_keys, min(timestamp) AS first_key, max(timestamp) AS last_key "
            "FROM keys GROUP BY ALL"
        ),
        "latency_stats": _log(
            "SELECT CAST(timestamp AS DATE) AS date, round(avg(latency_ms), 4) AS avg_latency, "
            "min(latency_ms) AS min_latency, max(latency_ms) AS max_latency, count(*) AS measurement_count "
            "FROM latencies GROUP BY 1"
        ),
        "daily_key_production": _log(
            "SELECT CAST(timestamp AS DATE) AS date, key_pool_type, count(*) AS keys_produced, "
            "min(sequence_number) AS first_sequence, max(sequence_number) AS last_sequence "
            "FROM keys GROUP BY 1, 2 ORDER BY date DESC, "
            "CASE key_pool_type WHEN 'PUBLIC' THEN 1 WHEN 'PRIVATE' THEN 2 ELSE 3 END"
        ),
        "env_flatten": _station("SELECT * FROM environment"),
        "link_flatten": _station("SELECT * FROM link"),
        "pass_summary_upsert": _station(passes),
        "export_roundtrip": _station(passes),
        "stream_package_ingest": _station(passes),
        "alerts_ignore_fk": _station(alerts),
        "dump_restore": _station(alerts),
        "stream_alert_ingest": _station(alerts),
        "stream_compact_passes": _station(passes),
        "stream_compact_alerts": _station(alerts),
        "stream_environment": _station("SELECT * EXCLUDE (ord) FROM environment"),
        "stream_link": _station("SELECT * EXCLUDE (ord) FROM link"),
        "stream_schedule": _station(f"SELECT {_SCHEDULE_COLUMNS} FROM schedule"),
        "stream_compact_schedule": _station(f"SELECT {_SCHEDULE_COLUMNS} FROM schedule"),
        "schedule_flatten": _station(f"SELECT e AS ord, pos, {_SCHEDULE_COLUMNS} FROM schedule_rows"),
        "schedule_upsert": _station(f"SELECT {_SCHEDULE_COLUMNS} FROM schedule"),
        "collector_status": _station(
            "SELECT e AS ord, package_timestamp, collector_id, ogs_provider, 'operational' AS collector_status, "
            "CASE WHEN e > 0 THEN delivered END AS last_fetch, CAST(e AS INTEGER) AS total_fetches FROM packages"
        ),
        "package_dedup": _station("SELECT * EXCLUDE (collector_id) FROM settled"),
        "package_ledger_rows": _station("SELECT * FROM ledger"),
        "stream_package_ledger": _station(
            "SELECT * REPLACE (CAST(records_inserted AS BIGINT) AS records_inserted) FROM ledger"
        ),
        "package_status": _station(
            "SELECT e AS ord, file_name, package_timestamp, collector_id, environment_ok, link_ok, summary_ok, "
            "alerts_ok, environment_ok AND link_ok AND summary_ok AND alerts_ok AS package_ok FROM status"
        ),
        "ingest_counters": _station(
            "SELECT count(*) FILTER (done) AS total_processed, count(*) FILTER (NOT done) AS failed, "
            "max(moment) FILTER (done) AS last_process FROM (SELECT package_timestamp, "
            "bool_or(environment_ok AND link_ok AND summary_ok AND alerts_ok) AS done, "
            "max(TIMESTAMP '2024-01-01' + to_seconds((e // 2) * 10)) AS moment FROM status GROUP BY 1)"
        ),
        "rejected_sections": _station(" UNION ALL ".join(reason.format(s=s) for s in sections)),
        "rejected_items": _station(
            "SELECT 'ogs_alerts' AS \"table\", e AS ord, CAST(pos AS INTEGER) AS pos, 'timestamp' AS missing "
            "FROM alert_rows WHERE timestamp IS NULL UNION ALL "
            "SELECT 'ogs_pass_schedule', e, CAST(o - 1 AS INTEGER), 'pass_id' FROM planned WHERE pass_id IS NULL"
        ),
        "latest_environment": _station(
            "SELECT timestamp, ogs_id, dome_open, temperature, wind_speed, humidity, cloud_cover, precipitation "
            f"FROM environment {_NEWEST} LIMIT 100"
        ),
        "latest_link": latest_link,
        "day_table_scan": latest_link,
        "recent_passes": _station(
            "SELECT pass_id, satellite_id, start_time, end_time, lock_percentage, keys_distilled, key_size_bits, "
            "notes FROM passes ORDER BY start_time DESC NULLS LAST, ord DESC LIMIT 50"
        ),
        "active_alerts": _station(
            "SELECT timestamp, severity, component, description, action_taken FROM alerts "
            f"WHERE timestamp > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR ORDER BY timestamp DESC"
        ),
        "temperature_series": _station(
            "SELECT timestamp AS time_sec, temperature AS value, 'Temperature' AS metric FROM environment "
            f"WHERE {_SPAN} ORDER BY timestamp"
        ),
        "wind_series": _station(
            f"SELECT timestamp AS time_sec, wind_speed AS value FROM environment WHERE {_SPAN} ORDER BY timestamp"
        ),
        "qber_series": _station(
            f"SELECT timestamp AS time_sec, qber AS value FROM link WHERE {_SPAN} ORDER BY timestamp"
        ),
        "qber_latest_band": _station(
            "SELECT qber, CASE WHEN qber >= 0.03 THEN 'red' WHEN qber >= 0.02 THEN 'yellow' "
            "WHEN qber IS NOT NULL THEN 'green' END AS band, "
            "CASE WHEN qber IS NOT NULL THEN least(greatest(qber, 0.0), 0.05) / 0.05 END AS gauge "
            f"FROM (SELECT qber FROM link {_NEWEST} LIMIT 1)"
        ),
        "dome_status_now": _station(
            "SELECT dome_open, CASE WHEN dome_open THEN 'OPEN' WHEN NOT dome_open THEN 'CLOSED' END AS state, "
            "CASE WHEN dome_open THEN 'green' WHEN NOT dome_open THEN 'red' END AS colour "
            f"FROM (SELECT dome_open FROM environment {_NEWEST} LIMIT 1)"
        ),
        "recent_alerts_coloured": _station(
            "SELECT timestamp, severity, component, description, CASE severity WHEN 'warning' THEN 'yellow' "
            "WHEN 'critical' THEN 'red' END AS colour FROM alerts ORDER BY timestamp DESC, e DESC, pos DESC LIMIT 10"
        ),
        "recent_alert_buffer": _station(
            f"SELECT {_ALERT_COLUMNS}, count(*) OVER () AS count FROM "
            "(SELECT * FROM alerts ORDER BY timestamp DESC, e DESC, pos DESC LIMIT 10)"
        ),
        "package_catalogue": _station("SELECT DISTINCT file_name FROM packages"),
        "latest_package": _station(f"{head} ORDER BY file_name DESC LIMIT 1"),
        "package_by_name": _station(f"{head} WHERE file_name = '{WANTED_PACKAGE}'"),
        "package_assemble": _station(
            f"SELECT 'package_20240116_000000.json' AS file_name, '2024-01-16T00:00:00Z' AS package_timestamp, "
            f"(SELECT collector_id FROM packages WHERE e > 0 AND delivered <= {_AT} ORDER BY e DESC LIMIT 1) AS collector_id, "
            "strftime(en.timestamp, '%Y-%m-%dT%H:%M:%SZ') AS environment_time, en.temperature, en.dome_open, "
            "li.pass_id AS link_pass, li.qber, su.pass_id AS summary_pass, su.keys_distilled, "
            "CAST((SELECT count(*) FROM recent) AS INTEGER) AS alert_count, "
            "(SELECT string_agg(strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') || ' ' || description, ';' "
            "ORDER BY timestamp DESC, e DESC, pos DESC) FROM recent) AS alerts, "
            "(SELECT string_agg(pass_id || ' ' || strftime(start_time, '%Y-%m-%dT%H:%M:%SZ'), ';' ORDER BY pos) "
            "FROM schedule_rows WHERE e = (SELECT e FROM schedule_rows "
            f"WHERE generated_at <= {_AT} ORDER BY generated_at DESC, e DESC LIMIT 1)) AS planned "
            f"FROM (SELECT * FROM environment WHERE timestamp <= {_AT} {_NEWEST} LIMIT 1) en, "
            f"(SELECT * FROM link WHERE timestamp <= {_AT} {_NEWEST} LIMIT 1) li, "
            f"(SELECT * FROM summary WHERE end_time <= {_AT} ORDER BY end_time DESC, ord DESC LIMIT 1) su",
            f"recent AS (SELECT * FROM alerts WHERE timestamp <= {_AT} ORDER BY timestamp DESC, e DESC, pos DESC LIMIT 10)",
        ),
        "package_series": _station(
            "SELECT 'package_' || strftime(moment, '%Y%m%d_%H%M%S') || '.json' AS file_name, "
            "strftime(moment, '%Y-%m-%dT%H:%M:%SZ') AS package_timestamp, co.collector_id, "
            "strftime(en.timestamp, '%Y-%m-%dT%H:%M:%SZ') AS environment_time, en.temperature, en.dome_open, "
            "li.pass_id AS link_pass, li.qber, su.pass_id AS summary_pass, su.keys_distilled, "
            "CAST(coalesce(len(al.told), 0) AS INTEGER) AS alert_count, "
            "coalesce(array_to_string(list_reverse(al.told), ';'), '') AS alerts, pl.planned FROM moments "
            "ASOF LEFT JOIN en ON moment >= en.timestamp ASOF LEFT JOIN li ON moment >= li.timestamp "
            "ASOF LEFT JOIN su ON moment >= su.end_time ASOF LEFT JOIN al ON moment >= al.timestamp "
            "ASOF LEFT JOIN pl ON moment >= pl.generated_at ASOF LEFT JOIN co ON moment >= co.delivered",
            f"moments AS (SELECT unnest(generate_series(TIMESTAMP '{SERIES_DAY[0]}', TIMESTAMP '{SERIES_DAY[1]}', "
            "INTERVAL 10 SECOND)) AS moment)",
            "en AS (SELECT * FROM environment QUALIFY row_number() OVER (PARTITION BY timestamp ORDER BY ord DESC) = 1)",
            "li AS (SELECT * FROM link QUALIFY row_number() OVER (PARTITION BY timestamp ORDER BY ord DESC) = 1)",
            "su AS (SELECT * FROM summary QUALIFY row_number() OVER (PARTITION BY end_time ORDER BY ord DESC) = 1)",
            "al AS (SELECT timestamp, list(strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') || ' ' || description) OVER "
            "(ORDER BY timestamp, e, pos ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS told FROM alerts "
            "QUALIFY row_number() OVER (PARTITION BY timestamp ORDER BY e DESC, pos DESC) = 1)",
            "pl AS (SELECT generated_at, string_agg(pass_id || ' ' || strftime(start_time, '%Y-%m-%dT%H:%M:%SZ'), ';' "
            "ORDER BY pos) AS planned FROM schedule_rows GROUP BY generated_at, e "
            "QUALIFY row_number() OVER (PARTITION BY generated_at ORDER BY e DESC) = 1)",
            "co AS (SELECT collector_id, delivered FROM packages WHERE e > 0)",
        ),
        "log_listing": _log(
            "SELECT 'all' AS folder, filename, file_size AS size FROM sizes UNION ALL "
            "SELECT 'other', log_file || '', CAST(coalesce(sum(strlen(value) + 1) FILTER ("
            "NOT contains(value, 'METRIC') AND NOT contains(value, 'createKey')), 0) AS BIGINT) "
            "FROM lines GROUP BY log_file"
        ),
        "stream_dump_stats": _station(
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS records FROM {cte}"
                for name, cte in counts.items()
                if name.startswith("ogs_")
            )
        ),
        "stream_quarantine": _log(
            "SELECT ord, CASE WHEN ord % 23 <> 0 THEN key_identity END AS key_identity, "
            "CASE WHEN ord % 17 = 0 THEN 'FOREIGN' ELSE key_pool_type END AS key_pool_type, "
            "concat_ws(',', CASE WHEN ord % 23 = 0 THEN 'missing:key_identity' END, "
            "CASE WHEN ord % 17 = 0 THEN 'outside:key_pool_type' END) AS violations "
            "FROM creations WHERE ord % 17 = 0 OR ord % 23 = 0"
        ),
        "stream_violation_counts": _log(
            "SELECT 'key_creations' AS table_name, violation, CAST(rows AS BIGINT) AS rows FROM ("
            "SELECT 'rows' AS violation, count(*) AS rows FROM creations UNION ALL "
            "SELECT 'accepted', count(*) FILTER (ord % 17 <> 0 AND ord % 23 <> 0) FROM creations UNION ALL "
            "SELECT 'missing:key_identity', count(*) FILTER (ord % 23 = 0) FROM creations UNION ALL "
            "SELECT 'outside:key_pool_type', count(*) FILTER (ord % 17 = 0) FROM creations) WHERE rows > 0"
        ),
        "stream_package_dedup": _station(
            "SELECT DISTINCT package_timestamp FROM status WHERE environment_ok AND link_ok AND summary_ok AND alerts_ok"
        ),
        "table_stats": f"WITH {_lines()},\n{_PACKAGES}\n"
        + " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS records FROM {cte}" for name, cte in counts.items()
        ),
    }
    # Streamed forms of the batch queries give the same rows.
    same = {
        "stream_latest_environment": "latest_environment", "stream_latest_link": "latest_link",
        "stream_qber_latest": "qber_latest_band", "stream_dome_status": "dome_status_now",
        "stream_recent_alerts": "recent_alerts_coloured", "stream_alert_buffer": "recent_alert_buffer",
        "stream_active_alerts": "active_alerts", "stream_key_summary": "key_creation_summary",
        "stream_daily_production": "daily_key_production", "stream_latency_stats": "latency_stats",
        "stream_ingest_counters": "ingest_counters",
    }
    return twins | {streamed: twins[batch] for streamed, batch in same.items()}
