"""Independent SQL for the catalogue, in DuckDB's dialect, over the base tables.

Shared sub-queries live in ``PARTS``; each statement names the ones it needs and
gets them as common table expressions, with whatever those need in turn.
"""

from __future__ import annotations


def num(x: str) -> str:
    """Number text without a trailing ``.0``."""
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


# name -> (needed parts, SQL)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLE: dict[str, str] = {}


def part(name: str, needs: str, sql: str) -> None:
    PARTS[name] = (tuple(needs.split()), sql)


def oracle(name: str, needs: str, sql: str) -> None:
    order: list[str] = []

    def visit(n: str) -> None:
        for m in PARTS[n][0]:
            visit(m)
        if n not in order:
            order.append(n)

    for n in needs.split():
        visit(n)
    head = ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in order)
    ORACLE[name] = f"WITH {head}\n{sql}" if order else sql


# --- sample tables -----------------------------------------------------------

part("base", "", """
SELECT event_id AS e, user_id AS u, ts AS event_ts, epoch_us(ts) // 1000 AS ts_ms,
  (event_id * 7919) % 1000 AS k,
  CASE event_type WHEN 'click' THEN 'voltage' WHEN 'view' THEN 'frequency'
    WHEN 'purchase' THEN 'current' WHEN 'error' THEN 'power_factor'
    WHEN 'signup' THEN 'temperature' END AS readingType
FROM events""")

part("clean", "base", """
SELECT e, u, event_ts, ts_ms, readingType,
  'sensor-' || CASE WHEN u < 1000 THEN lpad(CAST(u AS VARCHAR), 3, '0')
                    ELSE CAST(u AS VARCHAR) END AS sensorId,
  'zone-' || CAST(u % 3 + 1 AS VARCHAR) AS gridZone,
  CASE readingType WHEN 'voltage' THEN 'V' WHEN 'frequency' THEN 'Hz' WHEN 'current' THEN 'A'
    WHEN 'power_factor' THEN 'pf' ELSE 'degC' END AS unit,
  strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS timestamp,
  round(CASE readingType
    WHEN 'voltage' THEN CASE WHEN k < 900 THEN CAST(115 AS DOUBLE) + (k % 100) / 10
      WHEN k % 2 = 0 THEN CAST(114 AS DOUBLE) - (k - 899) / 5
      ELSE CAST(126 AS DOUBLE) + (k - 899) / 5 END
    WHEN 'frequency' THEN CASE WHEN k < 900 THEN CAST(59.6 AS DOUBLE) + (k % 80) / 100
      WHEN k % 2 = 0 THEN CAST(59.5 AS DOUBLE) - (k - 899) / 40
      ELSE CAST(60.5 AS DOUBLE) + (k - 899) / 40 END
    WHEN 'current' THEN CAST(15 AS DOUBLE) + (k - 500) / 500
    WHEN 'power_factor' THEN CAST(0.9 AS DOUBLE) + (k % 100) / 1000
    ELSE CAST(25 AS DOUBLE) + (k - 500) / 100 END, 3) AS value
FROM base""")

part("readings", "clean", """
SELECT e, u, event_ts, ts_ms, sensorId, timestamp, readingType, value, unit, gridZone,
  sensorId AS pk, timestamp || '#' || readingType AS sk,
  (ts_ms + 5000) // 1000 + 2592000 AS ttl
FROM clean""")

part("parts_", "clean", """
SELECT *, CASE WHEN dirt = 0 THEN upper(sensorId) ELSE sensorId END AS sid,
  printf('%.3f', value + CASE WHEN copy = 2 THEN 0.5 ELSE 0 END) AS num
FROM (
  SELECT *, unnest(CASE WHEN e % 40 = 3 THEN [0, 1] WHEN e % 60 = 11 THEN [0, 2] ELSE [0] END) AS copy,
    CASE WHEN e % 50 = 7 THEN (e // 50) % 10 ELSE -1 END AS dirt
  FROM clean)""")

part("raw", "parts_", """
SELECT e AS event_id, copy, 'shard-' || CAST(u % 4 AS VARCHAR) AS shard_id,
  CASE WHEN copy = 2 THEN 'r' ELSE 's' END || lpad(CAST(e AS VARCHAR), 12, '0') AS sequence_number,
  'sensors/' || sid || CASE WHEN e % 200 = 13 THEN '/status' ELSE '/telemetry' END AS topic,
  ts_ms + (e * 31) % 5000 + copy * 60000 AS arrival_ms, e // 10 AS batch_id, ts_ms,
  CASE WHEN dirt = 8 THEN left(text, 40) ELSE text END AS payload
FROM (
  SELECT *, '{"sensorId":"' || sid || '","timestamp":"'
    || CASE WHEN dirt = 1 THEN replace(timestamp, 'T', ' ') ELSE timestamp END
    || '","readingType":"' || CASE WHEN dirt = 2 THEN 'humidity' ELSE readingType END || '"'
    || CASE dirt WHEN 4 THEN '' WHEN 3 THEN ',"value":"' || num || '"' ELSE ',"value":' || num END
    || ',"unit":"' || CASE dirt WHEN 5 THEN repeat('u', 17) WHEN 6 THEN '' ELSE unit END || '"'
    || CASE WHEN dirt = 9 THEN ',"gridZone":null' WHEN u % 10 = 9 THEN ''
            ELSE ',"gridZone":"' || gridZone || '"' END
    || CASE WHEN dirt = 7 THEN ',"attacker":"payload"' ELSE '' END || '}' AS text
  FROM parts_)""")

_ERRORS = """CASE WHEN NOT ok OR json_type(doc) <> 'OBJECT' THEN 'not_an_object' ELSE concat_ws(',',
  CASE WHEN NOT coalesce(regexp_full_match({sid}, 'sensor-[a-z0-9-]+'), false) THEN 'sensorId' END,
  CASE WHEN NOT coalesce(json_type(doc, '$.timestamp') = 'VARCHAR'
    AND regexp_full_match(doc ->> '$.timestamp',
      '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d+)?(Z|[+-]\\d{{2}}:?\\d{{2}})')
    AND TRY_CAST(left(doc ->> '$.timestamp', 19) AS TIMESTAMP) IS NOT NULL, false) THEN 'timestamp' END,
  CASE WHEN NOT coalesce(json_type(doc, '$.readingType') = 'VARCHAR' AND doc ->> '$.readingType'
    IN ('voltage', 'current', 'frequency', 'power_factor', 'temperature'), false) THEN 'readingType' END,
  CASE WHEN coalesce(json_type(doc, '$.value'), '') NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN 'value' END,
  CASE WHEN NOT coalesce(json_type(doc, '$.unit') = 'VARCHAR'
    AND length(doc ->> '$.unit') BETWEEN 1 AND 16, false) THEN 'unit' END,
  CASE WHEN list_contains(json_keys(doc), 'gridZone') AND NOT coalesce(
    json_type(doc, '$.gridZone') = 'VARCHAR' AND length(doc ->> '$.gridZone') BETWEEN 1 AND 64, false)
    THEN 'gridZone' END,
  CASE WHEN len(list_filter(json_keys(doc), lambda x: x NOT IN
    ('sensorId', 'timestamp', 'readingType', 'value', 'unit', 'gridZone'))) > 0
    THEN 'unrecognized_keys' END) END"""

part("routed", "raw", """
SELECT *, split_part(topic, '/', 2) AS sid, json_valid(payload) AS ok,
  CASE WHEN json_valid(payload) THEN payload ELSE '{}' END AS doc
FROM raw WHERE regexp_full_match(topic, 'sensors/[^/]+/telemetry')""")

part("checked", "routed", f"""
SELECT *, {_ERRORS.format(sid='sid')} AS errors, sid AS sensorId,
  CASE WHEN json_type(doc, '$.timestamp') = 'VARCHAR' THEN doc ->> '$.timestamp' END AS timestamp,
  CASE WHEN json_type(doc, '$.readingType') = 'VARCHAR' THEN doc ->> '$.readingType' END AS readingType,
  CASE WHEN json_type(doc, '$.value') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
    THEN CAST(doc ->> '$.value' AS DOUBLE) END AS value,
  CASE WHEN json_type(doc, '$.unit') = 'VARCHAR' THEN doc ->> '$.unit' END AS unit,
  CASE WHEN json_type(doc, '$.gridZone') = 'VARCHAR' THEN doc ->> '$.gridZone' END AS gridZone
FROM routed""")

part("valid", "checked", "SELECT * FROM checked WHERE errors = ''")

part("writes", "valid", """
SELECT * FROM valid
QUALIFY row_number() OVER (PARTITION BY shard_id, sequence_number ORDER BY arrival_ms, payload) = 1""")

part("kept", "writes", """
SELECT * FROM writes
QUALIFY row_number() OVER (PARTITION BY sensorId, timestamp, readingType
  ORDER BY arrival_ms, shard_id, sequence_number) = 1""")

_LOW = "CASE readingType WHEN 'frequency' THEN CAST(59.5 AS DOUBLE) WHEN 'voltage' THEN CAST(114 AS DOUBLE) END"
_HIGH = "CASE readingType WHEN 'frequency' THEN CAST(60.5 AS DOUBLE) WHEN 'voltage' THEN CAST(126 AS DOUBLE) END"

_DETAILS = f"""CASE WHEN low IS NULL THEN readingType || ': no threshold configured'
  WHEN value < low THEN readingType || '=' || {num('value')} || unit || ' below min ' || {num('low')}
  WHEN value > high THEN readingType || '=' || {num('value')} || unit || ' above max ' || {num('high')}
  ELSE readingType || '=' || {num('value')} || unit || ' within [' || {num('low')} || ', ' || {num('high')} || ']' END"""

part("judged", "readings", f"""
SELECT *, coalesce(value < low OR value > high, false) AS exceeded, {_DETAILS} AS details,
  CASE WHEN value < low THEN low END AS broken_min, CASE WHEN value > high THEN high END AS broken_max
FROM (SELECT *, {_LOW} AS low, {_HIGH} AS high FROM readings)""")

part("sized", "judged", """
SELECT *, round(coalesce(broken_min - value, value - broken_max), 6) AS deviation,
  sensorId || '#' || timestamp || '#' || readingType AS case_pk
FROM judged WHERE exceeded""")

part("tiered", "sized", """
SELECT *, CASE WHEN deviation > t0 THEN 'P0' WHEN deviation >= t1 THEN 'P1'
    WHEN deviation >= t2 THEN 'P2' ELSE 'P3' END AS severity,
  CASE WHEN least(round(abs(deviation - t0), 6), round(abs(deviation - t1), 6),
    round(abs(deviation - t2), 6)) <= near THEN CAST(0.7 AS DOUBLE) ELSE CAST(0.95 AS DOUBLE) END AS confidence
FROM sized JOIN (VALUES ('frequency', 2.0::DOUBLE, 1.0::DOUBLE, 0.5::DOUBLE, 0.05::DOUBLE),
  ('voltage', 15.0::DOUBLE, 8.0::DOUBLE, 4.0::DOUBLE, 0.4::DOUBLE)) r(rt, t0, t1, t2, near)
  ON readingType = rt""")

part("breaches", "tiered", f"""
SELECT *, readingType || ' of ' || {num('value')} || unit || ' is ' || {num('deviation')} || unit || ' '
  || CASE WHEN broken_min IS NOT NULL THEN 'below min ' ELSE 'above max ' END
  || {num('coalesce(broken_min, broken_max)')} || '; tier ' || severity || '.' AS reasoning
FROM tiered""")

part("log", "kept", """
SELECT readingType, arrival_ms AS processed_ms, (event_id * 31) % 5000 AS latency_ms,
  arrival_ms - arrival_ms % 60000 AS minute_ms FROM kept""")

part("acks", "breaches", """
SELECT case_pk, (ts_ms // 1000) * 1000 + ((e * 17) % 1800) * 1000 AS ack_ms
FROM breaches WHERE e % 3 = 0""")

part("requests", "clean", """
SELECT request_id, requested_ms, (request_id * 17) % 300 AS latency_ms,
  CASE WHEN request_id % 7 = 0 THEN upper(sensorId)
    WHEN request_id % 31 = 0 THEN sensorId || '-absent' ELSE sensorId END AS sensorId,
  CASE WHEN request_id % 3 = 0 THEN NULL WHEN request_id % 37 = 0 THEN 'yesterday'
    ELSE strftime(day - INTERVAL 1 DAY, '%Y-%m-%d') || 'T00:00:00Z' END AS from_time,
  CASE WHEN request_id % 5 = 0 THEN NULL
    ELSE strftime(day + INTERVAL 1 DAY, '%Y-%m-%d') || 'T00:00:00Z' END AS to_time,
  CASE request_id % 11 WHEN 0 THEN '0' WHEN 1 THEN '1001' WHEN 2 THEN 'x' WHEN 3 THEN NULL
    WHEN 4 THEN '2.5' ELSE CASE request_id % 13 WHEN 0 THEN '1e2' WHEN 1 THEN ' 7 ' WHEN 2 THEN '10d' WHEN 3 THEN '1000'
      WHEN 4 THEN '0x10' WHEN 5 THEN '10f' ELSE '10' END END AS limit_text
FROM (SELECT sensorId, CAST(event_ts AS DATE) AS day, min(e) AS request_id,
        epoch_us(min(event_ts)) // 1000 AS requested_ms FROM clean GROUP BY ALL)""")

part("asked", "requests", """
SELECT *, CASE limit_text WHEN '10' THEN 10 WHEN '1e2' THEN 100 WHEN ' 7 ' THEN 7 WHEN '1000' THEN 1000 WHEN '0x10' THEN 16 END AS "limit",
  concat_ws(',',
  CASE WHEN NOT regexp_full_match(sensorId, 'sensor-[a-z0-9-]+') THEN 'sensorId' END,
  CASE WHEN from_time = 'yesterday' THEN 'from' END,
  CASE WHEN limit_text NOT IN ('10', '1e2', ' 7 ', '1000', '0x10') THEN 'limit' END) AS errors
FROM requests""")

part("items", "asked readings", """
SELECT r.request_id, r.sensorId, d.sk, d.value
FROM asked r JOIN readings d ON r.sensorId = d.pk
  AND (r.from_time IS NULL OR d.event_ts >= CAST(left(r.from_time, 19) AS TIMESTAMP))
  AND (r.to_time IS NULL OR d.event_ts <= CAST(left(r.to_time, 19) AS TIMESTAMP))
WHERE r.errors = ''
QUALIFY r."limit" IS NULL OR row_number() OVER (
  PARTITION BY r.request_id ORDER BY d.event_ts DESC, d.sk DESC) <= r."limit\"""")

part("served", "asked items", """
SELECT a.request_id, any_value(a.sensorId) AS sensorId, count(i.sk) AS item_count,
  max(i.sk) AS newest_sk, min(i.sk) AS oldest_sk
FROM asked a LEFT JOIN items i ON a.request_id = i.request_id
WHERE a.errors = '' GROUP BY a.request_id""")

part("based", "breaches", """
SELECT *, true AS email, severity IN ('P0', 'P1') AS sms FROM breaches""")

part("attempts", "based", """
SELECT e, case_pk, sensorId, readingType, severity, channel, attempt_no,
  ts_ms + attempt_no * 60000 AS attempt_ms,
  CASE WHEN channel = 'sms' AND e % 11 = 0 THEN NULL
    ELSE severity || ' ' || sensorId || ' ' || details END AS narrative,
  ((channel = 'email' AND (e + attempt_no) % 5 = 0)
    OR (channel = 'sms' AND (e + attempt_no) % 7 = 0)) AS fails,
  (e * 13 + attempt_no) % 400 AS latency_ms
FROM based
  JOIN (VALUES (1), (2), (3)) n(attempt_no)
    ON attempt_no = 1 OR (attempt_no = 2 AND e % 4 = 0) OR (attempt_no = 3 AND e % 8 = 0)
  JOIN (VALUES ('email'), ('sms')) c(channel) ON channel = 'email' OR sms""")

part("outcomes", "attempts", """
SELECT *, CASE WHEN narrative IS NULL THEN 'narrative_missing'
    WHEN attempt_no > first_ok THEN 'retry_already_delivered' END AS skip_reason,
  CASE WHEN narrative IS NULL OR attempt_no > first_ok THEN 'skipped'
    WHEN fails THEN 'failed' ELSE 'delivered' END AS kind,
  CASE WHEN narrative IS NULL OR attempt_no > first_ok THEN NULL WHEN fails THEN ''
    WHEN channel = 'sms' THEN 'MOCK-sms-' || attempt_ms || '-' || left(sha256(case_pk || '#sms'), 6)
    ELSE 'msg-' || left(sha256(case_pk || '#' || attempt_no), 12) END AS case_id
FROM (SELECT *, min(CASE WHEN narrative IS NOT NULL AND NOT fails THEN attempt_no END)
        OVER (PARTITION BY case_pk, channel) AS first_ok FROM attempts)""")

part("answers", "based", """
SELECT *, CASE WHEN e % 17 = 4 THEN 'P9' ELSE severity END AS answer_severity, e % 17 AS d,
  CASE e % 17 WHEN 0 THEN 1.2 WHEN 1 THEN -0.1 ELSE 0.9 END AS answer_confidence,
  CASE e % 17 WHEN 2 THEN 5 WHEN 3 THEN 501 ELSE length('reading ' || details) END AS reasoning_chars,
  CASE WHEN e % 17 = 8 THEN NULL ELSE sms END AS answer_sms,
  CASE e % 17 WHEN 7 THEN repeat('e', 19) WHEN 11 THEN NULL
    ELSE 'Breach report for ' || sensorId || '.' END AS email_text,
  CASE WHEN e % 17 = 6 THEN repeat('s', 161) WHEN sms THEN severity || ' ' || sensorId || ' ' || details
    END AS sms_text
FROM based""")

part("audited", "answers", """
SELECT *, concat_ws(',', CASE WHEN d = 4 THEN 'severity' END, CASE WHEN d IN (0, 1) THEN 'confidence' END,
    CASE WHEN reasoning_chars NOT BETWEEN 10 AND 500 THEN 'reasoning' END) AS severity_errors,
  concat_ws(',', CASE WHEN answer_sms IS NULL THEN 'sms' END,
    CASE WHEN d IN (5, 10) THEN 'overrideReason' END) AS plan_errors,
  concat_ws(',', CASE WHEN length(email_text) NOT BETWEEN 20 AND 1200 THEN 'email_length' END,
    CASE WHEN length(sms_text) NOT BETWEEN 10 AND 160 THEN 'sms_length' END,
    CASE WHEN email <> (email_text IS NOT NULL) THEN 'email_selection' END,
    CASE WHEN coalesce(answer_sms, false) <> (sms_text IS NOT NULL) THEN 'sms_selection' END) AS text_errors
FROM answers""")

# The wide signals of the catalogue: two breaches in a day, three sensors in six
# hours (a window every two hours), P2 between 22 and 6.
part("recent_day", "breaches", """
SELECT a.e, count(*) AS recent_breaches FROM breaches a JOIN breaches b
  ON a.sensorId = b.sensorId AND b.ts_ms // 1000 BETWEEN a.ts_ms // 1000 - 86400 AND a.ts_ms // 1000
GROUP BY a.e""")

part("cascades", "breaches", """
SELECT gridZone, start_s, count(DISTINCT sensorId) AS sensors
FROM (SELECT gridZone, sensorId, ((ts_ms // 1000) // 7200 - back) * 7200 AS start_s
      FROM breaches, (VALUES (0), (1), (2)) v(back))
GROUP BY gridZone, start_s""")

part("planned", "based recent_day cascades", """
SELECT b.* EXCLUDE (sms), r.recent_breaches, c.cascade_sensors,
  b.sms OR rep OR cas OR quiet AS sms, NOT b.sms AND (rep OR cas OR quiet) AS override_applied,
  CASE WHEN NOT b.sms AND (rep OR cas OR quiet) THEN concat_ws('; ',
    CASE WHEN rep THEN r.recent_breaches || ' breaches of this sensor in 1440 minutes' END,
    CASE WHEN cas THEN c.cascade_sensors || ' sensors of the zone breached within 360 minutes' END,
    CASE WHEN quiet THEN 'breach outside staffed hours' END) END AS override_reason
FROM based b JOIN recent_day r USING (e)
  JOIN (SELECT b2.e, max(c.sensors) AS cascade_sensors FROM breaches b2 JOIN cascades c
        ON b2.gridZone = c.gridZone AND b2.ts_ms // 1000 >= c.start_s AND b2.ts_ms // 1000 < c.start_s + 21600
        GROUP BY b2.e) c USING (e),
  LATERAL (SELECT r.recent_breaches >= 2 AS rep, c.cascade_sensors >= 3 AS cas,
    b.severity = 'P2' AND (hour(b.event_ts) >= 22 OR hour(b.event_ts) < 6) AS quiet)""")

part("told", "planned", """
SELECT *, severity || ' breach on ' || sensorId || ' (' || gridZone || ') at ' || timestamp || ': '
    || details || '. ' || reasoning || ' Notified by ' || CASE WHEN sms THEN 'email, sms' ELSE 'email' END
    || '.' AS email_text,
  CASE WHEN sms THEN severity || ' ' || sensorId || ' ' || details END AS sms_text
FROM planned""")

part("dlq", "clean", """
SELECT 'm-' || e AS message_id, ts_ms AS received_ms, e,
  CASE WHEN e % 4 <> 1 THEN ts_ms + (e * 7919) % 7200000 END AS handled_ms,
  CASE WHEN e % 9 = 4 THEN 'failed' ELSE 'ok' END AS inspection,
  e % 350 = 7 AS broken
FROM clean WHERE e % 50 = 7""")

part("inspected", "dlq", """
SELECT *, CASE WHEN broken THEN 'unknown' WHEN e % 3 = 0 THEN 'Unhandled'
    WHEN e % 3 = 1 THEN 'RetryAttemptsExhausted' ELSE 'unknown' END AS reason,
  CASE WHEN broken OR e % 7 = 2 THEN 'unknown' ELSE 's' || e || '..s' || (e + 9) END AS sequence_range,
  CASE WHEN broken OR e % 7 = 2 OR (e // 50) % 2 = 0 THEN 1 ELSE 1 + e % 10 END AS batch_size,
  CASE WHEN NOT broken AND e % 4 = 3 THEN e % 6 ELSE 0 END AS invoke_count
FROM dlq""")

part("runs", "breaches", """
SELECT 'run-' || lpad(CAST(e AS VARCHAR), 9, '0') AS name, ts_ms AS start_ms, e % 13 = 5 AS bad,
  CASE WHEN e % 29 = 3 THEN ts_ms + 300000 END AS aborted_ms,
  ts_ms + CASE WHEN e % 23 = 1 THEN 5400000 ELSE 900000 END AS done_ms,
  ts_ms + 3600000 AS limit_ms
FROM breaches""")

part("executions", "runs", """
SELECT name, start_ms, CASE WHEN stop <= 1706572800000 THEN stop END AS stop_ms,
  CASE WHEN stop > 1706572800000 THEN 'RUNNING' WHEN bad THEN 'FAILED' WHEN stop = aborted_ms THEN 'ABORTED'
    WHEN stop = done_ms THEN 'SUCCEEDED' ELSE 'TIMED_OUT' END AS status
FROM (SELECT *, CASE WHEN bad THEN start_ms ELSE least(coalesce(aborted_ms, done_ms), done_ms, limit_ms) END AS stop
      FROM runs)
WHERE start_ms <= 1706572800000""")

part("waited", "breaches acks", """
SELECT b.*, b.ts_ms AS notified_ms, a.ack_ms, a.ack_ms IS NULL AS escalated,
  CASE WHEN a.ack_ms IS NULL THEN b.ts_ms + 900000 END AS escalated_ms
FROM breaches b LEFT JOIN acks a ON a.case_pk = b.case_pk
  AND a.ack_ms BETWEEN b.ts_ms AND b.ts_ms + 900000""")

part("units_", "", "SELECT DISTINCT user_id AS u FROM events")

part("named", "units_", """
SELECT u, 'sensor-' || CASE WHEN u < 1000 THEN lpad(CAST(u AS VARCHAR), 3, '0')
  ELSE CAST(u AS VARCHAR) END AS sensorId,
  'asset-' || lpad(CAST(u % 40 AS VARCHAR), 2, '0') AS assetId FROM units_""")

part("mappings", "named", "SELECT * FROM named WHERE u % 25 <> 0")

part("assets", "named", """
SELECT DISTINCT u % 40 AS a, assetId, 'Conveyor ' || lpad(CAST(u % 40 AS VARCHAR), 2, '0') AS displayName,
  'zone-line-' || CAST((u % 40) % 6 AS VARCHAR) AS zoneId,
  CASE WHEN u % 40 <> 38 THEN ((u % 40) % 6) * 10.0::DOUBLE + 0.25::DOUBLE + ((u % 40) % 5) * 2 END AS x,
  CASE WHEN u % 40 <> 38 THEN 1.5::DOUBLE + ((u % 40) % 7) * 1.5::DOUBLE END AS y
FROM named WHERE u % 40 <> 39""")

part("zones", "units_", """
SELECT DISTINCT u % 6 AS z, 'zone-line-' || CAST(u % 6 AS VARCHAR) AS zoneId FROM units_ WHERE u % 6 <> 5""")


# --- ingest ------------------------------------------------------------------

oracle("topic_route", "routed", "SELECT event_id, copy, topic, sid AS sensorId FROM routed")
oracle("decode_payload", "raw", """
SELECT event_id, copy, CASE WHEN event_id % 70 <> 9 THEN payload END AS payload,
  event_id % 70 <> 9 AND json_valid(payload) AS is_object FROM raw""")
oracle("validate_events", "valid", """
SELECT event_id, copy, sensorId, timestamp, readingType, value, unit, gridZone FROM valid""")
oracle("validation_error_counts", "checked", """
SELECT error, count(*) AS records
FROM (SELECT unnest(string_split(errors, ',')) AS error FROM checked WHERE errors <> '') GROUP BY error""")
oracle("quarantine_rows", "checked", """
SELECT event_id, shard_id, sequence_number, payload, errors FROM checked WHERE errors <> ''""")

part("states", "raw", """
SELECT *, CASE WHEN payload LIKE '%}' THEN left(payload, length(payload) - 1)
  || ',"alert":{"acknowledged":false},"escalated":true}' ELSE payload END AS state FROM raw""")
part("projected", "states", """
SELECT event_id, copy, json_valid(state) AS ok,
  CASE WHEN json_valid(state) THEN state ELSE '{}' END AS full_doc,
  CASE WHEN json_valid(payload) THEN CASE WHEN payload LIKE '%attacker%'
    THEN replace(payload, ',"attacker":"payload"', '') ELSE payload END ELSE '{}' END AS doc
FROM states""")
oracle("escalation_projection", "projected", f"""
SELECT event_id, copy, sensorId, readingType, value, errors,
  CAST(CASE WHEN NOT ok THEN 1 ELSE CASE WHEN errors = '' THEN 0
    ELSE len(string_split(errors, ',')) END + 1 END AS INTEGER) AS strict_errors
FROM (SELECT *, doc ->> '$.sensorId' AS sensorId,
        CASE WHEN json_type(doc, '$.readingType') = 'VARCHAR' THEN doc ->> '$.readingType' END AS readingType,
        CASE WHEN json_type(doc, '$.value') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
          THEN CAST(doc ->> '$.value' AS DOUBLE) END AS value,
        {_ERRORS.format(sid="(doc ->> '$.sensorId')")} AS errors
      FROM projected)""")

oracle("put_readings_first_wins", "kept", """
SELECT event_id, copy, sensorId, timestamp, readingType, value, arrival_ms FROM kept""")
oracle("archive_daily_counts", "raw", """
SELECT strftime(make_timestamp(arrival_ms * 1000), '%Y') AS year,
  strftime(make_timestamp(arrival_ms * 1000), '%m') AS month,
  strftime(make_timestamp(arrival_ms * 1000), '%d') AS day,
  count(*) AS records, CAST(sum(length(payload)) AS BIGINT) AS payload_chars
FROM raw GROUP BY 1, 2, 3""")
oracle("dedup_sequence", "writes", """
SELECT shard_id, sequence_number, event_id, copy, arrival_ms FROM writes""")
oracle("duplicate_writes", "writes kept", """
SELECT sensorId, w - k AS duplicates, w AS writes
FROM (SELECT sensorId, count(*) AS w FROM writes GROUP BY 1)
  JOIN (SELECT sensorId, count(*) AS k FROM kept GROUP BY 1) USING (sensorId)
WHERE w > k""")
oracle("partial_batch_failures", "checked", """
SELECT batch_id, count(*) AS records, count(*) FILTER (WHERE errors <> '') AS failures
FROM checked GROUP BY 1""")
oracle("batch_item_failures", "checked", """
SELECT batch_id, sequence_number AS item_identifier FROM checked WHERE errors <> ''""")
oracle("dead_letter_routing", "checked", """
SELECT event_id, event_id % 8 AS attempts, arrival_ms,
  CASE WHEN event_id % 8 > 5 OR arrival_ms < 1706572800000 - 86400000 THEN 'dead_letter' ELSE 'retry' END AS route
FROM checked WHERE errors <> ''""")
oracle("out_of_order_readings", "valid", """
SELECT * FROM (
  SELECT sensorId, sequence_number, at_ms AS arrival_ms, ts_ms AS event_ms,
    lag(ts_ms) OVER (PARTITION BY sensorId ORDER BY at_ms, sequence_number) AS previous_ms
  FROM (SELECT *, arrival_ms + CASE WHEN event_id % 9 = 4 THEN 345600000 ELSE 0 END AS at_ms FROM valid))
WHERE event_ms < previous_ms""")
oracle("reading_keys", "readings", "SELECT e, pk, sk, ttl FROM readings")
oracle("case_keys", "clean", """
SELECT e, CASE WHEN e % 90 <> 4 THEN sensorId || '#' || timestamp || '#' || readingType END AS case_pk,
  e % 90 <> 4 AS ok FROM clean""")
oracle("active_readings", "readings", "SELECT pk, sk, ttl FROM readings WHERE ttl > 1707868800")

# --- thresholds --------------------------------------------------------------

oracle("evaluate_threshold", "judged", """
SELECT e, readingType, value, exceeded, broken_min, broken_max FROM judged""")
oracle("threshold_details", "judged", "SELECT e, details FROM judged")
oracle("evaluate_threshold_custom", "readings", """
SELECT e, readingType, value, coalesce(value < low OR value > high, false) AS exceeded,
  CASE WHEN value < low THEN low END AS broken_min, CASE WHEN value > high THEN high END AS broken_max
FROM readings LEFT JOIN (VALUES ('frequency', 59.8::DOUBLE, 60.2::DOUBLE), ('voltage', 100::DOUBLE, 140::DOUBLE),
  ('temperature', 21::DOUBLE, 29::DOUBLE)) t(rt, low, high) ON readingType = rt""")
oracle("threshold_alert_rule", "checked", """
SELECT event_id, copy, readingType, value, errors = '' AS passes_validation FROM checked
WHERE (readingType = 'frequency' AND (value < 59.5 OR value > 60.5))
   OR (readingType = 'voltage' AND (value < 114 OR value > 126))""")

# --- reads -------------------------------------------------------------------

_ROW = "pk, sk, readingType, value, unit"
oracle("sensor_range_query", "readings", f"""
SELECT {_ROW} FROM readings WHERE pk = 'sensor-007'
  AND event_ts BETWEEN TIMESTAMP '2024-01-04 00:00:00' AND TIMESTAMP '2024-01-25 10:00:00'
ORDER BY event_ts DESC, sk DESC LIMIT 25""")
oracle("sensor_range_ascending", "readings", f"""
SELECT {_ROW} FROM readings WHERE pk = 'sensor-003' AND event_ts >= TIMESTAMP '2024-01-10 00:00:00'""")
oracle("sensor_range_lexical", "readings", f"""
SELECT {_ROW} FROM readings WHERE pk = 'sensor-011' AND sk >= '2024-01-05' AND sk <= '2024-01-20T' || chr(65535)""")
oracle("validate_query_requests", "asked", 'SELECT request_id, CAST("limit" AS INTEGER) AS "limit", errors FROM asked')
oracle("batch_range_queries", "served", "SELECT * FROM served")
oracle("batch_range_items", "items", "SELECT * FROM items")
oracle("readings_by_type_window", "readings", f"""
SELECT {_ROW} FROM readings WHERE readingType = 'frequency'
  AND event_ts BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'""")
_LAST_WEEK = "event_ts BETWEEN TIMESTAMP '2024-01-23 00:00:00' AND TIMESTAMP '2024-01-30 00:00:00'"
oracle("recent_breaches", "judged", f"""
SELECT pk, sk, value, details FROM judged WHERE exceeded AND {_LAST_WEEK}""")
oracle("recent_breaches_by_type", "judged", f"""
SELECT pk, sk, value, details FROM judged WHERE exceeded AND readingType = 'voltage' AND {_LAST_WEEK}""")
oracle("latest_readings", "readings", """
SELECT sensorId, readingType, arg_max(value, event_ts) AS current_value, max(ts_ms) AS last_seen_ms
FROM readings GROUP BY 1, 2""")
oracle("fleet_counts", "readings", """
SELECT sensorId, count(*) AS readings, CAST(1 AS BIGINT) AS sensors FROM readings GROUP BY 1
UNION ALL SELECT '(all)', count(*), count(DISTINCT sensorId) FROM readings""")
oracle("low_voltage_readings", "readings", f"""
SELECT {_ROW} FROM readings WHERE readingType = 'voltage' AND value < 114""")
oracle("latest_ten", "readings", f"SELECT {_ROW} FROM readings ORDER BY event_ts DESC, pk, sk LIMIT 10")
oracle("breaches_from_raw", "kept", f"""
SELECT sensorId AS pk, timestamp || '#' || readingType AS sk, value, {_DETAILS} AS details, arrival_ms
FROM (SELECT *, {_LOW} AS low, {_HIGH} AS high FROM kept)
WHERE (value < low OR value > high) AND ts_ms BETWEEN 1705968000000 AND 1706572800000""")

# --- metrics -----------------------------------------------------------------

oracle("events_processed_by_type", "log", """
SELECT minute_ms, readingType, count(*) AS events FROM log GROUP BY 1, 2""")
oracle("events_processed_total", "log", "SELECT minute_ms, count(*) AS events FROM log GROUP BY 1")
oracle("events_processed_rollup", "log", """
SELECT minute_ms, readingType, count(*) AS events FROM log GROUP BY 1, 2
UNION ALL SELECT minute_ms, '(all)', count(*) FROM log GROUP BY 1""")
part("quantiles", "log", """
SELECT minute_ms, readingType, round(quantile_cont(latency_ms, 0.5), 6) AS p50,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99
FROM log GROUP BY 1, 2""")
oracle("latency_percentiles", "quantiles", "SELECT * FROM quantiles")
oracle("latency_sketch_daily", "log", """
SELECT processed_ms - processed_ms % 86400000 AS minute_ms, readingType, count(*) AS events, true AS within FROM log GROUP BY 1, 2""")
oracle("distinct_sensors_range", "readings", """
SELECT * FROM (WITH d AS (SELECT DISTINCT CAST(event_ts AS DATE) AS day, readingType, sensorId FROM readings),
k AS (SELECT DISTINCT day, readingType FROM d)
SELECT CAST(k.day AS VARCHAR) AS day, k.readingType, count(DISTINCT d.sensorId) FILTER (WHERE d.day = k.day) AS sensors,
  count(DISTINCT d.sensorId) AS sensors_in_range,
  count(DISTINCT d.sensorId) FILTER (WHERE d.day = k.day - 1
    AND NOT EXISTS (SELECT 1 FROM d t WHERE t.day = k.day AND t.readingType = k.readingType AND t.sensorId = d.sensorId)) AS silent_since_yesterday
FROM k JOIN d ON d.readingType = k.readingType AND d.day BETWEEN k.day - 6 AND k.day GROUP BY k.day, k.readingType)""")
oracle("latency_worst_case", "quantiles", """
SELECT minute_ms, max(p50) AS p50, max(p95) AS p95, max(p99) AS p99 FROM quantiles GROUP BY 1""")
oracle("failure_counters", "checked writes kept", """
SELECT minute_ms, CAST(sum(v) AS BIGINT) AS validation_errors, CAST(sum(v) AS BIGINT) AS partial_batch_failures,
  CAST(sum(d) AS BIGINT) AS duplicate_writes
FROM (SELECT arrival_ms - arrival_ms % 60000 AS minute_ms, 1 AS v, 0 AS d FROM checked WHERE errors <> ''
      UNION ALL SELECT w.arrival_ms - w.arrival_ms % 60000, 0, 1
      FROM writes w ANTI JOIN kept k ON w.shard_id = k.shard_id AND w.sequence_number = k.sequence_number)
GROUP BY 1""")
oracle("alerts_notified_vs_escalated", "waited", """
SELECT at_ms - at_ms % 60000 AS minute_ms, readingType, count(*) FILTER (WHERE kind = 'n') AS notified,
  count(*) FILTER (WHERE kind = 'x') AS escalated, count(*) FILTER (WHERE kind = 'v') AS validation_failed
FROM (SELECT readingType, CASE WHEN e % 50 = 7 THEN 'v' ELSE 'n' END AS kind, ts_ms AS at_ms FROM waited
      UNION ALL SELECT readingType, 'x', escalated_ms FROM waited WHERE escalated)
GROUP BY 1, 2""")
oracle("dispatch_metrics", "outcomes", """
SELECT channel, count(*) FILTER (WHERE kind = 'delivered') AS cases_created,
  count(*) FILTER (WHERE skip_reason = 'retry_already_delivered') AS cases_retried,
  count(*) FILTER (WHERE kind = 'failed') AS channel_failures,
  round(avg(latency_ms) FILTER (WHERE kind <> 'skipped'), 6) AS avg_latency_ms,
  round(quantile_cont(latency_ms, 0.95) FILTER (WHERE kind <> 'skipped'), 6) AS p95_latency_ms
FROM outcomes GROUP BY 1""")
oracle("query_metrics", "asked served", """
SELECT strftime(make_timestamp(a.requested_ms * 1000), '%Y-%m-%d') AS day,
  count(*) FILTER (WHERE a.errors = '') AS queries_served,
  count(*) FILTER (WHERE a.errors <> '') AS query_validation_errors,
  CAST(coalesce(sum(s.item_count), 0) AS BIGINT) AS items_returned,
  round(quantile_cont(a.latency_ms, 0.95) FILTER (WHERE a.errors = ''), 6) AS p95_latency_ms
FROM asked a LEFT JOIN served s USING (request_id) GROUP BY 1""")
part("hourly", "breaches", """
SELECT ts_ms - ts_ms % 3600000 AS hour_ms, count(*) AS invocations,
  CAST(sum(CASE WHEN e % 19 = 0 THEN 0 WHEN e % 4 = 0 THEN 900000 + e % 1000
    WHEN e % 2 = 0 THEN 700000 + e % 1000 + e % 300 ELSE 450000 + e % 1000 END) AS BIGINT) AS tokens,
  max((e * 7) % 900) AS max_latency_ms
FROM breaches GROUP BY 1""")
oracle("token_usage_hourly", "hourly", "SELECT * FROM hourly")
part("flow", "executions", """
SELECT at_ms - at_ms % 60000 AS minute_ms, count(*) FILTER (WHERE mark = 'STARTED') AS started,
  count(*) FILTER (WHERE mark = 'SUCCEEDED') AS succeeded, count(*) FILTER (WHERE mark = 'FAILED') AS failed
FROM (SELECT start_ms AS at_ms, 'STARTED' AS mark FROM executions
      UNION ALL SELECT stop_ms, status FROM executions WHERE status IN ('SUCCEEDED', 'FAILED'))
GROUP BY 1""")
oracle("workflow_counts", "flow", "SELECT * FROM flow")
oracle("dlq_counters", "dlq", """
SELECT received_ms - received_ms % 60000 AS minute_ms,
  count(*) FILTER (WHERE inspection = 'ok') AS messages_received,
  count(*) FILTER (WHERE inspection <> 'ok') AS inspection_failures
FROM dlq GROUP BY 1""")
oracle("override_audit", "planned", """
SELECT severity, count(*) AS plans, count(*) FILTER (WHERE override_applied) AS overrides
FROM planned GROUP BY 1""")

# --- alarms ------------------------------------------------------------------

part("depth_seconds", "dlq", """
SELECT s, sum(came) AS came, sum(went) AS went,
  sum(sum(came) - sum(went)) OVER (ORDER BY s) AS after
FROM (SELECT received_ms // 1000 AS s, 1 AS came, 0 AS went FROM dlq
      UNION ALL SELECT handled_ms // 1000, 0, 1 FROM dlq WHERE inspection = 'ok' AND handled_ms IS NOT NULL)
GROUP BY s""")
part("depth", "depth_seconds", """
SELECT g.m * 60000 AS period_ms, CAST(greatest(carried, coalesce(peak, carried)) AS DOUBLE) AS value
FROM (
  SELECT g.m, peak, coalesce(last_value(last_after IGNORE NULLS) OVER (
      ORDER BY g.m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS carried
  FROM (SELECT unnest(generate_series((min(s) // 86400) * 1440, (max(s) // 86400) * 1440 + 1439)) AS m
        FROM depth_seconds) g
    LEFT JOIN (SELECT s // 60 AS m, max(after + went) AS peak, arg_max(after, s) AS last_after
               FROM depth_seconds GROUP BY 1) p ON g.m = p.m) g""")
oracle("dlq_depth_series", "depth", "SELECT * FROM depth")


def changes(name: str, breaching: str, periods: int = 1, step: int = 60_000) -> str:
    """Islands of periods whose last ``periods`` periods are all in ``breaching``."""
    filters = " ".join(
        f"AND period_ms - {i * step} IN (SELECT period_ms FROM b)" for i in range(1, periods)
    )
    return f"""
SELECT '{name}' AS alarm, at_ms, state FROM (
  WITH b AS ({breaching}),
  ons AS (SELECT period_ms FROM b WHERE true {filters}),
  edges AS (SELECT period_ms, lag(period_ms) OVER (ORDER BY period_ms) AS p,
              lead(period_ms) OVER (ORDER BY period_ms) AS n FROM ons)
  SELECT period_ms AS at_ms, 'ALARM' AS state FROM edges WHERE p IS NULL OR p <> period_ms - {step}
  UNION ALL
  SELECT period_ms + {step}, 'OK' FROM edges WHERE n IS NULL OR n <> period_ms + {step})"""


_DLQ = changes("dlq-messages", "SELECT period_ms FROM depth WHERE value >= 1")
_P99 = changes(
    "p99-latency",
    "SELECT minute_ms AS period_ms FROM quantiles WHERE readingType = 'voltage' AND p99 > 2000",
    3,
)
_FLOW = changes("workflow-failures", "SELECT minute_ms AS period_ms FROM flow WHERE failed >= 1")
_TOKENS = changes(
    "token-runaway", "SELECT hour_ms AS period_ms FROM hourly WHERE tokens > 1000000", 1, 3_600_000
)
_BUSY = changes("busy-minutes", "SELECT DISTINCT minute_ms AS period_ms FROM log", 2)
oracle("alarm_dlq_depth", "depth", _DLQ)
oracle("alarm_p99_latency", "quantiles", _P99)
oracle("alarm_workflow_failures", "flow", _FLOW)
oracle("alarm_token_runaway", "hourly", _TOKENS)
oracle(
    "alarm_states",
    "depth quantiles flow hourly",
    " UNION ALL ".join((_BUSY, _DLQ, _P99, _FLOW, _TOKENS)),
)

# --- severity, routing, texts ------------------------------------------------

oracle("classify_severity", "breaches", "SELECT e, readingType, value, deviation, severity FROM breaches")
oracle("severity_reasoning", "breaches", "SELECT e, confidence, reasoning FROM breaches")
oracle("audit_severity_answers", "audited", "SELECT e, severity_errors AS errors FROM audited")
oracle("baseline_routing", "based", "SELECT e, severity, email, sms FROM based")
oracle("breach_recurrence", "breaches", """
SELECT a.e, count(*) AS recent_breaches FROM breaches a JOIN breaches b
  ON a.sensorId = b.sensorId AND b.ts_ms // 1000 BETWEEN a.ts_ms // 1000 - 1800 AND a.ts_ms // 1000
GROUP BY a.e""")
oracle("breach_recurrence_daily", "recent_day", "SELECT e, recent_breaches FROM recent_day")
oracle("zone_cascade", "breaches", """
SELECT gridZone, start_s AS window_start, count(DISTINCT sensorId) AS sensors
FROM (SELECT gridZone, sensorId, ((ts_ms // 1000) // 300 - back) * 300 AS start_s
      FROM breaches, (VALUES (0), (1), (2)) v(back))
GROUP BY 1, 2""")
oracle("routing_plan", "planned", """
SELECT e, severity, email, sms, override_applied, override_reason FROM planned""")
oracle("audit_routing_plans", "audited", "SELECT e, plan_errors AS errors FROM audited")
oracle("narratives", "told", "SELECT e, email_text, sms_text FROM told")
oracle("audit_narratives", "audited", "SELECT e, text_errors AS errors FROM audited")

_SUBJECT = f"""'Sensor: ' || sensorId || chr(10) || 'Reading type: ' || readingType || chr(10)
  || 'Value: ' || {num('value')} || ' ' || unit || chr(10) || 'Timestamp: ' || timestamp || chr(10)
  || 'Grid zone: ' || gridZone"""
oracle("prompt_texts", "planned", f"""
SELECT e, {_SUBJECT} || chr(10) || 'Threshold breach: ' || details AS severity_prompt,
  'Severity classification: ' || severity || chr(10) || 'Severity confidence: ' || {num('confidence')} || chr(10)
  || 'Severity reasoning: ' || reasoning || chr(10) || chr(10) || {_SUBJECT} AS routing_prompt,
  'Severity: ' || severity || ' (confidence ' || {num('confidence')} || ')' || chr(10)
  || 'Severity reasoning: ' || reasoning || chr(10) || chr(10)
  || 'Routing plan selected: ' || CASE WHEN sms THEN 'email, sms' ELSE 'email' END || chr(10)
  || 'Routing override applied: ' || coalesce(override_reason, 'no (baseline matrix)') || chr(10) || chr(10)
  || {_SUBJECT} || chr(10) || chr(10)
  || 'Generate narratives ONLY for the channels in "Routing plan selected" above.' AS narrative_prompt
FROM planned""")


def payload_sql(escalated: str) -> str:
    return f"""'{{"severity":"' || CASE WHEN {escalated} THEN 'P1' ELSE 'P2' END || '","sensorId":"' || sensorId
  || '","timestamp":"' || timestamp || '","readingType":"' || readingType || '","value":' || CAST(value AS VARCHAR)
  || ',"unit":"' || unit || '","gridZone":"' || gridZone || '"'
  || CASE WHEN broken_min IS NOT NULL THEN ',"threshold":{{"min":' || CAST(broken_min AS VARCHAR) || '}}'
          WHEN broken_max IS NOT NULL THEN ',"threshold":{{"max":' || CAST(broken_max AS VARCHAR) || '}}' ELSE '' END
  || ',"details":"' || details || '","escalated":' || CASE WHEN {escalated} THEN 'true' ELSE 'false' END || '}}'"""


oracle("fallback_payloads", "judged", f"""
SELECT e, {payload_sql('exceeded AND e % 2 = 0')} AS payload
FROM judged WHERE readingType IN ('voltage', 'frequency')""")
part("summary", "outcomes", """
SELECT case_pk, attempt_no,
  coalesce(string_agg(DISTINCT channel, ',' ORDER BY channel) FILTER (WHERE kind = 'delivered'), '') AS delivered,
  coalesce(string_agg(DISTINCT channel, ',' ORDER BY channel) FILTER (WHERE kind = 'failed'), '') AS failed,
  coalesce(string_agg(DISTINCT channel, ',' ORDER BY channel) FILTER (WHERE kind = 'skipped'), '') AS skipped
FROM outcomes GROUP BY 1, 2""")
oracle("enriched_payloads", "told summary", """
SELECT e, severity, confidence, false AS escalated, sms, override_reason, sms_text, delivered, failed, skipped
FROM told JOIN summary USING (case_pk) WHERE attempt_no = 1""")
oracle("alert_subjects", "breaches", """
SELECT e, '[' || severity || '] Grid sensor breach: ' || sensorId AS notify_subject,
  '[P1 ESCALATED] Grid sensor breach: ' || sensorId AS escalation_subject,
  '[' || severity || '] ' || sensorId || ' ' || readingType || ' breach' AS channel_subject
FROM breaches""")
oracle("alert_outbox", "judged audited waited inspected", """
SELECT 'grid-alerts' AS topic, '[P2] Grid sensor breach: ' || j.sensorId AS subject, j.ts_ms AS created_ms
FROM judged j LEFT JOIN audited a ON a.e = j.e
WHERE j.readingType IN ('voltage', 'frequency')
  AND (NOT j.exceeded OR (a.severity_errors || a.plan_errors || a.text_errors) <> '')
UNION ALL SELECT 'grid-alerts', '[P1 ESCALATED] Grid sensor breach: ' || sensorId, escalated_ms
FROM waited WHERE escalated
UNION ALL SELECT 'ops-alerts', '[DLQ] Telemetry pipeline: ' || batch_size || ' record(s) dead-lettered', received_ms
FROM inspected WHERE inspection = 'ok'""")

# --- dispatch and cases ------------------------------------------------------

oracle("selected_channels", "planned", """
SELECT e, 'email' AS channel FROM planned UNION ALL SELECT e, 'sms' FROM planned WHERE sms""")
oracle("channel_inputs", "attempts", """
SELECT e, channel, CAST(attempt_no AS INTEGER) AS attempt_no,
  CASE WHEN channel = 'email' THEN '[' || severity || '] ' || sensorId || ' ' || readingType || ' breach' END AS subject,
  CASE WHEN channel = 'sms' THEN '+15555550100' END AS phone_number, narrative AS body
FROM attempts""")
oracle("skip_reasons", "outcomes", """
SELECT case_pk, channel, CAST(attempt_no AS INTEGER) AS attempt_no,
  CASE WHEN narrative IS NULL THEN 'narrative_missing' WHEN channel = 'sms' THEN 'no_handler_registered'
    ELSE skip_reason END AS skip_reason
FROM outcomes WHERE channel = 'sms' OR skip_reason IS NOT NULL""")
part("final", "outcomes", """
SELECT case_pk, channel, CAST(attempt_no AS INTEGER) AS attempt_no, attempt_ms, severity, kind, skip_reason, case_id,
  CASE WHEN kind = 'delivered' AND channel = 'sms' THEN 'https://example-sms.invalid/log/' || case_id END AS external_url,
  CASE WHEN kind = 'failed' THEN 'timeout' END AS error,
  CASE WHEN kind <> 'skipped' THEN latency_ms END AS latency_ms
FROM outcomes""")
oracle("dispatch_outcomes", "final", "SELECT * EXCLUDE (attempt_ms, severity) FROM final")
oracle("dispatch_summary", "summary", """
SELECT case_pk, CAST(attempt_no AS INTEGER) AS attempt_no, delivered, failed, skipped FROM summary""")
part("metadata", "final acks", """
SELECT f.case_pk, arg_min(severity, attempt_no) AS severity, min(attempt_ms) AS created_ms,
  max(attempt_ms) AS updated_ms, min(a.ack_ms) AS resolved_ms
FROM final f LEFT JOIN acks a ON a.case_pk = f.case_pk GROUP BY 1""")
oracle("case_metadata", "metadata", "SELECT * FROM metadata")
part("channels", "final", """
SELECT case_pk, channel, arg_max(kind, attempt_no) FILTER (WHERE kind <> 'skipped') AS status,
  arg_max(case_id, attempt_no) FILTER (WHERE kind <> 'skipped') AS case_id,
  arg_max(external_url, attempt_no) FILTER (WHERE external_url IS NOT NULL) AS external_url,
  arg_max(error, attempt_no) FILTER (WHERE error IS NOT NULL) AS error,
  min(attempt_ms) FILTER (WHERE kind <> 'skipped') AS created_ms,
  max(attempt_ms) FILTER (WHERE coalesce(skip_reason, '') <> 'narrative_missing') AS updated_ms
FROM final GROUP BY 1, 2 HAVING count(*) FILTER (WHERE kind <> 'skipped') > 0""")
oracle("case_channels", "channels", "SELECT * FROM channels")
oracle("stream_cases", "metadata channels", """
SELECT case_pk, '__metadata__' AS "row", severity AS state, NULL AS case_id, NULL AS external_url, NULL AS error,
  created_ms, updated_ms, resolved_ms FROM metadata
UNION ALL SELECT case_pk, channel, status, case_id, external_url, error, created_ms, updated_ms, NULL FROM channels""")
oracle("case_lookup", "breaches metadata channels", """
SELECT k.case_pk, k."row", coalesce(m.severity, c.status) AS state,
  coalesce(m.created_ms, c.created_ms) AS created_ms, coalesce(m.updated_ms, c.updated_ms) AS updated_ms
FROM (SELECT case_pk, unnest(['__metadata__', 'email', 'sms']) AS "row" FROM breaches) k
  LEFT JOIN metadata m ON m.case_pk = k.case_pk AND k."row" = '__metadata__'
  LEFT JOIN channels c ON c.case_pk = k.case_pk AND k."row" = c.channel""")
oracle("retry_audit", "final", """
SELECT a.case_pk, a.case_id <> '' AND a.case_id = coalesce(b.case_id, a.case_id) AS case_id_stable,
  true AS created_unchanged, b.attempt_ms > a.attempt_ms AS updated_advanced,
  CAST(b.skip_reason IS NOT DISTINCT FROM 'retry_already_delivered' AS BIGINT) AS cases_retried
FROM final a JOIN final b USING (case_pk)
WHERE a.channel = 'email' AND b.channel = 'email' AND a.attempt_no = 1 AND b.attempt_no = 2""")

# --- workflow, dead letters, location ----------------------------------------

oracle("ack_escalation", "waited", """
SELECT case_pk, notified_ms, ack_ms, escalated, escalated_ms FROM waited""")
oracle("escalations", "waited", f"""
SELECT case_pk, escalated_ms AS alert_ms, '[P1 ESCALATED] Grid sensor breach: ' || sensorId AS subject,
  {payload_sql('escalated')} AS payload
FROM waited WHERE escalated""")
oracle("workflow_executions", "executions", "SELECT * FROM executions")
oracle("alert_history", "executions", """
SELECT * FROM executions WHERE status = 'SUCCEEDED' ORDER BY start_ms DESC, name LIMIT 50""")
oracle("dlq_inspect", "inspected", """
SELECT message_id, reason, sequence_range, batch_size, invoke_count FROM inspected""")
oracle("dlq_ops_alerts", "inspected", """
SELECT message_id, '[DLQ] Telemetry pipeline: ' || batch_size || ' record(s) dead-lettered' AS subject,
  '{"severity":"P3","reason":"' || reason || '","sequenceRange":"' || sequence_range || '","batchSize":' || batch_size
  || ',"approximateInvokeCount":' || invoke_count || ',"sqsMessageId":"' || message_id
  || '","replayPolicy":"manual triage required (REPLAY_TO_KINESIS not set)"}' AS message
FROM inspected WHERE inspection = 'ok'""")
oracle("dlq_still_queued", "dlq", """
SELECT message_id AS item_identifier, received_ms FROM dlq WHERE inspection <> 'ok'""")
oracle("enrich_location", "breaches mappings assets", """
SELECT b.e, b.sensorId, coalesce(m.assetId, '') AS assetId, coalesce(a.displayName, '') AS assetName,
  CASE WHEN m.assetId IS NULL THEN 'sensor_unmapped' WHEN a.assetId IS NULL THEN 'asset_missing'
    WHEN a.x IS NULL THEN 'location_missing' ELSE 'enriched' END AS enrichmentStatus,
  CASE WHEN a.x IS NOT NULL THEN a.zoneId END AS zoneId, a.x, a.y
FROM breaches b LEFT JOIN mappings m ON m.sensorId = b.sensorId LEFT JOIN assets a ON a.assetId = m.assetId""")
oracle("enriched_events", "breaches mappings assets", """
SELECT b.case_pk AS eventId, b.sensorId, coalesce(m.assetId, '') AS assetId, coalesce(a.displayName, '') AS assetName,
  b.severity, b.readingType AS metricName, b.value AS metricValue, coalesce(b.broken_min, b.broken_max) AS threshold, b.timestamp,
  CASE WHEN m.assetId IS NULL THEN 'sensor_unmapped' WHEN a.assetId IS NULL THEN 'asset_missing'
    WHEN a.x IS NULL THEN 'location_missing' ELSE 'enriched' END AS enrichmentStatus,
  CASE WHEN a.x IS NOT NULL THEN a.zoneId END AS zoneId
FROM breaches b LEFT JOIN mappings m ON m.sensorId = b.sensorId LEFT JOIN assets a ON a.assetId = m.assetId""")
oracle("asset_zone", "assets zones", """
SELECT assetId, a.zoneId, CASE WHEN z IS NOT NULL THEN 'Line ' || z END AS zone_name,
  CASE WHEN z IS NOT NULL THEN 'production' END AS zone_type
FROM assets a LEFT JOIN zones z ON z.zoneId = a.zoneId""")
oracle("registry_orphans", "named assets mappings", """
SELECT n.sensorId, n.assetId FROM named n JOIN assets a ON a.assetId = n.assetId
WHERE n.sensorId NOT IN (SELECT sensorId FROM mappings)""")
oracle("registry_missing_assets", "mappings assets", """
SELECT sensorId, assetId FROM mappings WHERE assetId NOT IN (SELECT assetId FROM assets)""")
oracle("registry_missing_zones", "assets zones", """
SELECT assetId, zoneId FROM assets WHERE zoneId NOT IN (SELECT zoneId FROM zones)""")
oracle("registry_unit_mismatch", "assets", """
SELECT assetId, 'cm' AS asset_units, 'meters' AS floor_units FROM assets WHERE a = 7""")
oracle("point_in_zone", "assets zones", """
SELECT assetId, a.zoneId AS named_zone, x, y, z.zoneId AS found_zone
FROM assets a LEFT JOIN zones z ON x >= z * 10 AND x < z * 10 + 10 AND y >= 0 AND y < 10""")
oracle("sensor_specific_breaches", "readings mappings", f"""
SELECT e, sensorId, value, {_DETAILS} AS details
FROM (SELECT r.*, CASE WHEN m.u % 2 = 0 THEN 112.0::DOUBLE + m.u % 3 ELSE 59.4::DOUBLE END AS low,
        CASE WHEN m.u % 2 = 0 THEN 128.0::DOUBLE - m.u % 3 ELSE 60.6::DOUBLE END AS high
      FROM readings r JOIN mappings m ON r.sensorId = m.sensorId
        AND r.readingType = CASE WHEN m.u % 2 = 0 THEN 'voltage' ELSE 'frequency' END)
WHERE value < low OR value > high""")

# --- streams: the same results as the batch forms ----------------------------

oracle("stream_ingest", "kept", """
SELECT sensorId, timestamp, readingType, value, unit, gridZone FROM kept""")
ORACLE["stream_archive"] = ORACLE["archive_daily_counts"]
oracle("stream_dead_letters", "checked", f"""
SELECT shard_id, sequence_number, arrival_ms,
  CASE WHEN arrival_ms < 1706572800000 - 16 * 86400000 THEN 'aged' ELSE errors END AS errors
FROM checked WHERE errors <> '' OR arrival_ms < 1706572800000 - 16 * 86400000""")
oracle("stored_round_trip", "kept", """
SELECT pk, sk, ttl, read FROM (
  SELECT sensorId AS pk, timestamp || '#' || readingType AS sk, arrival_ms // 1000 + 2592000 AS ttl, unnest(['range', 'active']) AS read FROM kept)
WHERE CASE read WHEN 'range' THEN pk = 'sensor-001' ELSE ttl > 1706572800 + 15 * 86400 END""")
oracle("expired_partitions", "readings", """
SELECT CAST(CAST(event_ts AS DATE) AS VARCHAR) AS day, count(*) AS n_rows FROM readings
WHERE CAST(event_ts AS DATE) + 31 > DATE '2024-02-14' GROUP BY 1""")
oracle("expired_days_removed", "readings", """
SELECT CAST(CAST(event_ts AS DATE) AS VARCHAR) AS day, count(*) AS n_rows,
  CASE WHEN CAST(event_ts AS DATE) = DATE '2024-01-20' THEN 1 ELSE count(DISTINCT value < 100) END AS parts
FROM readings GROUP BY CAST(event_ts AS DATE)
HAVING CAST(event_ts AS DATE) + 30 >= DATE '2024-02-14' OR max(ttl) > epoch(TIMESTAMP '2024-02-14 00:00:00')""")
oracle("registry_duplicates", "mappings", """
SELECT sensorId, CAST(2 AS BIGINT) AS n_rows FROM mappings WHERE sensorId LIKE '%7'""")
oracle("stream_dedup", "raw", "SELECT DISTINCT shard_id, sequence_number, event_id FROM raw")
oracle("stream_events_per_minute", "clean", """
SELECT ts_ms - ts_ms % 60000 AS minute_ms, readingType, count(*) AS events FROM clean GROUP BY 1, 2""")
oracle("stream_ack_escalation", "waited", """
SELECT case_pk, notified_ms, ack_ms, escalated FROM waited""")
ORACLE["stream_ack_timer"] = ORACLE["stream_ack_escalation"]
