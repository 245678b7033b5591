"""DuckDB SQL twins of :mod:`telemetry_engine.plans.queries` (same keys, same columns).

Written independently of the Spark code: JSON is built and parsed with
DuckDB's JSON functions, top-k and leases use window functions, and every
derived table is recomputed from the base views.
"""

from __future__ import annotations


def _uuid(x: str) -> str:
    return f"printf('GPU-%08x-0000-0000-0000-%012x', {x}, {x})"


def _nano(ts: str) -> str:
    return (
        f"(regexp_replace(regexp_replace(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f'), '0+$', ''), '\\.$', '') || 'Z')"
    )


RFC_RE = r"^(\d{4}-\d{2}-\d{2})T(\d{2}:\d{2}:\d{2})(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def _rfc(s: str) -> str:
    """Strict RFC 3339 text -> UTC TIMESTAMP or NULL."""
    zone = f"regexp_extract({s}, '{RFC_RE}', 4)"
    hh = f"(CASE WHEN {zone} = 'Z' THEN 0 ELSE CAST(substr({zone}, 2, 2) AS INTEGER) END)"
    mm = f"(CASE WHEN {zone} = 'Z' THEN 0 ELSE CAST(substr({zone}, 5, 2) AS INTEGER) END)"
    sign = f"(CASE WHEN starts_with({zone}, '-') THEN -1 ELSE 1 END)"
    local = (
        f"TRY_CAST(regexp_extract({s}, '{RFC_RE}', 1) || ' ' || regexp_extract({s}, '{RFC_RE}', 2)"
        f" || substr(regexp_extract({s}, '{RFC_RE}', 3), 1, 7) AS TIMESTAMP)"
    )
    return (
        f"(CASE WHEN regexp_matches({s}, '{RFC_RE}') AND {hh} < 24 AND {mm} < 60 "
        f"THEN {local} - to_minutes({sign} * ({hh} * 60 + {mm})) END)"
    )


def _open(fetch_ts: str, at: str) -> str:
    return f"(date_trunc('second', {fetch_ts} + INTERVAL 300 SECOND) > date_trunc('second', {at}))"


def _uuid_ok(x: str) -> str:
    """The uuid format, by lengths and places instead of a pattern."""
    bare = f"(CASE WHEN starts_with({x}, 'GPU-') THEN substring({x}, 5) ELSE {x} END)"
    dashes = " AND ".join(f"substring({bare}, {k}, 1) = '-'" for k in (9, 14, 19, 24))
    return (f"coalesce(length({bare}) = 36 AND {dashes} AND length(replace({bare}, '-', '')) = 32"
            f" AND translate(lower({bare}), '0123456789abcdef-', '') = '', false)")

TEL = f"""tel AS (
  SELECT {_uuid('user_id')} AS gpu_uuid, event_type AS metric_name,
         CAST(value AS VARCHAR) AS value, CAST(ts AS TIMESTAMP) AS timestamp,
         strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS batch_id,
         'k="' || json_extract_string(props, '$.k') || '"' AS labels_raw,
         event_id AS seq
  FROM events)"""

DEV = f"""dev AS (
  SELECT {_uuid('c_custkey')} AS uuid,
         'nvidia' || CAST(c_custkey % 8 AS VARCHAR) AS device_id,
         CAST(c_custkey % 8 AS VARCHAR) AS gpu_index,
         c_mktsegment AS model_name, c_name AS hostname, '' AS container, '' AS pod,
         coalesce(n_name, '') AS namespace
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

REC = f"""rec AS (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, event_type AS metric_name,
         CAST(user_id % 8 AS VARCHAR) AS gpu_id, 'nvidia' || CAST(user_id % 8 AS VARCHAR) AS device,
         {_uuid('user_id')} AS uuid, coalesce(c_mktsegment, '') AS modelName,
         coalesce(c_name, '') AS Hostname, '' AS container, '' AS pod,
         coalesce(n_name, '') AS namespace, CAST(value AS VARCHAR) AS value,
         'k="' || json_extract_string(props, '$.k') || '"' AS labels_raw,
         event_id AS seq, CAST(ts AS TIMESTAMP) AS ts, value AS v
  FROM events LEFT JOIN customer ON user_id = c_custkey
              LEFT JOIN nation ON c_nationkey = n_nationkey)"""

# what the derived CSV files hold once read back by name and trimmed
CSV = """csv AS (
  SELECT timestamp, metric_name, gpu_id, device,
         CASE WHEN metric_name = 'click' AND v < 1 THEN '' ELSE uuid END AS uuid,
         CASE WHEN metric_name = 'purchase' AND v >= 300 THEN modelName || ', rev B'
              WHEN seq % 3 = 2 AND ((metric_name = 'purchase' AND v < 300) OR (metric_name = 'error' AND v >= 300))
              THEN modelName || chr(10) || 'rev C'
              WHEN seq % 3 = 2 AND metric_name = 'signup' THEN modelName || ' 5" bay' ELSE modelName END AS modelName,
         Hostname, container, pod, namespace, value, labels_raw,
         CASE WHEN metric_name IN ('error', 'view') AND v >= 300 THEN 'field_count'
              WHEN metric_name = 'click' AND v < 1 THEN 'missing_required' END AS reject_reason
  FROM rec)"""

CSV_COLS = "timestamp, metric_name, gpu_id, device, uuid, modelName, Hostname, container, pod, namespace, value, labels_raw"

BATCH_TS_SQL = "TIMESTAMP '2024-02-01 00:00:00.12345'"
BATCH_ID_SQL = "'2024-02-01T00:00:00.12345Z'"

MSG = f"""msg0 AS (
  SELECT CAST(seq AS VARCHAR) AS id, 'telemetry' AS topic,
         CASE WHEN metric_name = 'click' AND v < 1 THEN '' ELSE uuid END AS uuid,
         metric_name, value, labels_raw, ts, seq, v,
         strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS batch_id,
         gpu_id, device, modelName, Hostname, container, pod, namespace
  FROM rec),
msg1 AS (
  SELECT *,
    '{{"gpu_uuid":' || CAST(to_json(uuid) AS VARCHAR)
      || ',"metric_name":' || CAST(to_json(metric_name) AS VARCHAR)
      || ',"value":' || CAST(to_json(value) AS VARCHAR)
      || ',"timestamp":"' || {_nano('ts')} || '"'
      || CASE WHEN batch_id <> '' THEN ',"batch_id":' || CAST(to_json(batch_id) AS VARCHAR) ELSE '' END
      || CASE WHEN labels_raw <> '' THEN ',"labels_raw":' || CAST(to_json(labels_raw) AS VARCHAR) ELSE '' END
      || '}}' AS payload0,
    '{{"container":' || CAST(to_json(container) AS VARCHAR)
      || ',"device":' || CAST(to_json(device) AS VARCHAR)
      || ',"gpu_index":' || CAST(to_json(gpu_id) AS VARCHAR)
      || ',"hostname":' || CAST(to_json(Hostname) AS VARCHAR)
      || ',"model_name":' || CAST(to_json(modelName) AS VARCHAR)
      || ',"namespace":' || CAST(to_json(namespace) AS VARCHAR)
      || ',"pod":' || CAST(to_json(pod) AS VARCHAR) || '}}' AS metadata0
  FROM msg0),
msg AS (
  SELECT id, topic, seq, ts AS timestamp, uuid, metric_name, batch_id,
    CASE WHEN metric_name = 'error' AND v >= 300 THEN substring(payload0, 1, 40)
         WHEN metric_name = 'signup' AND v >= 300
           THEN regexp_replace(payload0, '"timestamp":"[^"]*"', '"timestamp":"0001-01-01T00:00:00Z"')
         WHEN metric_name = 'click' AND v >= 300
           THEN left(payload0, length(payload0) - 1) || ',"extra":{{"value":1,"gpu_uuid":2}}}}'
         WHEN metric_name = 'purchase' AND v >= 300 THEN '{{"value":"0",' || substring(payload0, 2)
         WHEN metric_name = 'signup' AND v < 100
           THEN replace(CASE WHEN payload0 LIKE '%.%Z"%' AND regexp_matches(payload0, '[.][0-9]+Z"')
                             THEN regexp_replace(payload0, '([0-9])Z"', '\\10000000000123Z"') ELSE payload0 END,
                        '"gpu_uuid"', '"GPU_UUID"')
         WHEN metric_name = 'view' AND v >= 200 THEN '{{"Gpu_Uuid":"x","VALUE":null,' || substring(payload0, 2)
         ELSE payload0 END AS payload,
    -- what such a payload says is what it said before
    (metric_name = 'purchase' AND v >= 300) OR (metric_name = 'signup' AND v < 100) OR (metric_name = 'view' AND v >= 200)
      AS repeated, payload0,
    CASE WHEN metric_name = 'view' AND v < 10
         THEN replace(metadata0, '"gpu_index":"' || gpu_id || '"', '"gpu_index":' || gpu_id)
         WHEN metric_name = 'purchase' AND v < 10
         THEN replace(metadata0, '"device":"' || device || '"', '"device":' || gpu_id || ',"x":{{"device":"a"}}')
         ELSE metadata0 END AS metadata
  FROM msg1)"""

_FIELDS = ["gpu_uuid", "metric_name", "value", "timestamp", "batch_id", "labels_raw"]
_type_ok = " AND ".join(
    f"coalesce(json_type(payload, '$.{f}') IN ('VARCHAR', 'NULL'), true)" for f in _FIELDS
)
_ts_txt = "json_extract_string(payload, '$.timestamp')"
DEC = f"""dec0 AS (
  SELECT id, seq, metadata, CASE WHEN repeated THEN payload0 ELSE payload END AS payload,
         CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT' ELSE false END AS obj
  FROM msg),
dec1 AS (
  SELECT *, CASE WHEN obj THEN {_type_ok} AND NOT ({_ts_txt} IS NOT NULL AND {_rfc(_ts_txt)} IS NULL)
              ELSE false END AS good
  FROM dec0),
dec AS (
  SELECT id, seq, metadata,
    CASE WHEN good THEN coalesce(json_extract_string(payload, '$.gpu_uuid'), '') END AS gpu_uuid,
    CASE WHEN good THEN coalesce(json_extract_string(payload, '$.metric_name'), '') END AS metric_name,
    CASE WHEN good THEN coalesce(json_extract_string(payload, '$.value'), '') END AS value,
    CASE WHEN good AND {_rfc(_ts_txt)} <> TIMESTAMP '0001-01-01 00:00:00' THEN {_rfc(_ts_txt)} END AS timestamp,
    CASE WHEN good THEN coalesce(json_extract_string(payload, '$.batch_id'), '') END AS batch_id,
    CASE WHEN good THEN coalesce(json_extract_string(payload, '$.labels_raw'), '') END AS labels_raw,
    good
  FROM dec1),
decv AS (
  SELECT *, CASE WHEN NOT good THEN 'bad_json'
                 WHEN gpu_uuid = '' THEN 'missing_uuid'
                 WHEN metric_name = '' THEN 'missing_metric'
                 WHEN timestamp IS NULL THEN 'missing_timestamp' END AS reject_reason
  FROM dec)"""

REQ = f"""req AS (
  SELECT c_custkey AS request_id,
    CASE WHEN c_nationkey = 24 THEN ''
         WHEN c_nationkey = 23 THEN 'gpu-' || c_name
         WHEN c_nationkey = 22 THEN {_uuid('(c_custkey + 1000000000)')}
         WHEN c_nationkey = 12 THEN {_uuid('c_custkey')} || chr(10)
         ELSE {_uuid('c_custkey')} END AS uuid,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN ''
         WHEN c_nationkey = 21 THEN 'invalid'
         WHEN c_nationkey = 15 THEN '2024-01-05'
         WHEN c_nationkey = 11 THEN '2024-01-05T00:00:00Z' || chr(10)
         WHEN c_nationkey = 14 THEN printf('2024-01-%02dT%02d:00:00+02:00', 1 + c_nationkey % 10, c_custkey % 24)
         ELSE printf('2024-01-%02dT%02d:00:00Z', 1 + c_nationkey % 10, c_custkey % 24) END AS start_time,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN ''
         WHEN c_nationkey = 20 THEN '2024-13-01T00:00:00Z'
         WHEN c_nationkey = 19 THEN '2023-12-01T00:00:00Z'
         ELSE printf('2024-01-%02dT12:00:00Z', 1 + c_nationkey % 10 + 1 + c_custkey % 7) END AS end_time,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ''
         WHEN c_nationkey = 18 THEN 'abc'
         WHEN c_nationkey = 17 THEN '0'
         WHEN c_nationkey = 16 THEN '10001'
         WHEN c_nationkey = 13 THEN '10000'
         WHEN c_nationkey = 10 THEN '5' || chr(10)
         ELSE CAST(1 + c_custkey % 7 AS VARCHAR) END AS "limit"
  FROM customer)"""

VAL = f"""val0 AS (
  SELECT request_id, uuid, start_time, end_time, "limit",
    CASE WHEN start_time <> '' THEN {_rfc('start_time')} END AS start_ts,
    CASE WHEN end_time <> '' THEN {_rfc('end_time')} END AS end_ts,
    CASE WHEN "limit" <> '' AND regexp_matches("limit", '^[+-]?[0-9]+$') THEN TRY_CAST("limit" AS BIGINT) END AS limit_n
  FROM req),
val AS (
  SELECT request_id, uuid, start_ts, end_ts, limit_n,
    CASE WHEN uuid = '' THEN 'missing_uuid'
         WHEN NOT {_uuid_ok('uuid')} THEN 'invalid_uuid'
         WHEN start_time <> '' AND start_ts IS NULL THEN 'invalid_start'
         WHEN end_time <> '' AND end_ts IS NULL THEN 'invalid_end'
         WHEN start_ts > end_ts THEN 'invalid_range'
         WHEN "limit" <> '' AND (limit_n IS NULL OR limit_n < 1 OR limit_n > 10000) THEN 'invalid_limit'
    END AS status
  FROM val0),
st AS (
  SELECT request_id, uuid, start_ts, end_ts, limit_n,
    coalesce(status, CASE WHEN uuid IN (SELECT uuid FROM dev) THEN 'ok' ELSE 'not_found' END) AS status
  FROM val)"""

BULK = """hj AS (
  SELECT s.request_id, s.limit_n, t.gpu_uuid, t.metric_name, t.value, t.timestamp, t.labels_raw,
         row_number() OVER (PARTITION BY s.request_id ORDER BY t.timestamp DESC, t.seq DESC) AS r
  FROM st s JOIN tel t ON t.gpu_uuid = s.uuid
   AND (s.start_ts IS NULL OR t.timestamp >= s.start_ts)
   AND (s.end_ts IS NULL OR t.timestamp <= s.end_ts)
  WHERE s.status = 'ok'),
bulk AS (
  SELECT request_id, gpu_uuid, metric_name, value, timestamp, labels_raw
  FROM hj WHERE limit_n IS NULL OR r <= limit_n)"""

LOG = """log AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'telemetry' WHEN 1 THEN 'alerts' ELSE 'audit' END AS topic,
         CASE WHEN user_id % 3 = 2 AND event_type IN ('signup', 'error') THEN 'archivers' ELSE 'collectors' END AS consumer_group,
         'consumer-' || CAST(event_id % 4 AS VARCHAR) AS consumer_id,
         CAST(user_id AS VARCHAR) || ':' || strftime(ts, '%Y-%m-%d') AS message_id,
         CASE event_type WHEN 'signup' THEN 'publish' WHEN 'view' THEN 'fetch' WHEN 'click' THEN 'fetch'
                         WHEN 'purchase' THEN 'ack' WHEN 'error' THEN 'nack' END AS op,
         CAST(ts AS TIMESTAMP) AS ts, event_id AS seq
  FROM events)"""

K = "topic, consumer_group, message_id"

ACK = f"""ae AS (SELECT * FROM log WHERE op IN ('fetch', 'ack', 'nack')),
al AS (
  SELECT *,
    last_value(CASE WHEN op = 'fetch' THEN ts END IGNORE NULLS) OVER w AS lease_ts,
    last_value(CASE WHEN op = 'fetch' THEN seq END IGNORE NULLS) OVER w AS lease_seq
  FROM ae WINDOW w AS (PARTITION BY {K} ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ac AS (
  SELECT *, row_number() OVER (PARTITION BY {K}, lease_seq ORDER BY ts, seq) AS rn
  FROM al WHERE op IN ('ack', 'nack')),
acks AS (
  SELECT {K}, op, ts, seq, lease_seq,
    coalesce(lease_seq IS NOT NULL AND rn = 1 AND {_open('lease_ts', 'ts')}, false) AS matched
  FROM ac)"""

STATE = f"""as_of AS (SELECT max(ts) AS as_of_ts FROM log),
se AS (SELECT * FROM log WHERE ts <= (SELECT as_of_ts FROM as_of)),
sf AS (
  SELECT {K}, ts, seq,
    row_number() OVER (PARTITION BY {K} ORDER BY ts DESC, seq DESC) AS rn,
    count(*) OVER (PARTITION BY {K}) AS deliveries
  FROM se WHERE op = 'fetch'),
lf AS (SELECT * FROM sf WHERE rn = 1),
sk AS (SELECT DISTINCT {K} FROM se),
fc0 AS (
  SELECT c.topic, c.consumer_group, c.message_id, c.ts, c.op,
    row_number() OVER (PARTITION BY c.topic, c.consumer_group, c.message_id ORDER BY c.ts, c.seq) AS rn
  FROM se c JOIN lf USING ({K})
  WHERE c.op IN ('ack', 'nack') AND (c.ts > lf.ts OR (c.ts = lf.ts AND c.seq > lf.seq))),
fc AS (SELECT * FROM fc0 WHERE rn = 1),
s0 AS (
  SELECT sk.topic, sk.consumer_group, sk.message_id, lf.ts AS lf_ts,
         coalesce(lf.deliveries, 0) AS deliveries, fc.ts AS fc_ts, fc.op AS fc_op
  FROM sk LEFT JOIN lf USING ({K}) LEFT JOIN fc USING ({K})),
states AS (
  SELECT {K},
    CASE WHEN lf_ts IS NULL THEN 'ready'
         WHEN fc_ts IS NOT NULL AND {_open('lf_ts', 'fc_ts')} AND fc_op = 'ack' THEN 'acked'
         WHEN fc_ts IS NOT NULL AND {_open('lf_ts', 'fc_ts')} THEN 'ready'
         WHEN {_open('lf_ts', '(SELECT as_of_ts FROM as_of)')} THEN 'in_flight'
         WHEN deliveries >= 3 THEN 'dead_letter'
         ELSE 'redeliver' END AS state,
    deliveries, lf_ts AS last_fetch_ts
  FROM s0)"""

SUBS = """subs(topic, subscriber_id) AS (
  VALUES ('click', 'sub-a'), ('click', 'sub-b'), ('view', 'sub-a'),
         ('purchase', 'sub-a'), ('purchase', 'sub-b'), ('purchase', 'sub-c'),
         ('signup', 'sub-b'))"""

ROUTED = """routed AS (
  SELECT CAST(e.event_id AS VARCHAR) AS id, e.event_type AS topic, s.subscriber_id,
         (s.subscriber_id = 'sub-c' AND e.value > 250.0) AS handler_error
  FROM events e JOIN subs s ON e.event_type = s.topic)"""

CATALOGUE = """cat(metric_name, unit, family) AS (
  VALUES ('DCGM_FI_DEV_GPU_UTIL', 'percent', 'utilization'),
         ('DCGM_FI_DEV_MEM_COPY_UTIL', 'percent', 'utilization'),
         ('DCGM_FI_DEV_ENC_UTIL', 'percent', 'utilization'),
         ('DCGM_FI_DEV_DEC_UTIL', 'percent', 'utilization'),
         ('DCGM_FI_DEV_FB_USED', 'bytes', 'memory'),
         ('DCGM_FI_DEV_FB_FREE', 'bytes', 'memory'),
         ('DCGM_FI_DEV_MEM_CLOCK', 'MHz', 'clock'),
         ('DCGM_FI_DEV_SM_CLOCK', 'MHz', 'clock'),
         ('DCGM_FI_DEV_POWER_USAGE', 'W', 'power'),
         ('DCGM_FI_DEV_GPU_TEMP', 'C', 'temperature'))"""

API = "gpu_uuid, metric_name, value, timestamp, labels_raw"
DAY_END = "(date_trunc('day', ts) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND)"


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _far(zone: str) -> str:
    """The start time with a long fraction and another offset, where it is a plain time in Z."""
    text = f"left(start_time, length(start_time) - 1) || '.1234567890123{zone}'"
    return f"CASE WHEN length(start_time) = 20 AND right(start_time, 1) = 'Z' THEN {_rfc('(' + text + ')')} END"


ORACLE: dict[str, str] = {
    "csv_scan": _w(REC, CSV) + f"SELECT {CSV_COLS} FROM csv WHERE reject_reason IS NULL",
    "csv_rejects": _w(REC, CSV) + "SELECT uuid, metric_name, value, reject_reason FROM csv WHERE reject_reason IS NOT NULL",
    "ingest_stats": _w(REC, CSV) + """SELECT substring(timestamp, 1, 13) AS batch_id, count(*) AS rows_total,
        count(*) FILTER (WHERE reject_reason IS NULL) AS rows_sent,
        count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rows_rejected
        FROM csv GROUP BY 1""",
    "append_roundtrip": _w(TEL) + """SELECT *, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS event_date
        FROM (SELECT * FROM tel UNION ALL SELECT * FROM tel WHERE metric_name = 'signup')""",
    "metadata_get": _w(REC, MSG) + "SELECT id, " + ", ".join(
        f"json_type(metadata, '$.{k}') IS NOT NULL AS {k}_found, json_extract_string(metadata, '$.{k}') AS {k}_value"
        for k in ("device", "gpu_index", "x", "rack"))
        + """, true AS instance_id_found, 'streamer-0' AS instance_id_value, false AS trace_found,
        CAST(NULL AS VARCHAR) AS trace_value FROM msg""",
    "to_telemetry": _w(REC, CSV) + f"""SELECT uuid AS gpu_uuid, metric_name, value, {BATCH_TS_SQL} AS timestamp,
        {BATCH_ID_SQL} AS batch_id, labels_raw FROM csv WHERE reject_reason IS NULL""",
    "to_devices": _w(REC, CSV) + """SELECT uuid, device AS device_id, gpu_id AS gpu_index, modelName AS model_name,
        Hostname AS hostname, container, pod, namespace FROM csv WHERE reject_reason IS NULL""",
    "stamp_batch": _w(REC, CSV) + f"""SELECT {BATCH_ID_SQL} AS batch_id, {BATCH_TS_SQL} AS timestamp, count(*) AS n
        FROM csv WHERE reject_reason IS NULL""",
    "encode_messages": _w(REC, MSG) + """SELECT id, topic, payload, metadata, timestamp,
        'streamer-0' AS header_instance_id, uuid AS header_gpu_uuid,
        metric_name AS header_metric_name, batch_id AS header_batch_id FROM msg""",
    "message_ids": _w(REC, CSV) + """SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_uuid_v4
        FROM csv WHERE reject_reason IS NULL""",
    "message_headers": _w(REC, MSG) + """
        SELECT id, 'instance_id' AS header_key, 'streamer-0' AS header_value FROM msg
        UNION ALL SELECT id, 'gpu_uuid', uuid FROM msg
        UNION ALL SELECT id, 'metric_name', metric_name FROM msg
        UNION ALL SELECT id, 'batch_id', batch_id FROM msg""",
    "decode_messages": _w(REC, MSG, DEC) + """SELECT id, gpu_uuid, metric_name, value, timestamp, batch_id,
        labels_raw, reject_reason FROM decv""",
    "validate_telemetry": _w(REC, MSG, DEC) + """SELECT coalesce(reject_reason, 'valid') AS outcome, count(*) AS n
        FROM decv GROUP BY 1""",
    "message_devices": _w(REC, MSG, DEC) + """SELECT gpu_uuid AS uuid,
        """ + ",\n        ".join(
            f"CASE WHEN json_type(metadata, '$.{k}') = 'VARCHAR' THEN json_extract_string(metadata, '$.{k}') ELSE '' END AS {out}"
            for k, out in [("device", "device_id"), ("gpu_index", "gpu_index"), ("model_name", "model_name"),
                           ("hostname", "hostname"), ("container", "container"), ("pod", "pod"),
                           ("namespace", "namespace")]
        ) + ", seq FROM decv WHERE reject_reason IS NULL",
    "collector_stats": _w(REC, MSG, DEC) + """SELECT count(*) AS processed,
        count(*) FILTER (WHERE reject_reason IS NOT NULL) AS errors,
        count(*) FILTER (WHERE reject_reason IS NULL) AS gpus_stored,
        count(*) FILTER (WHERE reject_reason IS NULL) AS telemetry_stored FROM decv""",
    "list_devices": _w(DEV) + "SELECT * FROM dev",
    "devices_with_telemetry": _w(DEV, TEL) + "SELECT * FROM dev WHERE uuid IN (SELECT gpu_uuid FROM tel)",
    "get_device": _w(DEV) + "SELECT * FROM dev WHERE uuid = 'GPU-00000007-0000-0000-0000-000000000007'",
    "unknown_devices": _w(DEV, REQ) + f"""SELECT DISTINCT uuid FROM req
        WHERE {_uuid_ok('uuid')} AND uuid NOT IN (SELECT uuid FROM dev)""",
    "device_upsert": _w(DEV, REC) + """, u AS (
          SELECT uuid, device_id, gpu_index, model_name, hostname, container, pod, namespace,
                 0 AS src, CAST(NULL AS BIGINT) AS ord FROM dev
          UNION ALL
          SELECT uuid, device, gpu_id, modelName, Hostname, container, 'pod-' || metric_name, namespace,
                 1, seq FROM rec),
        r AS (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY src DESC, ord DESC NULLS LAST,
                 device_id DESC, gpu_index DESC, model_name DESC, hostname DESC, container DESC,
                 pod DESC, namespace DESC) AS rn FROM u)
        SELECT uuid, device_id, gpu_index, model_name, hostname, container, pod, namespace FROM r WHERE rn = 1""",
    "counts": _w(TEL, DEV) + """SELECT 'telemetry' AS store, count(*) AS n FROM tel
        UNION ALL SELECT 'devices', count(*) FROM dev""",
    "device_key": _w(DEV) + "SELECT uuid, hostname || ':' || device_id AS device_key FROM dev",
    "device_history": _w(TEL) + f"""SELECT {API} FROM tel
        WHERE gpu_uuid = 'GPU-00000007-0000-0000-0000-000000000007'
          AND timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND timestamp <= TIMESTAMP '2024-01-20 00:00:00'
        ORDER BY timestamp DESC, seq DESC LIMIT 20""",
    "uuid_check": _w(REQ) + f"""SELECT request_id, uuid,
        {_uuid_ok('uuid')} AS uuid_valid FROM req""",
    "validate_requests": _w(DEV, REQ, VAL) + "SELECT * FROM val",
    "bulk_history_status": _w(DEV, REQ, VAL) + "SELECT request_id, uuid, status FROM st",
    "bulk_history": _w(DEV, TEL, REQ, VAL, BULK) + "SELECT * FROM bulk",
    "history_total": _w(DEV, TEL, REQ, VAL, BULK) + """, c AS (SELECT request_id, count(*) AS n FROM bulk GROUP BY 1)
        SELECT st.request_id, st.uuid, st.status,
               CASE WHEN st.status = 'ok' THEN coalesce(c.n, 0) END AS total
        FROM st LEFT JOIN c USING (request_id)""",
    "dedup_telemetry": _w(TEL) + """, k AS (
          SELECT *, gpu_uuid || ':' || metric_name || ':' || batch_id AS point_key FROM tel),
        r AS (SELECT *, row_number() OVER (PARTITION BY point_key ORDER BY timestamp, seq) AS rn FROM k)
        SELECT gpu_uuid, metric_name, value, timestamp, batch_id, seq, point_key FROM r WHERE rn = 1""",
    "route_messages": _w(SUBS, ROUTED) + "SELECT * FROM routed",
    "unrouted_messages": _w(SUBS) + """SELECT CAST(event_id AS VARCHAR) AS id, event_type AS topic FROM events
        WHERE event_type NOT IN (SELECT topic FROM subs)""",
    "routing_stats": _w(SUBS, ROUTED) + """SELECT
        (SELECT count(*) FROM events) AS published,
        (SELECT count(*) FROM routed WHERE NOT handler_error) AS delivered,
        (SELECT count(*) FROM routed WHERE handler_error) AS errors,
        (SELECT count(*) FROM events WHERE event_type NOT IN (SELECT topic FROM subs)) AS unrouted,
        (SELECT count(DISTINCT topic) FROM subs) AS active_subscribers""",
    "ack_match": _w(LOG, ACK) + "SELECT * FROM acks",
    "ack_unmatched": _w(LOG, ACK) + f"SELECT {K}, op, ts, seq FROM acks WHERE NOT matched",
    "delivery_state": _w(LOG, STATE) + "SELECT * FROM states",
    "dead_letters": _w(LOG, STATE) + "SELECT * FROM states WHERE state = 'dead_letter'",
    "expired_leases": _w(LOG, STATE) + "SELECT * FROM states WHERE state IN ('redeliver', 'dead_letter')",
    "queue_stats": _w(LOG, STATE) + """, q AS (
          SELECT topic, consumer_group,
            count(*) FILTER (WHERE state IN ('ready', 'redeliver')) AS queue_depth,
            count(*) FILTER (WHERE state = 'in_flight') AS pending,
            count(*) FILTER (WHERE state = 'acked') AS acked,
            count(*) FILTER (WHERE state = 'dead_letter') AS dead_letters
          FROM states GROUP BY 1, 2),
        c AS (SELECT topic, consumer_group, count(DISTINCT consumer_id) AS consumers
              FROM log WHERE op = 'fetch' GROUP BY 1, 2)
        SELECT q.*, coalesce(c.consumers, 0) AS consumers FROM q LEFT JOIN c USING (topic, consumer_group)""",
    "topic_depth": _w(LOG, STATE) + """, g AS (
          SELECT topic, consumer_group, count(*) FILTER (WHERE state IN ('ready', 'redeliver')) AS queue_depth,
            count(*) FILTER (WHERE state = 'in_flight') AS pending, count(*) FILTER (WHERE state = 'acked') AS acked,
            count(*) FILTER (WHERE state = 'dead_letter') AS dead_letters FROM states GROUP BY 1, 2)
        SELECT coalesce(topic, '*') AS topic, count(*) AS groups, CAST(sum(queue_depth) AS BIGINT) AS queue_depth,
               CAST(sum(pending) AS BIGINT) AS pending, CAST(sum(acked) AS BIGINT) AS acked,
               CAST(sum(dead_letters) AS BIGINT) AS dead_letters
        FROM g GROUP BY ROLLUP (topic)""",
    "point_key": _w(TEL) + f"""SELECT seq, gpu_uuid || ':' || metric_name || ':' ||
        CASE WHEN metric_name = 'click' THEN {_nano('timestamp')} ELSE batch_id END AS point_key FROM tel""",
    "rfc3339": _w(REQ) + f"""SELECT request_id, start_time, {_rfc('start_time')} AS start_ts,
        coalesce(regexp_matches(start_time, '{RFC_RE}') AND {_rfc('start_time')} IS NOT NULL, false) AS start_valid,
        end_time, {_rfc('end_time')} AS end_ts, {_far('+19:00')} AS east_ts, {_far('-23:59')} AS west_ts,
        {_far('+24:00')} AS beyond_ts FROM req""",
    "rfc3339_format": _w(TEL) + f"""SELECT seq, strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS ts_rfc3339,
        {_nano('timestamp')} AS ts_rfc3339_nano FROM tel""",
    "day_bounds": _w(TEL) + """SELECT seq, CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS day_start,
        CAST(date_trunc('day', timestamp) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND AS day_end FROM tel""",
    "durations": _w(LOG) + f"""SELECT seq, ts + INTERVAL 300 SECOND AS lease_expires,
        ts - INTERVAL 300 SECOND AS lease_opened_before,
        (epoch_us({DAY_END}) - epoch_us(ts)) // 1000000 AS secs_to_day_end FROM log""",
    "clamp_prefetch": """SELECT event_id AS seq, CAST(trunc(value * 10) AS INTEGER) - 100 AS requested,
        least(greatest(CAST(trunc(value * 10) AS INTEGER) - 100, 1), 2500) AS prefetch FROM events""",
    "labels_map": _w(TEL) + """SELECT seq, 'metric' AS label_key, metric_name || ', "raw"' AS label_value
        FROM tel WHERE metric_name <> 'view'
        UNION ALL SELECT seq, 'k', batch_id FROM tel WHERE metric_name <> 'view'
        UNION ALL SELECT seq, NULL, NULL FROM tel WHERE metric_name = 'view'""",
    "numeric_value": _w(TEL) + "SELECT seq, value, TRY_CAST(value AS DOUBLE) AS value_num FROM tel",
    "metric_catalogue": _w(TEL, CATALOGUE) + """, m AS (
          SELECT CASE metric_name WHEN 'click' THEN 'DCGM_FI_DEV_GPU_UTIL' WHEN 'view' THEN 'DCGM_FI_DEV_FB_USED'
                   WHEN 'purchase' THEN 'DCGM_FI_DEV_POWER_USAGE' WHEN 'signup' THEN 'DCGM_FI_DEV_GPU_TEMP'
                   ELSE metric_name END AS metric_name, count(*) AS n FROM tel GROUP BY 1)
        SELECT m.metric_name, coalesce(cat.unit, '') AS unit, coalesce(cat.family, 'unknown') AS family, m.n
        FROM m LEFT JOIN cat ON m.metric_name = cat.metric_name""",
}

DEVICE_DOC = """'{"uuid":' || CAST(to_json(uuid) AS VARCHAR) || ',"device_id":' || CAST(to_json(device_id) AS VARCHAR) || ',"gpu_index":' || CAST(to_json(gpu_index) AS VARCHAR) || ',"model_name":' || CAST(to_json(model_name) AS VARCHAR) || ',"hostname":' || CAST(to_json(hostname) AS VARCHAR) || CASE WHEN container <> '' THEN ',"container":' || CAST(to_json(container) AS VARCHAR) ELSE '' END || CASE WHEN pod <> '' THEN ',"pod":' || CAST(to_json(pod) AS VARCHAR) ELSE '' END || CASE WHEN namespace <> '' THEN ',"namespace":' || CAST(to_json(namespace) AS VARCHAR) ELSE '' END || '}'"""
POINT_DOC = """'{"gpu_uuid":' || CAST(to_json(gpu_uuid) AS VARCHAR) || ',"metric_name":' || CAST(to_json(metric_name) AS VARCHAR) || ',"value":' || CAST(to_json(value) AS VARCHAR) || ',"timestamp":"' || {NANO_TS} || '"' || CASE WHEN labels_raw <> '' THEN ',"labels_raw":' || CAST(to_json(labels_raw) AS VARCHAR) ELSE '' END || '}'""".replace("{NANO_TS}", _nano("timestamp"))
ORACLE["device_documents"] = _w(DEV) + f"SELECT uuid, {DEVICE_DOC} AS document FROM dev"
ORACLE["history_documents"] = _w(DEV, TEL, REQ, VAL, BULK) + f"SELECT request_id, {POINT_DOC} AS document FROM bulk"
ORACLE["history_envelopes"] = _w(DEV, TEL, REQ, VAL, BULK) + f""", c AS (SELECT request_id, count(*) AS n FROM bulk GROUP BY 1)
    SELECT st.request_id,
      '{{"total":' || CAST(coalesce(c.n, 0) AS VARCHAR) || ',"gpu_uuid":' || CAST(to_json(st.uuid) AS VARCHAR)
      || CASE WHEN st.start_ts IS NOT NULL THEN ',"start_time":"' || {_nano('st.start_ts')} || '"' ELSE '' END
      || CASE WHEN st.end_ts IS NOT NULL THEN ',"end_time":"' || {_nano('st.end_ts')} || '"' ELSE '' END
      || '}}' AS document
    FROM st LEFT JOIN c USING (request_id) WHERE st.status = 'ok'"""
