"""Schemas and fixed values of the telemetry data model.

Canonical in-engine form of "absent" text is ``''`` (never null); nulls are
produced only when a JSON document is rendered, so ``to_json`` drops the field.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results)
# ---------------------------------------------------------------------------

# Metrics CSV columns, in the documented file order.
CSV_COLUMNS = [
    "timestamp", "metric_name", "gpu_id", "device", "uuid", "modelName",
    "Hostname", "container", "pod", "namespace", "value", "labels_raw",
]
# Columns a header must contain, else the whole scan fails.
CSV_REQUIRED = [
    "timestamp", "metric_name", "gpu_id", "device", "uuid", "modelName",
    "Hostname", "value",
]
# Device metadata keys carried on every message.
METADATA_KEYS = [
    "hostname", "device", "gpu_index", "model_name", "container", "pod", "namespace",
]
# Metric catalogue: name, unit, family.
METRIC_CATALOGUE = [
    ("DCGM_FI_DEV_GPU_UTIL", "percent", "utilization"),
    ("DCGM_FI_DEV_MEM_COPY_UTIL", "percent", "utilization"),
    ("DCGM_FI_DEV_ENC_UTIL", "percent", "utilization"),
    ("DCGM_FI_DEV_DEC_UTIL", "percent", "utilization"),
    ("DCGM_FI_DEV_FB_USED", "bytes", "memory"),
    ("DCGM_FI_DEV_FB_FREE", "bytes", "memory"),
    ("DCGM_FI_DEV_MEM_CLOCK", "MHz", "clock"),
    ("DCGM_FI_DEV_SM_CLOCK", "MHz", "clock"),
    ("DCGM_FI_DEV_POWER_USAGE", "W", "power"),
    ("DCGM_FI_DEV_GPU_TEMP", "C", "temperature"),
]
# Device uuid format; the "GPU-" prefix is optional.  Patterns here match whole texts:
# Python uses fullmatch, columns functions.scalars.matches_whole.
UUID_PATTERN = r"(GPU-)?[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
# Request limits and queue defaults.
HISTORY_MAX_LIMIT = 10000
PREFETCH_MIN, PREFETCH_MAX = 1, 2500
VISIBILITY_TIMEOUT_SECONDS = 300
MAX_RETRIES = 3
DEFAULT_TOPIC = "telemetry"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

TELEMETRY_SCHEMA = T.StructType([
    T.StructField("gpu_uuid", S),
    T.StructField("metric_name", S),
    T.StructField("value", S),                  # kept as text: precision as sent
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("batch_id", S),
    T.StructField("labels_raw", S),
    T.StructField("seq", T.LongType()),         # arrival order, total-order tie-break
])

DEVICE_COLUMNS = [
    "uuid", "device_id", "gpu_index", "model_name", "hostname",
    "container", "pod", "namespace",
]

# payload and metadata are JSON text; metadata values may be of any JSON type.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("id", S),
    T.StructField("topic", S),
    T.StructField("payload", S),
    T.StructField("headers", T.MapType(S, S)),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("metadata", S),
])

DELIVERY_EVENT_SCHEMA = T.StructType([
    T.StructField("topic", S),
    T.StructField("consumer_group", S),
    T.StructField("consumer_id", S),
    T.StructField("message_id", S),
    T.StructField("op", S),                     # publish | fetch | ack | nack
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])
