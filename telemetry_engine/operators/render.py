"""API documents as JSON text, one document per row.

Empty optional fields are omitted (they are turned into nulls, which
``to_json`` drops).  Times are RFC 3339 in UTC with the shortest exact
fraction.  A history response is a per-request envelope (total, uuid,
range) plus one point document per row; the point list is never gathered
into one value, so a request on a hot device stays distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_engine.functions.scalars import empty_to_null
from telemetry_engine.functions.timeutil import format_rfc3339_nano


def device_documents(devices: DataFrame) -> DataFrame:
    """uuid, document: {uuid, device_id, gpu_index, model_name, hostname[, container, pod, namespace]}."""
    doc = F.to_json(F.struct(
        "uuid", "device_id", "gpu_index", "model_name", "hostname",
        empty_to_null(F.col("container")).alias("container"),
        empty_to_null(F.col("pod")).alias("pod"),
        empty_to_null(F.col("namespace")).alias("namespace"),
    ))
    return devices.select("uuid", doc.alias("document"))


def point_documents(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """keep + document: {gpu_uuid, metric_name, value, timestamp[, labels_raw]}."""
    doc = F.to_json(F.struct(
        "gpu_uuid", "metric_name", "value",
        format_rfc3339_nano("timestamp").alias("timestamp"),
        empty_to_null(F.col("labels_raw")).alias("labels_raw"),
    ))
    return rows.select(*(keep or []), doc.alias("document"))


def history_envelopes(totals: DataFrame, statuses: DataFrame) -> DataFrame:
    """request_id, document: {total, gpu_uuid[, start_time, end_time]} for ok requests."""
    t = totals.where(F.col("status") == "ok").select("request_id", "total")
    s = statuses.select("request_id", "uuid", "start_ts", "end_ts")
    j = t.join(s, "request_id")
    doc = F.to_json(F.struct(
        "total",
        F.col("uuid").alias("gpu_uuid"),
        format_rfc3339_nano("start_ts").alias("start_time"),
        format_rfc3339_nano("end_ts").alias("end_time"),
    ))
    return j.select("request_id", doc.alias("document"))
