"""Named queries over the driver's tables (each takes ``(spark, sf_dir)``).

Every query reads whole tables, or stores Spark derived from them; none
samples, caps or filters rows away to stay cheap.  The matching DuckDB SQL
lives in :mod:`telemetry_engine.plans.oracle` under the same key.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine import adapters
from telemetry_engine.functions import scalars, timeutil
from telemetry_engine.operators import delivery, dedup, history, ingest, messages, registry, render, routing
from telemetry_engine.plans.catalog import messages_table, metrics_csv_dir, run_dir, telemetry_table
from telemetry_engine.schemas import CSV_COLUMNS, METRIC_CATALOGUE
from telemetry_engine.session import materialize
from telemetry_engine.sources.csv_metrics import good_rows, read_metrics_csv, rejected_rows
from telemetry_engine.sources.store import (
    append_telemetry, read_registry, read_telemetry, upsert_registry, write_registry,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed request parameters of the point queries.
POINT_DEVICE_ID = 7
HISTORY_START = "2024-01-05T00:00:00Z"
HISTORY_END = "2024-01-20T00:00:00Z"
HISTORY_LIMIT = 20  # fewer than the device has in that time
BATCH_TS = datetime(2024, 2, 1, 0, 0, 0, 123450)
ROUTING_FAILS_ABOVE = 250.0
CATALOGUE_NAMES = {"click": METRIC_CATALOGUE[0][0], "view": METRIC_CATALOGUE[4][0],
                   "purchase": METRIC_CATALOGUE[8][0], "signup": METRIC_CATALOGUE[9][0]}


def _t(spark, sf, name):
    return adapters.load(spark, sf, name)


def _devices(spark, sf):
    return adapters.devices_from_customers(_t(spark, sf, "customer"), _t(spark, sf, "nation"))


def _scan(spark, sf):
    return read_metrics_csv(spark, metrics_csv_dir(spark, sf))


def _decoded(spark, sf):
    return messages.decode_messages(messages_table(spark, sf))


def _statuses(spark, sf):
    req = adapters.history_requests_from_customers(_t(spark, sf, "customer"))
    return history.request_status(req, _devices(spark, sf))


def _log(spark, sf):
    return adapters.delivery_log_from_events(_t(spark, sf, "events"))


def _routing(spark, sf):
    msgs = adapters.routing_messages_from_events(_t(spark, sf, "events"))
    subs = adapters.subscriptions(spark)
    fails = (F.col("subscriber_id") == "sub-c") & (F.col("value") > ROUTING_FAILS_ABOVE)
    return msgs, subs, fails


# ---------------------------------------------------------------- sources / sinks


def q_csv_scan(spark, sf):
    return good_rows(_scan(spark, sf)).select(*CSV_COLUMNS)


def q_csv_rejects(spark, sf):
    return rejected_rows(_scan(spark, sf)).select("uuid", "metric_name", "value", "reject_reason")


def q_ingest_stats(spark, sf):
    s = _scan(spark, sf).withColumn("batch_id", F.substring("timestamp", 1, 13))
    return ingest.ingest_stats(s)


def q_append_roundtrip(spark, sf):
    """Two appends and an empty one; points that are appended again stay twice."""
    t = adapters.telemetry_from_events(_t(spark, sf, "events"))
    path = run_dir(spark, "append")
    signup = F.col("metric_name") == "signup"
    append_telemetry(t.where(F.col("metric_name") != "error"), path)
    append_telemetry(t.where(signup | (F.col("metric_name") == "error")), path)
    append_telemetry(t.where(F.lit(False)), path)
    # the partition value is rendered as ISO text so both engines compare alike
    return read_telemetry(spark, path).select(
        "gpu_uuid", "metric_name", "value", "timestamp", "batch_id", "labels_raw", "seq",
        F.col("event_date").cast("string").alias("event_date"),
    )


# ---------------------------------------------------------------- projections


def q_to_telemetry(spark, sf):
    return ingest.to_telemetry(good_rows(_scan(spark, sf)), BATCH_TS)


def q_to_devices(spark, sf):
    return ingest.to_devices(good_rows(_scan(spark, sf)))


def q_stamp_batch(spark, sf):
    stamped = ingest.stamp_batch(good_rows(_scan(spark, sf)), BATCH_TS)
    return stamped.groupBy("batch_id", "timestamp").agg(F.count(F.lit(1)).alias("n"))


def q_encode_messages(spark, sf):
    m = messages_table(spark, sf)
    return m.select(
        "id", "topic", "payload", "metadata", "timestamp",
        F.col("headers")["instance_id"].alias("header_instance_id"),
        F.col("headers")["gpu_uuid"].alias("header_gpu_uuid"),
        F.col("headers")["metric_name"].alias("header_metric_name"),
        F.col("headers")["batch_id"].alias("header_batch_id"),
    )


def q_message_ids(spark, sf):
    """Random ids (uuid v4) for every encoded row: all present, all distinct."""
    recs = good_rows(_scan(spark, sf))
    m = messages.encode_messages(recs, batch_ts=F.lit(BATCH_TS).cast("timestamp_ntz"), batch_id=F.lit("b"))
    v4 = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return m.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("id").alias("n_distinct"),
        F.count_if(F.col("id").rlike(v4)).alias("n_uuid_v4"),
    )


def q_message_headers(spark, sf):
    m = messages_table(spark, sf)
    return m.select("id", F.explode("headers").alias("header_key", "header_value"))


def q_metadata_get(spark, sf):
    """Found and absent keys of the metadata text and of the headers."""
    m = messages_table(spark, sf)
    got = {k: scalars.metadata_get("metadata", k) for k in ("device", "gpu_index", "x", "rack")}
    heads = {k: scalars.header_get("headers", k) for k in ("instance_id", "trace")}
    return m.select("id", *[c[f].alias(f"{k}_{f}") for k, c in {**got, **heads}.items() for f in ("found", "value")])


def q_decode_messages(spark, sf):
    return _decoded(spark, sf).select(
        "id", "gpu_uuid", "metric_name", "value", "timestamp", "batch_id", "labels_raw", "reject_reason"
    )


def q_validate_telemetry(spark, sf):
    d = _decoded(spark, sf)
    return d.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n")
    )


def q_message_devices(spark, sf):
    return messages.message_devices(_decoded(spark, sf))


def q_collector_stats(spark, sf):
    return messages.collector_stats(_decoded(spark, sf))


# ---------------------------------------------------------------- registry


def q_list_devices(spark, sf):
    return registry.list_devices(_devices(spark, sf))


def q_devices_with_telemetry(spark, sf):
    return registry.devices_with_telemetry(_devices(spark, sf), telemetry_table(spark, sf))


def q_get_device(spark, sf):
    return registry.get_device(_devices(spark, sf), _uuid(POINT_DEVICE_ID))


def q_unknown_devices(spark, sf):
    req = adapters.history_requests_from_customers(_t(spark, sf, "customer"))
    valid = req.where(scalars.uuid_is_valid("uuid"))
    return registry.unknown_devices(valid, _devices(spark, sf))


def q_device_upsert(spark, sf):
    recs = adapters.csv_records_from_events(_t(spark, sf, "events"), _t(spark, sf, "customer"), _t(spark, sf, "nation"))
    recs = recs.withColumn("pod", F.concat(F.lit("pod-"), F.col("metric_name")))
    updates = ingest.to_devices(recs, keep=["seq"])
    base = run_dir(spark, "registry")
    write_registry(_devices(spark, sf), base)
    upsert_registry(spark, updates, base, "seq")
    return read_registry(spark, base)


def q_counts(spark, sf):
    return registry.counts(telemetry_table(spark, sf), _devices(spark, sf))


def q_device_key(spark, sf):
    return registry.device_keys(_devices(spark, sf))


# ---------------------------------------------------------------- history


def _uuid(i: int) -> str:
    return f"GPU-{i:08x}-0000-0000-0000-{i:012x}"


def q_device_history(spark, sf):
    return history.device_history(
        telemetry_table(spark, sf), _uuid(POINT_DEVICE_ID), HISTORY_START, HISTORY_END, HISTORY_LIMIT
    )


def q_uuid_check(spark, sf):
    req = adapters.history_requests_from_customers(_t(spark, sf, "customer"))
    return req.select("request_id", "uuid", scalars.uuid_is_valid("uuid").alias("uuid_valid"))


def q_validate_requests(spark, sf):
    req = adapters.history_requests_from_customers(_t(spark, sf, "customer"))
    return history.validate_requests(req)


def q_bulk_history_status(spark, sf):
    return _statuses(spark, sf).select("request_id", "uuid", "status")


def q_bulk_history(spark, sf):
    return history.bulk_history(_statuses(spark, sf), telemetry_table(spark, sf))


def q_history_total(spark, sf):
    return history.history_totals(_statuses(spark, sf), telemetry_table(spark, sf))


def q_device_documents(spark, sf):
    return render.device_documents(registry.list_devices(_devices(spark, sf)))


def q_history_documents(spark, sf):
    rows = history.bulk_history(_statuses(spark, sf), telemetry_table(spark, sf))
    return render.point_documents(rows, keep=["request_id"])


def q_history_envelopes(spark, sf):
    st = materialize(_statuses(spark, sf))
    return render.history_envelopes(history.history_totals(st, telemetry_table(spark, sf)), st)


def q_dedup_telemetry(spark, sf):
    return dedup.dedup_telemetry(telemetry_table(spark, sf)).select(
        "gpu_uuid", "metric_name", "value", "timestamp", "batch_id", "seq", "point_key"
    )


# ---------------------------------------------------------------- routing / delivery


def q_route_messages(spark, sf):
    return routing.route_messages(*_routing(spark, sf)).select("id", "topic", "subscriber_id", "handler_error")


def q_unrouted_messages(spark, sf):
    msgs, subs, _ = _routing(spark, sf)
    return routing.unrouted_messages(msgs, subs).select("id", "topic")


def q_routing_stats(spark, sf):
    return routing.routing_stats(*_routing(spark, sf))


def q_ack_match(spark, sf):
    return delivery.match_acks(_log(spark, sf)).select(
        *delivery.KEY, "op", "ts", "seq", "lease_seq", "matched"
    )


def q_ack_unmatched(spark, sf):
    m = delivery.match_acks(_log(spark, sf))
    return m.where(~F.col("matched")).select(*delivery.KEY, "op", "ts", "seq")


def q_delivery_state(spark, sf):
    return delivery.delivery_state(_log(spark, sf))


def q_dead_letters(spark, sf):
    return delivery.dead_letters(delivery.delivery_state(_log(spark, sf)))


def q_expired_leases(spark, sf):
    return delivery.expired_leases(delivery.delivery_state(_log(spark, sf)))


def q_queue_stats(spark, sf):
    log = _log(spark, sf)
    return delivery.queue_stats(delivery.delivery_state(log), log)


def q_topic_depth(spark, sf):
    return delivery.topic_depth(delivery.delivery_state(_log(spark, sf)))


# ---------------------------------------------------------------- scalars


def q_point_key(spark, sf):
    t = telemetry_table(spark, sf)
    b = F.when(F.col("metric_name") == "click", F.lit("")).otherwise(F.col("batch_id"))
    return t.select("seq", scalars.point_key("gpu_uuid", "metric_name", b, "timestamp").alias("point_key"))


def q_rfc3339(spark, sf):
    req = adapters.history_requests_from_customers(_t(spark, sf, "customer"))
    start = F.col("start_time")
    plain = (F.length(start) == 20) & F.endswith(start, F.lit("Z"))

    def far(zone: str):
        """The start time with a long fraction and another offset."""
        return F.when(plain, timeutil.parse_rfc3339(F.concat(F.rtrim(start, F.lit("Z")), F.lit(f".1234567890123{zone}"))))

    return req.select(
        "request_id",
        "start_time",
        timeutil.parse_rfc3339("start_time").alias("start_ts"),
        timeutil.is_rfc3339("start_time").alias("start_valid"),
        "end_time",
        timeutil.parse_rfc3339("end_time").alias("end_ts"),
        far("+19:00").alias("east_ts"),
        far("-23:59").alias("west_ts"),
        far("+24:00").alias("beyond_ts"),
    )


def q_rfc3339_format(spark, sf):
    t = telemetry_table(spark, sf)
    return t.select(
        "seq",
        timeutil.format_rfc3339("timestamp").alias("ts_rfc3339"),
        timeutil.format_rfc3339_nano("timestamp").alias("ts_rfc3339_nano"),
    )


def q_day_bounds(spark, sf):
    t = telemetry_table(spark, sf)
    return t.select(
        "seq",
        timeutil.start_of_day("timestamp").alias("day_start"),
        timeutil.end_of_day("timestamp").alias("day_end"),
    )


def q_durations(spark, sf):
    log = _log(spark, sf)
    return log.select(
        "seq",
        timeutil.add_seconds("ts", 300).alias("lease_expires"),
        timeutil.add_seconds("ts", -300).alias("lease_opened_before"),
        timeutil.seconds_between("ts", timeutil.end_of_day("ts")).alias("secs_to_day_end"),
    )


def q_clamp_prefetch(spark, sf):
    e = _t(spark, sf, "events")
    requested = (F.col("value") * 10).cast("int") - 100
    return e.select(
        F.col("event_id").alias("seq"),
        requested.alias("requested"),
        scalars.clamp(requested).alias("prefetch"),
    )


def q_labels_map(spark, sf):
    """Several labels, a comma and an escaped quote within values, a repeated key; as pairs of the map."""
    t = telemetry_table(spark, sf)
    raw = F.concat(F.col("labels_raw"), F.lit(',metric="'), F.col("metric_name"), F.lit(', \\"raw\\"",k="'),
                   F.col("batch_id"), F.lit('"'))
    raw = F.when(F.col("metric_name") == "view", F.lit("")).otherwise(raw)
    return t.select("seq", F.explode_outer(scalars.labels_map(raw)).alias("label_key", "label_value"))


def q_numeric_value(spark, sf):
    t = telemetry_table(spark, sf)
    return t.select("seq", "value", scalars.numeric_value("value").alias("value_num"))


def q_metric_catalogue(spark, sf):
    t = telemetry_table(spark, sf)
    # the event types as catalogued metrics; one type keeps a name that the catalogue lacks
    name = F.col("metric_name")
    for kind, metric in CATALOGUE_NAMES.items():
        name = F.when(F.col("metric_name") == kind, F.lit(metric)).otherwise(name)
    per_metric = t.groupBy(name.alias("metric_name")).agg(F.count(F.lit(1)).alias("n"))
    rows = ", ".join(f"('{m}', '{u}', '{f}')" for m, u, f in METRIC_CATALOGUE)
    cat = spark.sql(f"SELECT * FROM VALUES {rows} AS catalogue(metric_name, unit, family)")
    return per_metric.join(cat, "metric_name", "left").select(
        "metric_name",
        F.coalesce("unit", F.lit("")).alias("unit"),
        F.coalesce("family", F.lit("unknown")).alias("family"),
        "n",
    )


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
