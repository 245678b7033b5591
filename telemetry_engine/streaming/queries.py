"""Registered streaming queries.

Each runs its stream with ``availableNow`` (drain, then stop) into a fresh
folder under the shared directory and returns a batch DataFrame over what
the stream wrote, so the result can be compared with its SQL twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry_engine.operators import delivery
from telemetry_engine.operators.messages import decode_messages
from telemetry_engine.plans import catalog
from telemetry_engine.plans.oracle import ACK, CSV, DEC, LOG, MSG, ORACLE, REC, TEL, K, _open, _w
from telemetry_engine.schemas import DELIVERY_EVENT_SCHEMA, DEVICE_COLUMNS, PREFETCH_MAX, TELEMETRY_SCHEMA
from telemetry_engine.sources.messages_io import read_messages, stream_messages
from telemetry_engine.streaming.dedup import dedup_stream
from telemetry_engine.streaming.depths import queue_depths, start_depths
from telemetry_engine.streaming.epochs import epoch_paths, read_epochs, state_on_disk
from telemetry_engine.streaming.fetch import fetch_stream, fetched
from telemetry_engine.streaming.handlers import handler_log, process_stream
from telemetry_engine.streaming.leases import expired_leases, lease_updates
from telemetry_engine.streaming.redeliveries import outstanding, redelivery_changes
from telemetry_engine.streaming.pipeline import (
    read_collected_registry, start_collector, start_ingest, stream_totals,
)

COUNTERS = ["processed", "errors", "gpus_stored", "telemetry_stored"]
FILES_PER_BATCH = 3  # several micro-batches, whose events are out of order


def _run_ingest(spark: SparkSession, sf: str) -> str:
    out = catalog.run_dir(spark, "ingest")
    start_ingest(spark, catalog.metrics_csv_dir(spark, sf), out).awaitTermination()
    return out


def _run_collector(spark: SparkSession, sf: str) -> str:
    out = catalog.run_dir(spark, "collector")
    start_collector(spark, catalog.messages_dir(spark, sf), out, extra_schema="seq bigint").awaitTermination()
    return out


def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    out = _run_ingest(spark, sf)
    m = decode_messages(read_messages(spark, epoch_paths(spark, f"{out}/messages")))
    return m.select("gpu_uuid", "metric_name", "value", "labels_raw", "reject_reason")


def q_stream_ingest_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stream_totals(spark, _run_ingest(spark, sf), ["rows_total", "rows_sent", "rows_rejected", "files_rejected"])


def q_collector_stream(spark: SparkSession, sf: str) -> DataFrame:
    t = read_epochs(spark, f"{_run_collector(spark, sf)}/telemetry")
    return t.select("gpu_uuid", "metric_name", "value", "timestamp", "batch_id", "labels_raw", "seq")


def q_collector_registry(spark: SparkSession, sf: str) -> DataFrame:
    return read_collected_registry(spark, _run_collector(spark, sf))


def q_collector_registry_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The registry after an epoch a file, whose runs were merged on the way."""
    out = catalog.run_dir(spark, "collector")
    start_collector(spark, catalog.messages_dir(spark, sf), out, extra_schema="seq bigint", max_files=1,
                    runs_per_level=2).awaitTermination()
    return read_collected_registry(spark, out)


def q_collector_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The counters of every epoch that has input, with its number of telemetry rows found in the store."""
    out = _run_collector(spark, sf)
    stats = read_epochs(spark, f"{out}/stats").groupBy().agg(*[F.sum(c).alias(c) for c in COUNTERS])
    rows = read_epochs(spark, f"{out}/telemetry").agg(F.count(F.lit(1)).alias("telemetry_rows"))
    devices = read_collected_registry(spark, out).agg(F.count(F.lit(1)).alias("devices"))
    return stats.select(*COUNTERS, rows.scalar().alias("telemetry_rows"), devices.scalar().alias("devices"))


def q_stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    return stream_totals(spark, _run_collector(spark, sf), COUNTERS)


def payload_check(messages) -> None:
    """A handler: every payload of the batch must be JSON with a device."""
    import json

    for payload in messages["payload"]:
        if not {k.lower(): v for k, v in json.loads(payload).items()}.get("gpu_uuid"):
            raise LookupError("no device")


def q_handler_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Final state, acks and last error of every message after a handler that fails on some of them."""
    out = catalog.run_dir(spark, "handler")
    src = stream_messages(spark, catalog.messages_dir(spark, sf), extra_schema="seq bigint", max_files=FILES_PER_BATCH)
    process_stream(src, payload_check, out, consumer_group="checks").awaitTermination()
    log = handler_log(spark, out)
    acks = log.groupBy("topic", "consumer_group", "message_id").agg(
        F.count_if(F.col("op") == "ack").alias("acks"),
        F.max_by(F.substring_index("error", ":", 1), "seq").alias("error"))
    return delivery.delivery_state(log).join(acks, ["topic", "consumer_group", "message_id"]).select(
        "topic", "consumer_group", "message_id", "state", "acks", "error")


# group -> messages per fetch, the second beyond the greatest that is allowed
FETCH_GROUPS = {"collectors": 100, "audit": 9_999}


def q_fetch_batches(spark: SparkSession, sf: str) -> DataFrame:
    """How often each group fetched each message, and whether its batches kept to the group's size; started twice."""
    parts = []
    for group, size in FETCH_GROUPS.items():
        out = catalog.run_dir(spark, "fetch")
        for _ in range(2):  # the second start finds the group's position and no new message
            src = stream_messages(spark, catalog.messages_dir(spark, sf), extra_schema="seq bigint", max_files=FILES_PER_BATCH)
            fetch_stream(src, "telemetry", group, out, size, consumers=("consumer-0", "consumer-1")).awaitTermination()
        parts.append(fetched(spark, out).select(
            F.lit(group).alias("consumer_group"), "topic", F.col("id").alias("message_id"),
            (F.count(F.lit(1)).over(Window.partitionBy("batch_id")) <= min(size, PREFETCH_MAX)).alias("in_bounds")))
    return parts[0].unionByName(parts[1]).groupBy("consumer_group", "topic", "message_id").agg(
        F.count(F.lit(1)).alias("fetches"), F.bool_and("in_bounds").alias("in_bounds"))


def q_stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    src = (spark.readStream.schema(TELEMETRY_SCHEMA).option("maxFilesPerTrigger", FILES_PER_BATCH)
           .parquet(catalog.telemetry_arrivals_dir(spark, sf)))
    out = catalog.run_dir(spark, "dedup")
    rows = dedup_stream(src).select("point_key", "gpu_uuid", "metric_name", "batch_id")
    _drain(spark, rows, out)
    return spark.read.parquet(f"{out}/data")


def q_lease_expiry_stream(spark: SparkSession, sf: str) -> DataFrame:
    src = (spark.readStream.schema(DELIVERY_EVENT_SCHEMA).option("maxFilesPerTrigger", FILES_PER_BATCH)
           .parquet(catalog.delivery_log_dir(spark, sf)))
    out = catalog.run_dir(spark, "leases")
    _drain(spark, lease_updates(src), out)
    return expired_leases(spark.read.parquet(f"{out}/data"))


def q_lease_redeliveries_stream(spark: SparkSession, sf: str) -> DataFrame:
    """What the stream emitted as time passed, net of what it revoked."""
    src = (spark.readStream.schema(DELIVERY_EVENT_SCHEMA).option("maxFilesPerTrigger", FILES_PER_BATCH)
           .parquet(catalog.delivery_log_dir(spark, sf)))
    out = catalog.run_dir(spark, "redeliveries")
    _drain(spark, redelivery_changes(src), out)
    return outstanding(spark.read.parquet(f"{out}/data"))


def q_queue_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The counters kept up by the stream, after all files in any order."""
    src = (spark.readStream.schema(DELIVERY_EVENT_SCHEMA).option("maxFilesPerTrigger", FILES_PER_BATCH)
           .parquet(catalog.delivery_log_dir(spark, sf)))
    out = catalog.run_dir(spark, "depths")
    start_depths(src, out).awaitTermination()
    return queue_depths(spark, out)


def _drain(spark: SparkSession, rows: DataFrame, out: str) -> None:
    with state_on_disk(spark):
        query = (rows.writeStream.format("parquet").option("path", f"{out}/data")
                 .option("checkpointLocation", f"{out}/_checkpoint").outputMode("append")
                 .trigger(availableNow=True).start())
        query.awaitTermination()


STREAM_QUERIES = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

_DEV_FIELDS = [("device", "device_id"), ("gpu_index", "gpu_index"), ("model_name", "model_name"),
               ("hostname", "hostname"), ("container", "container"), ("pod", "pod"),
               ("namespace", "namespace")]

STREAM_ORACLE: dict[str, str] = {
    "stream_ingest": _w(REC, CSV) + """SELECT uuid AS gpu_uuid, metric_name, value, labels_raw,
        CAST(NULL AS VARCHAR) AS reject_reason FROM csv WHERE reject_reason IS NULL""",
    "stream_ingest_stats": _w(REC, CSV) + """SELECT count(*) AS rows_total,
        count(*) FILTER (WHERE reject_reason IS NULL) AS rows_sent,
        count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rows_rejected,
        CAST(1 AS BIGINT) AS files_rejected -- the file of blank lines
        FROM csv""",
    "collector_stream": _w(REC, MSG, DEC) + """SELECT gpu_uuid, metric_name, value, timestamp, batch_id,
        labels_raw, seq FROM decv WHERE reject_reason IS NULL""",
    "collector_registry": _w(REC, MSG, DEC) + """, d AS (SELECT gpu_uuid AS uuid, seq, """ + ", ".join(
        f"CASE WHEN json_type(metadata, '$.{k}') = 'VARCHAR' THEN json_extract_string(metadata, '$.{k}') ELSE '' END AS {o}"
        for k, o in _DEV_FIELDS) + """ FROM decv WHERE reject_reason IS NULL),
        r AS (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY seq DESC) AS rn FROM d)
        SELECT """ + ", ".join(DEVICE_COLUMNS) + " FROM r WHERE rn = 1",
    "handler_outcomes": _w(REC, MSG, DEC) + """SELECT 'telemetry' AS topic, 'checks' AS consumer_group, CAST(seq AS VARCHAR) AS message_id,
        CASE WHEN reject_reason IN ('bad_json', 'missing_uuid') THEN 'ready' ELSE 'acked' END AS state,
        CAST(CASE WHEN reject_reason IN ('bad_json', 'missing_uuid') THEN 0 ELSE 1 END AS BIGINT) AS acks,
        CASE reject_reason WHEN 'bad_json' THEN 'JSONDecodeError' WHEN 'missing_uuid' THEN 'LookupError' END AS error FROM decv""",
    "fetch_batches": _w(REC, MSG, DEC) + """SELECT consumer_group, 'telemetry' AS topic, CAST(seq AS VARCHAR) AS message_id,
        CAST(1 AS BIGINT) AS fetches, true AS in_bounds
        FROM decv, (VALUES ('collectors'), ('audit')) AS g(consumer_group)""",
    "stream_progress": _w(REC, MSG, DEC) + """SELECT count(*) AS processed,
        count(*) FILTER (WHERE reject_reason IS NOT NULL) AS errors,
        count(*) FILTER (WHERE reject_reason IS NULL) AS gpus_stored,
        count(*) FILTER (WHERE reject_reason IS NULL) AS telemetry_stored FROM decv""",
    "collector_stats_stream": _w(REC, MSG, DEC) + """SELECT count(*) AS processed,
        count(*) FILTER (WHERE reject_reason IS NOT NULL) AS errors,
        count(*) FILTER (WHERE reject_reason IS NULL) AS gpus_stored,
        count(*) FILTER (WHERE reject_reason IS NULL) AS telemetry_stored,
        count(*) FILTER (WHERE reject_reason IS NULL) AS telemetry_rows,
        count(DISTINCT gpu_uuid) FILTER (WHERE reject_reason IS NULL) AS devices FROM decv""",
    "stream_dedup": _w(TEL) + """SELECT DISTINCT gpu_uuid || ':' || metric_name || ':' || batch_id AS point_key,
        gpu_uuid, metric_name, batch_id FROM tel""",
    "lease_expiry_stream": _w(LOG, ACK) + f""", lf AS (
          SELECT {K}, ts, seq,
            row_number() OVER (PARTITION BY {K} ORDER BY ts, seq) AS deliveries,
            lead(ts) OVER (PARTITION BY {K} ORDER BY ts, seq) AS next_fetch_ts
          FROM log WHERE op = 'fetch'),
        closed AS (SELECT DISTINCT {K}, lease_seq FROM acks WHERE matched),
        wm AS (SELECT max(ts) AS wm_ts FROM log WHERE op IN ('fetch', 'ack', 'nack'))
        SELECT lf.topic, lf.consumer_group, lf.message_id, lf.ts AS fetch_ts, lf.seq AS fetch_seq,
               lf.deliveries, CASE WHEN lf.deliveries >= 3 THEN 'dead_letter' ELSE 'redeliver' END AS outcome
        FROM lf LEFT JOIN closed c
          ON c.topic = lf.topic AND c.consumer_group = lf.consumer_group
         AND c.message_id = lf.message_id AND c.lease_seq = lf.seq
        WHERE c.lease_seq IS NULL
          AND NOT (lf.next_fetch_ts IS NOT NULL AND {_open('lf.ts', 'lf.next_fetch_ts')})
          AND date_trunc('second', lf.ts + INTERVAL 300 SECOND) <= (SELECT wm_ts FROM wm)""",
}
# the same devices, merged from runs
STREAM_ORACLE["collector_registry_runs"] = STREAM_ORACLE["collector_registry"]
# the same leases, emitted by timers
STREAM_ORACLE["lease_redeliveries_stream"] = STREAM_ORACLE["lease_expiry_stream"]
# the same counters, kept up by changes
STREAM_ORACLE["queue_stats_stream"] = ORACLE["queue_stats"]
