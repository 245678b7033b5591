"""Streams equal their batch twins; a restarted collector writes no duplicates."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from telemetry_engine.operators.messages import decode_messages, telemetry_of
from telemetry_engine.sources.messages_io import write_messages
from telemetry_engine.operators import delivery
from telemetry_engine.operators.dedup import dedup_telemetry
from telemetry_engine.streaming.dedup import dedup_stream
from telemetry_engine.streaming.epochs import ROCKSDB, committed, read_epochs, state_on_disk
from telemetry_engine.streaming.leases import expired_leases, lease_updates
from telemetry_engine.streaming.pipeline import (
    ObservedMetricsReporter, read_collected_registry, start_collector, start_ingest, stream_totals,
)

MSG = "id string, topic string, payload string, headers map<string,string>, timestamp timestamp_ntz, metadata string, seq long"
T0 = datetime(2025, 1, 18, 12, 0, 0)


def _messages(spark, n, start=0):
    rows = []
    for i in range(start, start + n):
        p = {"gpu_uuid": f"GPU-{i % 3}", "metric_name": "temp", "value": str(i),
             "timestamp": "2025-01-18T12:00:00Z", "batch_id": "b1"}
        rows.append((str(i), "telemetry", json.dumps(p), {}, T0, json.dumps({"hostname": f"h{i}"}), i))
    rows.append((f"bad{start}", "telemetry", "{oops", {}, T0, None, 10_000 + start))
    return spark.createDataFrame(rows, MSG)


def test_collector_stream_equals_batch_and_restart_is_idempotent(spark, tmp):
    src = f"{tmp}/queue"
    write_messages(_messages(spark, 20), f"{src}/a", mode="overwrite")
    out = f"{tmp}/collector"
    q = start_collector(spark, f"{src}/*", out, extra_schema="seq bigint")
    q.awaitTermination()
    counters = ["processed", "errors", "gpus_stored", "telemetry_stored"]
    assert tuple(stream_totals(spark, out, counters).first()) == (21, 1, 20, 20)
    # restart on the same checkpoint with no new input: nothing is written twice
    start_collector(spark, f"{src}/*", out, extra_schema="seq bigint").awaitTermination()
    # new input arrives: only it is processed
    write_messages(_messages(spark, 5, start=100), f"{src}/b", mode="overwrite")
    start_collector(spark, f"{src}/*", out, extra_schema="seq bigint").awaitTermination()
    got = read_epochs(spark, f"{out}/telemetry")
    assert got.count() == 25 and got.select("seq").distinct().count() == 25
    batch = telemetry_of(decode_messages(_messages(spark, 20).unionByName(_messages(spark, 5, start=100))))
    assert sorted(r.seq for r in got.collect()) == sorted(r.seq for r in batch.collect())
    reg = {r.uuid: r.hostname for r in read_collected_registry(spark, out).collect()}
    assert reg == {"GPU-0": "h102", "GPU-1": "h103", "GPU-2": "h104"}


def test_ingest_stream_one_stamp_per_pass(spark, tmp):
    header = "timestamp,metric_name,gpu_id,device,uuid,modelName,Hostname,value"
    lines = [header] + [f"t,temp,0,nvidia0,GPU-{i},H100,h,{i}" for i in range(6)] + ["t,temp,0,nvidia0,,H100,h,1"]
    import os

    os.makedirs(f"{tmp}/csv")
    with open(f"{tmp}/csv/a.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    out = f"{tmp}/ingest"
    start_ingest(spark, f"{tmp}/csv", out).awaitTermination()
    msgs = spark.read.json(f"{out}/messages/epoch=*")
    assert msgs.count() == 6
    assert msgs.select(F.get_json_object("payload", "$.batch_id")).distinct().count() == 1
    stats = read_epochs(spark, f"{out}/stats").first()
    assert (stats.rows_total, stats.rows_sent, stats.rows_rejected) == (7, 6, 1)


def test_dedup_stream_drops_redeliveries(spark, tmp):
    ddl = "gpu_uuid string, metric_name string, value string, timestamp timestamp_ntz, batch_id string, labels_raw string, seq long"
    rows = [("g", "m", "1", T0, "b1", "", 1), ("g", "m", "1", T0, "b1", "", 2), ("g", "m", "2", T0, "b2", "", 3)]
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp}/t")
    src = spark.readStream.schema(ddl).parquet(f"{tmp}/t")
    q = (dedup_stream(src).writeStream.format("memory").queryName("dedup_test")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.batch_id for r in spark.table("dedup_test").collect()) == ["b1", "b2"]


LOG = "topic string, consumer_group string, consumer_id string, message_id string, op string, ts timestamp_ntz, seq long"


def _drain(spark, rows, tmp, name):
    with state_on_disk(spark):
        q = (rows.writeStream.format("parquet").option("path", f"{tmp}/{name}").option("checkpointLocation", f"{tmp}/{name}_ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(f"{tmp}/{name}")


def _expired(spark, tmp, as_of=None):
    src = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/log/*")
    return expired_leases(_drain(spark, lease_updates(src), tmp, "out"), as_of)


def test_lease_expiry_stream(spark, tmp):
    ev = [("m1", "fetch", 0), ("m1", "ack", 10),            # closed: no expiry
          ("m2", "fetch", 0), ("m2", "fetch", 400), ("m2", "fetch", 800),   # 3 expiries, last dead
          ("m3", "fetch", 1500), ("m4", "ack", 1600)]        # m3 still open at the end
    rows = [("q", "g", "c", m, op, T0 + timedelta(seconds=s), i) for i, (m, op, s) in enumerate(ev)]
    spark.createDataFrame(rows, LOG).write.parquet(f"{tmp}/log/a")
    got = _expired(spark, tmp)
    assert sorted((r.message_id, r.deliveries, r.outcome) for r in got.collect()) == [
        ("m2", 1, "redeliver"), ("m2", 2, "redeliver"), ("m2", 3, "dead_letter")]


def test_events_that_come_late_still_count(spark, tmp):
    def write(part, ev):
        rows = [("q", "g", "c", m, op, T0 + timedelta(seconds=s), i) for m, op, s, i in ev]
        spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(f"{tmp}/log/{part}")

    day = 24 * 3600
    write("a", [("m1", "fetch", 0, 1), ("m2", "fetch", 9 * day, 3)])
    assert {r.message_id for r in _expired(spark, tmp).collect()} == {"m1"}
    write("b", [("m1", "ack", 10, 2)])                                      # nine days behind the rest
    assert _expired(spark, tmp).count() == 0
    write("c", [("m1", "fetch", 30 * day, 4), ("m1", "fetch", 31 * day, 5)])  # deliveries go on from 1
    got = sorted((r.message_id, r.deliveries, r.outcome) for r in _expired(spark, tmp).collect())
    assert got == [("m1", 2, "redeliver"), ("m2", 1, "redeliver")]
    write("d", [("m1", "fetch", 15 * day, 6)])                              # a late fetch renumbers those after it
    got = sorted((r.message_id, r.deliveries, r.outcome) for r in _expired(spark, tmp).collect())
    assert got == [("m1", 2, "redeliver"), ("m1", 3, "dead_letter"), ("m2", 1, "redeliver")]


def test_lease_stream_equals_batch_over_files_in_any_order(spark, tmp):
    import random

    rng = random.Random(4)
    rows = [("q", f"g{rng.randint(0, 1)}", "c", f"m{rng.randint(0, 15)}", rng.choice(["fetch", "fetch", "ack", "nack", "publish"]),
             T0 + timedelta(seconds=rng.randint(0, 20_000), microseconds=rng.choice([0, 1, 999_999])), k) for k in range(400)]
    log = spark.createDataFrame(rows, LOG)
    log.repartition(6, "seq").write.parquet(f"{tmp}/log/a")
    got = _expired(spark, tmp)
    now = max(r[5] for r in rows if r[4] != "publish")
    twin = delivery.lease_outcomes(log, now).where("ended is null").where(F.col("expires") <= F.lit(now).cast("timestamp_ntz"))
    cols = ["topic", "consumer_group", "message_id", "fetch_ts", "fetch_seq", "deliveries", "outcome"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, twin.select(*cols).collect()))


def test_dedup_stream_equals_batch_over_files_in_any_order(spark, tmp):
    ddl = "gpu_uuid string, metric_name string, value string, timestamp timestamp_ntz, batch_id string, labels_raw string, seq long"
    rows = [(f"g{k % 7}", "m", "1", T0 + timedelta(days=(k * 37) % 50), f"b{(k * 37) % 50}", "", k) for k in range(900)]
    points = spark.createDataFrame(rows, ddl)
    points.repartition(9, "seq").write.parquet(f"{tmp}/t")
    src = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/t")
    got = _drain(spark, dedup_stream(src).select("point_key"), tmp, "dedup")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, dedup_telemetry(points).select("point_key").collect()))


def test_state_on_disk_leaves_the_session_as_it_was(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with state_on_disk(spark):
        assert spark.conf.get(name) == ROCKSDB
    assert spark.conf.get(name) == before


def test_device_write_failure_does_not_block_telemetry_and_is_made_up_for(spark, tmp):
    import os

    src, out = f"{tmp}/queue", f"{tmp}/collector"
    write_messages(_messages(spark, 6), f"{src}/a", mode="overwrite")
    os.makedirs(out)
    with open(f"{out}/registry", "w") as f:  # a file where the directory should go
        f.write("blocked")
    q = start_collector(spark, f"{src}/*", out, extra_schema="seq bigint")
    q.awaitTermination()
    assert q.exception() is None
    counters = ["processed", "errors", "gpus_stored", "telemetry_stored"]
    assert tuple(stream_totals(spark, out, counters).first()) == (7, 7, 0, 6)
    assert read_epochs(spark, f"{out}/telemetry").count() == 6
    assert read_collected_registry(spark, out).count() == 0
    os.remove(f"{out}/registry")
    write_messages(_messages(spark, 1, start=50), f"{src}/b", mode="overwrite")  # GPU-2 only
    start_collector(spark, f"{src}/*", out, extra_schema="seq bigint").awaitTermination()
    reg = {r.uuid: r.hostname for r in read_collected_registry(spark, out).collect()}
    assert reg == {"GPU-0": "h3", "GPU-1": "h4", "GPU-2": "h50"}


def test_totals_outlive_the_progress_that_spark_keeps(spark, tmp):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        src, out = f"{tmp}/queue", f"{tmp}/collector"
        for k in range(6):
            write_messages(_messages(spark, 4, start=10 * k).coalesce(1), f"{src}/{k}", mode="overwrite")
        q = start_collector(spark, f"{src}/*", out, extra_schema="seq bigint", max_files=1)
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(committed(spark, out)) == 6 and len(q.recentProgress) <= 2
    assert tuple(stream_totals(spark, out, ["processed", "telemetry_stored"]).first()) == (30, 24)


def test_an_epoch_without_its_marker_is_not_read(spark, tmp):
    import os

    src, out = f"{tmp}/queue", f"{tmp}/collector"
    for k in range(2):
        write_messages(_messages(spark, 4, start=10 * k).coalesce(1), f"{src}/{k}", mode="overwrite")
    start_collector(spark, f"{src}/*", out, extra_schema="seq bigint", max_files=1).awaitTermination()
    assert read_epochs(spark, f"{out}/telemetry").count() == 8
    os.remove(f"{out}/_committed/{1:010d}")
    assert read_epochs(spark, f"{out}/telemetry").count() == 4


def test_the_reporter_reports_and_leaves_with_its_query(spark, tmp, monkeypatch):
    made = []
    init = ObservedMetricsReporter.__init__
    monkeypatch.setattr(ObservedMetricsReporter, "__init__", lambda self, *a, **k: (init(self, *a, **k), made.append(self))[0])
    write_messages(_messages(spark, 3), f"{tmp}/queue/a", mode="overwrite")
    start_collector(spark, f"{tmp}/queue/*", f"{tmp}/collector", extra_schema="seq bigint", report_seconds=0).awaitTermination()
    import time

    for _ in range(50):  # listener events come on their own thread
        if made and made[0].reports:
            break
        time.sleep(0.1)
    assert len(made) == 1 and made[0].reports >= 1 and made[0].seconds == 0


def test_ingest_binds_each_file_by_its_header(spark, tmp):
    import os

    os.makedirs(f"{tmp}/csv")
    files = {"a": "timestamp,metric_name,gpu_id,device,uuid,modelName,Hostname,value\nt,util,0,n0,uuid-A,X,h,1\n",
             "b": "timestamp,uuid,gpu_id,device,metric_name,modelName,Hostname,value\nt,uuid-B,0,n0,util,\"X, 2\",h, 2\nt,,0,n0,util,X,h,3\n",
             "c": "timestamp,uuid\nt,uuid-C\n", "d": "\n \n"}
    for name, text in files.items():
        with open(f"{tmp}/csv/{name}.csv", "w") as f:
            f.write(text)
    out = f"{tmp}/ingest"
    start_ingest(spark, f"{tmp}/csv", out).awaitTermination()
    payloads = [json.loads(r.payload) for r in spark.read.json(f"{out}/messages/epoch=*").collect()]
    assert sorted((p["gpu_uuid"], p["metric_name"], p["value"]) for p in payloads) == [("uuid-A", "util", "1"), ("uuid-B", "util", "2")]
    s = stream_totals(spark, out, ["rows_total", "rows_sent", "rows_rejected", "files_rejected"]).first()
    assert tuple(s) == (3, 2, 1, 2)
    assert sorted((r.source_file.rsplit("/", 1)[-1], r.reject_reason) for r in read_epochs(spark, f"{out}/rejected_files").collect()) == [
        ("c.csv", "header lacks metric_name"), ("d.csv", "no header line")]


def test_collector_keeps_running_on_a_processing_time_trigger(spark, tmp):
    src = f"{tmp}/queue"
    write_messages(_messages(spark, 4), f"{src}/a", mode="overwrite")
    out = f"{tmp}/collector"
    q = start_collector(spark, f"{src}/*", out, extra_schema="seq bigint", processing_time="1 second")
    try:
        q.processAllAvailable()
        write_messages(_messages(spark, 3, start=50), f"{src}/b", mode="overwrite")
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert read_epochs(spark, f"{out}/telemetry").count() == 7
    assert read_epochs(spark, f"{out}/quarantine").select("headers").count() == 2
