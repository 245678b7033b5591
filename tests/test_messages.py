"""Message encode/decode, validation, device extraction, collector counters."""

from datetime import datetime

from pyspark.sql import functions as F

from telemetry_engine.operators import messages as M

MSG_DDL = "id string, topic string, payload string, headers map<string,string>, timestamp timestamp_ntz, metadata string"


def _msgs(spark, rows):
    return spark.createDataFrame(rows, MSG_DDL)


def _payload(uuid="GPU-1", metric="temp", value="75", ts="2025-01-18T10:00:00Z", batch="b1"):
    import json

    d = {"gpu_uuid": uuid, "metric_name": metric, "value": value, "timestamp": ts}
    if batch:
        d["batch_id"] = batch
    return json.dumps(d)


def test_validation_order_and_empty_value_accepted(spark):
    ts = datetime(2025, 1, 18)
    rows = [
        ("1", "t", _payload(uuid=""), {}, ts, None),
        ("2", "t", _payload(metric=""), {}, ts, None),
        ("3", "t", _payload(ts="0001-01-01T00:00:00Z"), {}, ts, None),
        ("4", "t", _payload(value=""), {}, ts, None),
        ("5", "t", '{"gpu_uuid": "GPU-1", "metric_name": "temp", "value": "1"}', {}, ts, None),
    ]
    out = {r.id: r.reject_reason for r in M.decode_messages(_msgs(spark, rows)).collect()}
    assert out == {"1": "missing_uuid", "2": "missing_metric", "3": "missing_timestamp", "4": None,
                   "5": "missing_timestamp"}


def test_bad_json_and_wrong_types_are_undecodable(spark):
    ts = datetime(2025, 1, 18)
    rows = [
        ("1", "t", "{not json", {}, ts, None),
        ("2", "t", '{"gpu_uuid": "GPU-1", "metric_name": "temp", "value": 75, "timestamp": "2025-01-18T10:00:00Z"}', {}, ts, None),
        ("3", "t", '{"gpu_uuid": "GPU-1", "metric_name": "temp", "value": "7", "timestamp": "yesterday"}', {}, ts, None),
    ]
    d = M.decode_messages(_msgs(spark, rows))
    assert {r.id: r.reject_reason for r in d.collect()} == {"1": "bad_json", "2": "bad_json", "3": "bad_json"}
    s = M.collector_stats(d).first()
    assert (s.processed, s.errors, s.telemetry_stored) == (3, 3, 0)


def test_metadata_types_and_missing_metadata(spark):
    ts = datetime(2025, 1, 18)
    rows = [
        ("1", "t", _payload(uuid="GPU-A"), {}, ts, '{"gpu_index": 0, "hostname": "h1", "device": "nvidia0"}'),
        ("2", "t", _payload(uuid="GPU-B"), {}, ts, None),
    ]
    devs = {r.uuid: r for r in M.message_devices(M.decode_messages(_msgs(spark, rows))).collect()}
    assert devs["GPU-A"].gpu_index == "" and devs["GPU-A"].hostname == "h1" and devs["GPU-A"].device_id == "nvidia0"
    assert all(getattr(devs["GPU-B"], c) == "" for c in ["device_id", "gpu_index", "hostname", "namespace"])


def test_encode_round_trip_omits_empty_optional_fields(spark):
    recs = spark.createDataFrame(
        [("GPU-1", "temp", "75", "", "0", "nvidia0", "H100", "host", "", "", "")],
        "uuid string, metric_name string, value string, labels_raw string, gpu_id string, device string, "
        "modelName string, Hostname string, container string, pod string, namespace string",
    )
    ts = F.lit(datetime(2025, 1, 18, 10, 0, 0, 500000)).cast("timestamp_ntz")
    m = M.encode_messages(recs, batch_ts=ts, batch_id=F.lit("b-1"), instance_id=F.lit("s0"), message_id=F.lit("m1"))
    row = m.first()
    assert "labels_raw" not in row.payload and '"batch_id":"b-1"' in row.payload
    assert '"timestamp":"2025-01-18T10:00:00.5Z"' in row.payload
    assert row.metadata.startswith('{"container":"","device":"nvidia0","gpu_index":"0"')
    assert row.headers["batch_id"] == "b-1" and row.headers["gpu_uuid"] == "GPU-1"
    d = M.decode_messages(m).first()
    assert (d.gpu_uuid, d.value, d.reject_reason) == ("GPU-1", "75", None)
    assert d.timestamp == datetime(2025, 1, 18, 10, 0, 0, 500000)


def test_payload_keys_without_regard_to_case(spark):
    from telemetry_engine.operators.messages import decode_messages

    rest = '"metric_name":"m","timestamp":"2024-01-01T00:00:00Z"}'
    payloads = {
        "capitals": '{"GPU_UUID":"a",' + rest,
        "last of any case": '{"gpu_uuid":"a","Gpu_Uuid":"b",' + rest,
        "null changes nothing": '{"gpu_uuid":"a","GPU_UUID":null,' + rest,
        "wrong type in another case": '{"gpu_uuid":"a","VALUE":1,' + rest,
        "deeper keys have no say": '{"gpu_uuid":"a","x":{"VALUE":1},' + rest,
        "no field": '{"gpu uuid":"a",' + rest,
    }
    rows = spark.createDataFrame(list(payloads.items()), "id string, payload string").selectExpr(
        "id", "'t' AS topic", "payload", "timestamp_ntz '2024-01-01 00:00:00' AS timestamp", "'{}' AS metadata")
    got = {r.id: (r.gpu_uuid, r.reject_reason) for r in decode_messages(rows).collect()}
    assert got == {"capitals": ("a", None), "last of any case": ("b", None), "null changes nothing": ("a", None),
                   "wrong type in another case": (None, "bad_json"), "deeper keys have no say": ("a", None),
                   "no field": ("", "missing_uuid")}


def test_message_files_are_compressed_and_bounded(spark, tmp, monkeypatch):
    import os
    from datetime import datetime

    from telemetry_engine.sources import messages_io as io

    monkeypatch.setattr(io, "MAX_MESSAGES_PER_FILE", 300)
    rows = [(str(i), "t", '{"gpu_uuid":"GPU-%d","labels_raw":"k=\\"ü\\n\\""}' % i, {"gpu_uuid": f"GPU-{i}"},
             datetime(2024, 1, 1, 0, 0, 0, i), None, i) for i in range(1000)]
    sent = spark.createDataFrame(rows, "id string, topic string, payload string, headers map<string,string>, "
                                       "timestamp timestamp_ntz, metadata string, seq long")
    io.write_messages(sent.coalesce(1), f"{tmp}/m", mode="overwrite")
    files = [f"{tmp}/m/{n}" for n in os.listdir(f"{tmp}/m") if n.startswith("part-")]
    assert len(files) == 4  # one task reads a file
    assert sum(map(os.path.getsize, files)) < sum(len(r[2]) for r in rows)
    back = io.read_messages(spark, f"{tmp}/m", "seq long")
    assert sorted(map(tuple, back.select(sent.columns).collect()), key=lambda r: r[6]) == rows
