"""API documents: empty optional fields are omitted, times are RFC 3339 UTC."""

import json
from datetime import datetime

from telemetry_engine.operators import render

DEV = "uuid string, device_id string, gpu_index string, model_name string, hostname string, container string, pod string, namespace string"


def test_device_document_omits_empty_optionals(spark):
    df = spark.createDataFrame([("u1", "nvidia0", "0", "H100", "h", "", "p1", ""),
                                ("u2", "nvidia1", "1", "A100", "h", "c", "", "ns")], DEV)
    docs = {r.uuid: json.loads(r.document) for r in render.device_documents(df).collect()}
    assert docs["u1"] == {"uuid": "u1", "device_id": "nvidia0", "gpu_index": "0", "model_name": "H100",
                          "hostname": "h", "pod": "p1"}
    assert "pod" not in docs["u2"] and docs["u2"]["container"] == "c" and docs["u2"]["namespace"] == "ns"
    assert list(docs["u2"])[:5] == ["uuid", "device_id", "gpu_index", "model_name", "hostname"]


def test_point_document_and_envelope(spark):
    rows = spark.createDataFrame([(1, "g", "temp", "75", datetime(2025, 1, 18, 12, 0, 0, 500000), "")],
                                 "request_id long, gpu_uuid string, metric_name string, value string, "
                                 "timestamp timestamp_ntz, labels_raw string")
    d = json.loads(render.point_documents(rows).first().document)
    assert d == {"gpu_uuid": "g", "metric_name": "temp", "value": "75", "timestamp": "2025-01-18T12:00:00.5Z"}
    totals = spark.createDataFrame([(1, "g", "ok", 3), (2, "x", "invalid_uuid", None)],
                                   "request_id long, uuid string, status string, total long")
    st = spark.createDataFrame([(1, "g", None, datetime(2025, 1, 19)), (2, "x", None, None)],
                               "request_id long, uuid string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    env = [json.loads(r.document) for r in render.history_envelopes(totals, st).collect()]
    assert env == [{"total": 3, "gpu_uuid": "g", "end_time": "2025-01-19T00:00:00Z"}]
