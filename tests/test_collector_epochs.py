"""An epoch of one message file: decoded on all cores, each metadata of a device parsed once, nothing lost."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from telemetry_engine.sources.messages_io import write_messages
from telemetry_engine.streaming import pipeline
from telemetry_engine.streaming.epochs import read_epochs

MSG = "id string, topic string, payload string, headers map<string,string>, timestamp timestamp_ntz, metadata string, seq long"
T0 = datetime(2025, 1, 18, 12, 0, 0)


def _message(k, uuid, host, seq):
    p = {"gpu_uuid": uuid, "metric_name": "temp", "value": str(k), "timestamp": "2025-01-18T12:00:00Z"}
    return (str(k), "telemetry", json.dumps(p), {"n": str(k)}, T0, host and json.dumps({"hostname": host}), seq)


def _collect(spark, tmp, monkeypatch, rows, look, extra_schema="seq bigint"):
    """Run the collector over one file; ``look`` maps a step's name to what is noted of its input."""
    messages = spark.createDataFrame(rows, MSG).coalesce(1)
    write_messages(messages if extra_schema else messages.drop("seq"), f"{tmp}/queue/a", mode="overwrite")
    seen = {}
    for name, note in look.items():
        step = getattr(pipeline, name)
        monkeypatch.setattr(pipeline, name, lambda df, name=name, note=note, step=step: (seen.update({name: note(df)}), step(df))[1])
    pipeline.start_collector(spark, f"{tmp}/queue/*", f"{tmp}/out", extra_schema=extra_schema, max_files=1).awaitTermination()
    return seen


def _registry(spark, tmp):
    return sorted((r.uuid, r.hostname) for r in pipeline.read_collected_registry(spark, f"{tmp}/out").collect())


def test_an_epoch_of_one_file_is_dealt_to_all_cores(spark, tmp, monkeypatch):
    rows = [_message(k, f"GPU-{k % 3}", f"h{k}", k) for k in range(200)]
    parts = lambda df: [n for n in df.rdd.glom().map(len).collect() if n]
    seen = _collect(spark, tmp, monkeypatch, rows, {"telemetry_of": parts})
    assert len(seen["telemetry_of"]) == spark.sparkContext.defaultParallelism > 1
    assert sum(seen["telemetry_of"]) == 200 and max(seen["telemetry_of"]) < 100
    got = read_epochs(spark, f"{tmp}/out/telemetry")
    assert sorted((r.seq, r.value) for r in got.collect()) == [(k, str(k)) for k in range(200)]


def test_messages_that_are_alike_are_all_kept(spark, tmp, monkeypatch):
    rows = [_message(1, "GPU-1", "h", 1)] * 7 + [(None, None, None, None, None, None, None)] * 3
    _collect(spark, tmp, monkeypatch, rows, {})
    assert read_epochs(spark, f"{tmp}/out/telemetry").count() == 7
    assert read_epochs(spark, f"{tmp}/out/quarantine").count() == 3


def test_each_metadata_of_a_device_is_parsed_once(spark, tmp, monkeypatch):
    rows = [_message(k, f"GPU-{k % 3}", f"h{k % 2}", k) for k in range(60)]
    seen = _collect(spark, tmp, monkeypatch, rows, {"message_devices": lambda df: df.count()})
    assert seen["message_devices"] == 6  # three devices with two hosts each, not 60 messages
    assert _registry(spark, tmp) == [("GPU-0", "h1"), ("GPU-1", "h0"), ("GPU-2", "h1")]


def test_orders_that_are_null_tied_or_absent_have_the_same_winner(spark, tmp, monkeypatch):
    rows = [_message(0, "a", "z", None), _message(1, "a", "b", 0), _message(2, "a", "b", None),   # any order before none
            _message(3, "b", "x", 5), _message(4, "b", "y", 5), _message(5, "b", "w", 5),         # tied: by contents
            _message(6, "c", None, 9), _message(7, "c", "h", 8),                                  # blank overwrites
            _message(8, "d", "e", 3), _message(9, "d", "f", 4), _message(10, "d", "e", 5)]        # comes back
    _collect(spark, f"{tmp}/1", monkeypatch, rows, {})
    assert _registry(spark, f"{tmp}/1") == [("a", "b"), ("b", "y"), ("c", ""), ("d", "e")]
    _collect(spark, f"{tmp}/2", monkeypatch, rows, {}, extra_schema=None)
    assert _registry(spark, f"{tmp}/2") == [("a", "z"), ("b", "y"), ("c", "h"), ("d", "f")]


def test_only_rejected_messages_are_held_whole(spark, tmp, monkeypatch):
    bad = ("bad", "telemetry", "{oops", {"n": "bad"}, T0, "{}", 99)
    held = lambda df: [r.id for r in df.where("payload is not null or headers is not null").select("id").collect()]
    seen = _collect(spark, tmp, monkeypatch, [_message(k, "GPU-1", "h", k) for k in range(5)] + [bad], {"telemetry_of": held})
    assert seen["telemetry_of"] == ["bad"]
    q = read_epochs(spark, f"{tmp}/out/quarantine").select(
        "id", "topic", "payload", "headers", "message_timestamp", "metadata", "seq", F.col("reject_reason")).first()
    assert tuple(q) == ("bad", "telemetry", "{oops", {"n": "bad"}, T0, "{}", 99, "bad_json")
