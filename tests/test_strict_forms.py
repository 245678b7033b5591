"""Whole-text patterns, field types of JSON, and times that no session zone moves."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telemetry_engine.functions import pytime, scalars, timeutil
from telemetry_engine.operators import history, messages

UUID = "GPU-0000002a-0000-0000-0000-00000000002a"


@pytest.mark.parametrize("tail", ["", "\n", " ", "\r", "\n\n"])
def test_columns_and_python_agree_on_ends(spark, tail):
    df = spark.createDataFrame([(UUID + tail, "2024-01-05T00:00:00Z" + tail, "5" + tail)], "u string, t string, n string")
    got = df.select(scalars.uuid_is_valid("u").alias("u"), timeutil.parse_rfc3339("t").alias("t"),
                    scalars.parse_int("n").alias("n")).first()
    ok = tail == ""
    assert (got["u"], got["t"] is not None, got["n"]) == (ok, ok, 5 if ok else None)
    assert (pytime.parse_rfc3339_py("2024-01-05T00:00:00Z" + tail) is not None) == ok
    for request in ((UUID + tail, "", "", ""), (UUID, "2024-01-05T00:00:00Z" + tail, "", ""), (UUID, "", "", "5" + tail)):
        row = spark.createDataFrame([(1, *request)], "request_id long, uuid string, start_time string, end_time string, limit string")
        status = history.validate_requests(row).first()["status"]
        try:
            history.validate_request(*request)
            assert status is None
        except history.HistoryRequestError as e:
            assert status == e.code


@pytest.fixture()
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_no_zone_moves_a_time(spark, new_york):
    gap, fall = "2024-03-10 02:30:15.5", "2024-11-03 01:30:00.000001"  # skipped and repeated hours there
    df = spark.sql(f"SELECT * FROM VALUES (TIMESTAMP_NTZ'{gap}'), (TIMESTAMP_NTZ'{fall}') AS t(ts)")
    got = df.select(
        timeutil.format_rfc3339("ts"), timeutil.format_rfc3339_nano("ts"), timeutil.format_hour("ts"),
        timeutil.format_micros("ts"), timeutil.whole_seconds("ts"), timeutil.start_of_day("ts"), timeutil.end_of_day("ts"),
        timeutil.add_seconds("ts", 3600), timeutil.seconds_between("ts", timeutil.end_of_day("ts")),
        timeutil.parse_rfc3339(timeutil.format_rfc3339_nano("ts"))).collect()
    assert tuple(got[0]) == (
        "2024-03-10T02:30:15Z", "2024-03-10T02:30:15.5Z", "2024-03-10T02:00:00Z", "2024-03-10 02:30:15.500000",
        datetime(2024, 3, 10, 2, 30, 15), datetime(2024, 3, 10), datetime(2024, 3, 10, 23, 59, 59, 999999),
        datetime(2024, 3, 10, 3, 30, 15, 500000), 77384, datetime(2024, 3, 10, 2, 30, 15, 500000))
    assert tuple(got[1])[1:5] == ("2024-11-03T01:30:00.000001Z", "2024-11-03T01:00:00Z", "2024-11-03 01:30:00.000001",
                                  datetime(2024, 11, 3, 1, 30))


def test_each_field_is_asked_for_its_own_type(spark):
    t = '"timestamp":"2024-01-01T00:00:00Z"'
    cases = [
        ('{"gpu_uuid":"u","metric_name":"m",%s,"extra":{"value":1,"gpu_uuid":[2]}}' % t, "u", None),
        ('{"gpu_uuid":"a","gpu_uuid":"b","metric_name":"m",%s}' % t, "b", None),
        ('{"gpu_uuid":5,"metric_name":"m",%s}' % t, None, "bad_json"),
        ('{"gpu_uuid":null,"metric_name":"m",%s}' % t, "", "missing_uuid"),
        ('[{"gpu_uuid":"u"}]', None, "bad_json"), ('{"gpu_uuid":"u",%s} x' % t, None, "bad_json"),
        ('{"gpu_uuid":"u",%s},{}' % t, None, "bad_json"), ("", None, "bad_json"), (None, None, "bad_json"),
    ]
    meta = '{"device":5,"x":{"device":"a"},"pod":"p","pod":"q","hostname":null}'
    df = spark.createDataFrame([(k, p, meta) for k, (p, *_) in enumerate(cases)], "seq long, payload string, metadata string")
    d = messages.decode_messages(df.withColumn("timestamp", F.lit(None).cast("timestamp_ntz")))
    got = {r["seq"]: (r["gpu_uuid"], r["reject_reason"]) for r in d.collect()}
    assert got == {k: (u, r) for k, (_, u, r) in enumerate(cases)}
    devices = messages.message_devices(d).collect()
    assert {(r["device_id"], r["pod"], r["hostname"]) for r in devices} == {("", "q", "")}
