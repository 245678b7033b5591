"""Scalar functions: keys, uuid format, time parsing/formatting, labels."""

from datetime import datetime

from pyspark.sql import functions as F

from telemetry_engine.functions import scalars as S
from telemetry_engine.functions import timeutil as T
from telemetry_engine.functions.pytime import format_rfc3339_nano_py, parse_rfc3339_py


def _one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_keys(spark):
    assert _one(spark, S.device_key(F.lit("host-001"), F.lit("nvidia0"))) == "host-001:nvidia0"
    ts = F.lit(datetime(2025, 1, 18, 12, 30, 45, 123456)).cast("timestamp_ntz")
    assert _one(spark, S.point_key(F.lit("gpu-123"), F.lit("temperature"), F.lit("batch-1"), ts)) == "gpu-123:temperature:batch-1"
    assert _one(spark, S.point_key(F.lit("gpu-123"), F.lit("temperature"), F.lit(""), ts)) == \
        "gpu-123:temperature:2025-01-18T12:30:45.123456Z"


def test_uuid_pattern(spark):
    ok = ["GPU-0000002a-0000-0000-0000-00000000002a", "0000002a-0000-0000-0000-00000000002a"]
    bad = ["GPU-0000beef", "gpu-0000002a-0000-0000-0000-00000000002a", "", "GPU-zz00002a-0000-0000-0000-00000000002a"]
    df = spark.createDataFrame([(u,) for u in ok + bad], "u string")
    got = [r.v for r in df.select(S.uuid_is_valid("u").alias("v")).collect()]
    assert got == [True] * 2 + [False] * 4


def test_rfc3339_parse_matches_driver_twin(spark):
    cases = ["2025-01-18T00:00:00Z", "2025-01-18T02:00:00+02:00", "2025-01-18T00:00:00.123456789Z",
             "2025-01-18T23:30:00-01:30", "2025-01-18", "2025-13-01T00:00:00Z", "2025-02-30T00:00:00Z",
             "invalid", "2025-01-18t00:00:00z"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r.t for r in df.select(T.parse_rfc3339("s").alias("t")).collect()]
    assert got == [parse_rfc3339_py(c) for c in cases]
    assert got[0] == got[1] == datetime(2025, 1, 18) and got[2].microsecond == 123456
    assert got[4:] == [None] * 5


def test_time_formats_and_bounds(spark):
    ts = F.lit(datetime(2025, 1, 18, 12, 30, 45, 120000)).cast("timestamp_ntz")
    assert _one(spark, T.format_rfc3339(ts)) == "2025-01-18T12:30:45Z"
    assert _one(spark, T.format_rfc3339_nano(ts)) == "2025-01-18T12:30:45.12Z" == format_rfc3339_nano_py(datetime(2025, 1, 18, 12, 30, 45, 120000))
    assert _one(spark, T.start_of_day(ts)) == datetime(2025, 1, 18)
    assert _one(spark, T.end_of_day(ts)) == datetime(2025, 1, 18, 23, 59, 59, 999999)
    assert _one(spark, T.add_seconds(ts, -45)) == datetime(2025, 1, 18, 12, 30, 0, 120000)
    assert _one(spark, T.seconds_between(ts, T.end_of_day(ts))) == 41354


def test_labels_numeric_clamp(spark):
    lab = F.lit('a="1,2",b="x\\"y",a="3"')
    assert {p.label_key: p.label_value for p in _one(spark, S.label_pairs(lab))} == {"a": "3", "b": 'x"y'}
    assert _one(spark, S.label_pairs(F.lit(""))) == []
    df = spark.createDataFrame([("98.5",), ("abc",), ("NaN",)], "v string")
    vals = [r.x for r in df.select(S.numeric_value("v").alias("x")).collect()]
    assert vals[0] == 98.5 and vals[1] is None and vals[2] != vals[2]
    assert [_one(spark, S.clamp(F.lit(v))) for v in (0, 500, 9999)] == [1, 500, 2500]
    assert _one(spark, S.parse_int(F.lit("+42"))) == 42 and _one(spark, S.parse_int(F.lit("4 2"))) is None


def test_rfc3339_wide_offsets_and_long_fractions(spark):
    from datetime import datetime

    from telemetry_engine.functions.pytime import parse_rfc3339_py
    from telemetry_engine.functions.timeutil import parse_rfc3339

    forms = {
        "2024-03-01T10:00:00+19:00": datetime(2024, 2, 29, 15),
        "2024-03-01T10:00:00-23:59": datetime(2024, 3, 2, 9, 59),
        "2024-03-01T10:00:00.1234567891234567Z": datetime(2024, 3, 1, 10, 0, 0, 123456),
        "2024-03-01T10:00:00.5+00:30": datetime(2024, 3, 1, 9, 30, 0, 500000),
        "2024-03-01T10:00:00+24:00": None, "2024-03-01T10:00:00+10:60": None, "2024-03-01T10:00:00.Z": None,
        "2024-02-30T10:00:00Z": None, "2024-03-01T24:00:00Z": None, "2024-03-01T10:00:00": None, "": None, "Z": None,
    }
    df = spark.createDataFrame([(k,) for k in forms], "s string")
    got = {r.s: r.t for r in df.select("s", parse_rfc3339("s").alias("t")).collect()}
    assert got == forms
    assert {k: parse_rfc3339_py(k) for k in forms} == forms


def test_label_pairs_look_for_the_labels_once(spark):
    rows = [('a="1",b="x, \\"y\\"",a="2"',), ("",), (None,), ("no labels",)]
    got = spark.createDataFrame(rows, "s string").select("s", S.label_pairs("s").alias("p"))
    assert {r.s: [tuple(p) for p in r.p] for r in got.collect()} == {
        rows[0][0]: [("b", 'x, "y"'), ("a", "2")], "": [], None: [], "no labels": []}
    # a search inside a lambda runs for every element of the array
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 2
