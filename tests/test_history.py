"""Device history: validation precedence, ordering, range, limits, bulk form."""

from datetime import datetime, timedelta

import pytest

from telemetry_engine.operators import history as H

U1 = "GPU-0000002a-0000-0000-0000-00000000002a"
U2 = "GPU-00000000-0000-0000-0000-000000000000"
T0 = datetime(2025, 1, 18, 12, 0, 0)
TEL_DDL = "gpu_uuid string, metric_name string, value string, timestamp timestamp_ntz, batch_id string, labels_raw string, seq long"
DEV_DDL = "uuid string, device_id string, gpu_index string, model_name string, hostname string, container string, pod string, namespace string"


@pytest.fixture()
def tel(spark):
    rows = [(U1, "temp", str(i), T0 + timedelta(minutes=i), "b", "", i) for i in range(10)]
    rows.append((U1, "util", "x", T0 + timedelta(minutes=9), "b", "", 100))  # tie on timestamp
    return spark.createDataFrame(rows, TEL_DDL)


@pytest.fixture()
def devs(spark):
    return spark.createDataFrame([(U1, "nvidia0", "0", "H100", "h", "", "", ""),
                                  ("GPU-99999999-9999-9999-9999-999999999999", "n", "1", "m", "h", "", "", "")], DEV_DDL)


@pytest.mark.parametrize("args,code", [
    (("",), "missing_uuid"),
    (("not-a-uuid",), "invalid_uuid"),
    ((U1, "invalid"), "invalid_start"),
    ((U1, "2025-01-18"), "invalid_start"),
    ((U1, "", "invalid"), "invalid_end"),
    ((U1, "2025-01-18T13:00:00Z", "2025-01-18T12:00:00Z"), "invalid_range"),
    ((U1, "", "", "abc"), "invalid_limit"),
    ((U1, "", "", "0"), "invalid_limit"),
    ((U1, "", "", "10001"), "invalid_limit"),
    (("bad", "invalid", "", "0"), "invalid_uuid"),
])
def test_validation_precedence(args, code):
    with pytest.raises(H.HistoryRequestError) as e:
        H.validate_request(*args)
    assert e.value.code == code


def test_valid_edges():
    assert H.validate_request(U1, "", "", "10000").limit == 10000
    assert H.validate_request(U1, "", "", "1").limit == 1
    f = H.validate_request(U1, "2025-01-18T12:00:00Z", "2025-01-18T12:00:00Z")
    assert f.start == f.end
    assert H.validate_request(U1, "2025-01-18T14:00:00+02:00").start == datetime(2025, 1, 18, 12, 0)
    assert H.validate_request(U1.removeprefix("GPU-")).limit is None


def test_newest_first_inclusive_range_and_limit(tel):
    df = H.device_history(tel, U1, "2025-01-18T12:02:00Z", "2025-01-18T12:09:00Z", 3)
    vals = [r.value for r in df.collect()]
    assert vals == ["x", "9", "8"]  # tie broken by arrival order, newest first
    allrows = H.device_history(tel, U1, "2025-01-18T12:02:00Z", "2025-01-18T12:09:00Z").collect()
    assert len(allrows) == 9  # both ends inclusive


def test_not_found_vs_empty(tel, devs):
    with pytest.raises(H.HistoryRequestError) as e:
        H.device_history(tel, U2, devices=devs)
    assert e.value.code == "not_found"
    assert H.device_history(tel, "GPU-99999999-9999-9999-9999-999999999999", devices=devs).count() == 0


def test_bulk_matches_point_queries(spark, tel, devs):
    reqs = spark.createDataFrame([
        (1, U1, "", "", "3"), (2, U1, "2025-01-18T12:05:00Z", "", ""), (3, U2, "", "", ""),
        (4, U1, "", "", "0"), (5, "GPU-99999999-9999-9999-9999-999999999999", "", "", "5"),
    ], "request_id long, uuid string, start_time string, end_time string, limit string")
    st = H.request_status(reqs, devs)
    status = {r.request_id: r.status for r in st.collect()}
    assert status == {1: "ok", 2: "ok", 3: "not_found", 4: "invalid_limit", 5: "ok"}
    rows = H.bulk_history(st, tel, salts=4)
    got = {}
    for r in rows.collect():
        got.setdefault(r.request_id, []).append((r.timestamp, r.value))
    assert sorted(got[1], reverse=True) == [(r.timestamp, r.value) for r in H.device_history(tel, U1, limit=3).collect()]
    assert len(got[2]) == 6
    totals = {r.request_id: r.total for r in H.history_totals(st, tel).collect()}
    assert totals == {1: 3, 2: 6, 3: None, 4: None, 5: 0}


def test_bulk_top_k_with_one_hot_device(spark, devs):
    # one device owns every row; the salted top-k must still return exactly the newest k
    rows = [(U1, "m", str(i), T0 + timedelta(seconds=i), "b", "", i) for i in range(2000)]
    tel = spark.createDataFrame(rows, TEL_DDL).repartition(8)
    reqs = spark.createDataFrame([(1, U1, "", "", "25")], "request_id long, uuid string, start_time string, end_time string, limit string")
    out = H.bulk_history(H.request_status(reqs, devs), tel, salts=16).collect()
    assert sorted(int(r.value) for r in out) == list(range(1975, 2000))
