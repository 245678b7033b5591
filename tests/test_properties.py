"""Property tests: the driver-side and columnar validators agree on every input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from telemetry_engine.operators import history as H

UUIDS = st.sampled_from([
    "", "GPU-0000002a-0000-0000-0000-00000000002a", "0000ABCD-00EF-0000-0000-00000000FACE",
    "GPU-0000002a-0000-0000-0000-00000000002", "gpu-0000002a-0000-0000-0000-00000000002a", "x",
])


@st.composite
def rfc_like(draw):
    if draw(st.integers(0, 9)) == 0:
        return draw(st.sampled_from(["", "invalid", "2025-01-18", "2025-01-18 10:00:00Z", "2025-01-18T10:00Z"]))
    y = draw(st.integers(1999, 2031))
    mo = draw(st.integers(0, 13))
    d = draw(st.integers(0, 32))
    h = draw(st.integers(0, 25))
    mi = draw(st.integers(0, 61))
    s = draw(st.integers(0, 61))
    frac = draw(st.sampled_from(["", ".5", ".123456", ".123456789", "."]))
    zone = draw(st.sampled_from(["Z", "+02:00", "-05:30", "+24:00", "+01:60", "z", "+0200"]))
    t = draw(st.sampled_from(["T", "t", " "]))
    return f"{y:04d}-{mo:02d}-{d:02d}{t}{h:02d}:{mi:02d}:{s:02d}{frac}{zone}"


LIMITS = st.one_of(st.sampled_from(["", "abc", "0", "1", "10000", "10001", "+5", "-1", "007", " 5", "1e3"]),
                   st.integers(-5, 20000).map(str))
REQ = st.tuples(UUIDS, rfc_like(), rfc_like(), LIMITS)


def _py_status(uuid, start, end, limit):
    try:
        f = H.validate_request(uuid, start, end, limit)
    except H.HistoryRequestError as e:
        return e.code, None, None, None
    return None, f.start, f.end, f.limit


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(REQ, min_size=60, max_size=120))
def test_columnar_validation_matches_driver_validation(spark, reqs):
    rows = [(i, *r) for i, r in enumerate(reqs)]
    df = spark.createDataFrame(rows, "request_id long, uuid string, start_time string, end_time string, limit string")
    got = {r.request_id: (r.status, r.start_ts, r.end_ts, r.limit_n) for r in H.validate_requests(df).collect()}
    for i, r in enumerate(reqs):
        status, start, end, limit = _py_status(*r)
        g = got[i]
        assert g[0] == status, (r, g)
        if status is None:
            assert (g[1], g[2], g[3]) == (start, end, limit), (r, g)


LABEL_KEYS = st.sampled_from(["a", "b", "Hostname", "UPPER_KEY_9", "x.y", "_k"])
BS = chr(92)  # backslash
LABEL_VALUES = st.text(alphabet='abc ,="\\\\1', max_size=8)


def _render(pairs):
    def esc(v):
        return v.replace(BS, BS + BS).replace('"', BS + '"')
    return ",".join(f'{k}="{esc(v)}"' for k, v in pairs)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(LABEL_KEYS, LABEL_VALUES), max_size=5), min_size=40, max_size=80))
def test_label_parsing_matches_python(spark, label_lists):
    from telemetry_engine.functions.scalars import label_pairs

    texts = [_render(pairs) for pairs in label_lists]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: {p.label_key: p.label_value for p in r.p} for r in df.select("i", label_pairs("t").alias("p")).collect()}
    for i, pairs in enumerate(label_lists):
        assert got[i] == dict(pairs), (texts[i], got[i])  # dict(): the last duplicate wins
