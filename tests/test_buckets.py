"""Processors of single keys run by the bucket: what they keep and emit, and what a bucket reads and writes."""

import json
import random
from types import SimpleNamespace

import pytest

from telemetry_engine.streaming.buckets import Buckets
from telemetry_engine.streaming.depths import MessageStates
from telemetry_engine.streaming.leases import LeaseLog
from telemetry_engine.streaming.redeliveries import Redeliveries

FIELDS = ["consumer_id", "op", "seq", "ts_us"]


class _Handle:
    """State of one group in memory that counts the calls."""

    def __init__(self):
        self.calls, self.timers, self.states = 0, set(), {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, _Value(self))

    def getMapState(self, name, key_schema, schema):
        return self.states.setdefault(name, _Map(self))

    def getListState(self, name, schema):
        return self.states.setdefault(name, _List(self))

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.remove(ms)


class _Value:
    def __init__(self, h):
        self.h, self.value = h, None

    def get(self):
        self.h.calls += 1
        return self.value

    def update(self, value):
        self.h.calls += 1
        self.value = value


class _Map:
    def __init__(self, h):
        self.h, self.items = h, {}

    def getValue(self, key):
        self.h.calls += 1
        return self.items.get(key)

    def updateValue(self, key, value):
        self.h.calls += 1
        self.items[key] = value

    def removeKey(self, key):
        del self.items[key]


class _List:
    def __init__(self, h):
        self.items = []

    def get(self):
        return iter(list(self.items))

    def put(self, items):
        self.items = list(items)

    def clear(self):
        self.items = []

    def appendValue(self, item):
        self.items.append(item)


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _row(key, *event):
    return (0, json.dumps(key) + "\n" + json.dumps([None if x is None else str(x) for x in event]))


def _fire(p, h, key, now):
    out = []
    for ms in sorted(t for t in h.timers if t <= now):
        out += p.handleExpiredTimer(key, _At(now), None)
        h.timers.discard(ms)
    return out


MAKES = [lambda: MessageStates(300, 3), lambda: Redeliveries(300, 3, chunk=2), lambda: LeaseLog(300)]


@pytest.mark.parametrize("make", MAKES, ids=["depths", "redeliveries", "leases"])
def test_a_bucket_emits_what_its_keys_alone_emit(make):
    rng = random.Random(7)
    keys = [(t, "g", m) for t in ("q", None, 'a"\n') for m in ("m1", "m2", None, "ü", "")]
    h = _Handle()
    alone = {k: (make(), _Handle()) for k in keys}
    for k, (p, own) in alone.items():
        p.init(own)
    now = 0
    for step in range(30):
        bucket = Buckets(make(), FIELDS, page_keys=2)  # a task of its own for every batch
        bucket.init(h)
        events = [(rng.choice(keys), (rng.choice(["c1", "c2", None]), rng.choice(["fetch", "fetch", "ack", "nack"]), step * 100 + i,
                                      rng.randint(0, (step + 1) * 200) * 1_000_000)) for i in range(8)]
        want = []
        for k in keys:
            mine = [SimpleNamespace(**dict(zip(FIELDS, e, strict=True))) for kk, e in events if kk == k]
            if mine:
                want += alone[k][0].handleInputRows(k, iter(mine), _At(now))
        got = list(bucket.handleInputRows((0,), iter([_row(k, *e) for k, e in events]), _At(now)))
        for k in keys:
            want += _fire(*alone[k], k, now)
        got += _fire(bucket, h, (0,), now)
        assert sorted(map(repr, got)) == sorted(map(repr, want))
        assert len(h.timers) <= 1
        now = max(now, max(e[3] for _, e in events) // 1000)
    assert json.loads(h.states["book"].value[0])["pages"] == 8  # 15 keys, 2 a page


def test_calls_follow_the_pages_and_not_the_keys():
    h, p = _Handle(), Buckets(MessageStates(300, 3), FIELDS, page_keys=100)
    p.init(h)
    list(p.handleInputRows((0,), iter([_row(("q", "g", f"m{i}"), "c", "fetch", i, i * 1000) for i in range(3_000)]), _At(0)))
    pages = len(h.states["pages"].items)
    assert pages == 32 and h.calls <= pages + 5  # each key had its own calls before
    h.calls = 0
    list(p.handleInputRows((0,), iter([_row(("q", "g", "m7"), "c", "ack", 5_000, 9_000)]), _At(0)))
    assert h.calls <= 6  # the book and one page, however many keys there are
    h.calls = 0
    assert len(_fire(p, h, (0,), 400_000)) == 2 * 2_999  # every other message left in_flight
    assert h.calls <= 2 * pages + 5 and not h.timers
