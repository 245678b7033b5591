"""Lease expiry emitted by the stream: timers, revocations, bounded work per batch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telemetry_engine.operators import delivery
from telemetry_engine.streaming.epochs import state_on_disk
from telemetry_engine.streaming.redeliveries import Redeliveries, outstanding, redelivery_changes

LOG = "topic string, consumer_group string, consumer_id string, message_id string, op string, ts timestamp_ntz, seq long"
T0 = datetime(2024, 3, 1, 12)
COLUMNS = ["topic", "consumer_group", "message_id", "fetch_ts", "fetch_seq", "deliveries", "outcome"]


def _write(spark, tmp, name, rows):
    full = [("q", "g", "c", m, op, T0 + timedelta(seconds=s), k) for m, op, s, k in rows]
    spark.createDataFrame(full, LOG).coalesce(1).write.parquet(f"{tmp}/log/{name}")


def _drain(spark, tmp, files=1, **how):
    src = spark.readStream.schema(LOG).option("maxFilesPerTrigger", files).parquet(f"{tmp}/log/*")
    with state_on_disk(spark):
        (redelivery_changes(src, **how).writeStream.format("parquet").option("path", f"{tmp}/out")
         .option("checkpointLocation", f"{tmp}/cp").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{tmp}/out")


def _rows(changes):
    t = [(r.message_id, r.fetch_seq, r.deliveries, r.outcome, r.change) for r in changes.collect()]
    return sorted(t)


def test_time_passes_by_other_keys_and_late_events_revoke(spark, tmp):
    _write(spark, tmp, "a", [("m", "fetch", 0, 1)])
    assert _rows(_drain(spark, tmp)) == []
    _write(spark, tmp, "b", [("other", "fetch", 299, 2), ("other", "ack", 299, 3)])
    assert _rows(_drain(spark, tmp)) == []                                  # the lease of m runs until second 300
    _write(spark, tmp, "c", [("other", "fetch", 300, 4), ("other", "ack", 301, 5)])
    got = _drain(spark, tmp)
    assert _rows(got) == [("m", 1, 1, "redeliver", 1)]                      # m itself had no new event
    assert got.first().emitted_ms == int((T0 - datetime(1970, 1, 1)).total_seconds() + 301) * 1000
    _write(spark, tmp, "d", [("m", "fetch", 400, 6)])
    assert len(_rows(_drain(spark, tmp))) == 1
    _write(spark, tmp, "e", [("other", "fetch", 5000, 7)])
    assert ("m", 6, 2, "redeliver", 1) in _rows(_drain(spark, tmp))
    _write(spark, tmp, "f", [("m", "fetch", 350, 8)])                       # late: one more delivery before the last
    got = _drain(spark, tmp)
    assert [r for r in _rows(got) if r[1] in (6, 8)] == [("m", 6, 2, "redeliver", -1), ("m", 6, 2, "redeliver", 1),
                                                         ("m", 6, 3, "dead_letter", 1)]
    _write(spark, tmp, "g", [("m", "ack", 10, 9)])                          # late: the first lease had been closed
    got = _drain(spark, tmp)
    assert sorted((r.message_id, r.fetch_seq, r.deliveries, r.outcome) for r in outstanding(got).collect()) == [
        ("m", 6, 3, "dead_letter")]


@pytest.mark.parametrize(("seed", "chunk", "files"), [(1, 64, 2), (2, 1, 1), (3, 2, 3)])
def test_net_equals_batch_over_files_in_any_order(spark, tmp, seed, chunk, files):
    rng = random.Random(seed)
    rows = [("q", f"g{rng.randint(0, 1)}", "c", f"m{rng.randint(0, 5)}", rng.choice(["fetch", "fetch", "ack", "nack", "publish"]),
             T0 + timedelta(seconds=rng.randint(0, 20_000), microseconds=rng.choice([0, 1, 999_999])), k) for k in range(400)]
    log = spark.createDataFrame(rows, LOG)
    log.repartition(6, "seq").write.parquet(f"{tmp}/log/a")
    got = outstanding(_drain(spark, tmp, files, chunk=chunk))
    now = max(r[5] for r in rows if r[4] != "publish")
    twin = delivery.lease_outcomes(log, now).where("ended is null").where(F.col("expires") <= F.lit(now).cast("timestamp_ntz"))
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == sorted(map(tuple, twin.select(*COLUMNS).collect()))


class _Handle:
    """State in memory that counts what is read and written."""

    def __init__(self):
        self.value, self.items, self.timers = None, [], set()
        self.largest = self.list_reads = 0

    def getValueState(self, name, schema):
        return self

    def getListState(self, name, schema):
        return _List(self)

    def get(self):
        return self.value

    def update(self, value):
        self.value = value
        self.largest = max(self.largest, len(value[1]))

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)


class _List:
    def __init__(self, h):
        self.h = h

    def get(self):
        self.h.list_reads += 1
        return iter(list(self.h.items))

    def put(self, items):
        self.h.items = list(items)

    def clear(self):
        self.h.items = []

    def appendValue(self, item):
        self.h.items.append(item)


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


class _Event:
    def __init__(self, us, seq, op):
        self.ts_us, self.seq, self.op = us, seq, op


def test_work_of_a_batch_does_not_grow_with_the_history():
    h, p = _Handle(), Redeliveries(300, 3, chunk=16)
    p.init(h)
    emitted = []
    for k in range(2000):  # a fetch every 200 s; every third one is closed
        s = 200 * k
        events = [_Event(s * 1_000_000, 2 * k, "fetch")] + ([_Event((s + 50) * 1_000_000, 2 * k + 1, "ack")] if k % 3 == 0 else [])
        emitted += p.handleInputRows(("q", "g", "m"), iter(events), _At((s - 200) * 1000))
    assert h.list_reads == 0 and h.largest < 3000 and len(h.timers) <= 2
    assert sum(text.count(":f:") for (text,) in h.items) > 1900
    # one event older than the value: the history is read once
    p.handleInputRows(("q", "g", "m"), iter([_Event(10, 9999, "ack")]), _At(0))
    assert h.list_reads == 1


def test_a_close_cancels_the_timer_and_expiry_emits_once():
    h, p = _Handle(), Redeliveries(300, 3)
    p.init(h)
    key = ("q", "g", "m")
    assert not list(p.handleInputRows(key, iter([_Event(0, 1, "fetch")]), _At(0))) and h.timers == {300_000}
    assert not list(p.handleInputRows(key, iter([_Event(5_000_000, 2, "ack")]), _At(0))) and h.timers == set()
    assert not list(p.handleInputRows(key, iter([_Event(10_000_000, 3, "fetch")]), _At(0))) and h.timers == {310_000}
    assert [r.change for r in p.handleExpiredTimer(key, _At(310_000), None)] == [1]
    assert not list(p.handleExpiredTimer(key, _At(400_000), None))
