"""Queue depths kept up by a stream: any order of arrival, time, restarts, replays."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telemetry_engine.operators import delivery
from telemetry_engine.sources import fs
from telemetry_engine.streaming.depths import MessageStates, queue_depths, start_depths

LOG = "topic string, consumer_group string, consumer_id string, message_id string, op string, ts timestamp_ntz, seq long"
T0 = datetime(2024, 3, 1, 12)
COLUMNS = ["topic", "consumer_group", "queue_depth", "pending", "acked", "dead_letters", "consumers"]


def _write(spark, tmp, name, rows):
    full = [("q", "g", c, m, op, None if s is None else T0 + timedelta(seconds=s), k) for m, op, s, k, c in rows]
    spark.createDataFrame(full, LOG).coalesce(1).write.parquet(f"{tmp}/log/{name}")


def _drain(spark, tmp, files=1):
    src = spark.readStream.schema(LOG).option("maxFilesPerTrigger", files).parquet(f"{tmp}/log/*")
    start_depths(src, f"{tmp}/out").awaitTermination()
    return _rows(queue_depths(spark, f"{tmp}/out"))


def _rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_depths_follow_events_time_and_late_events(spark, tmp):
    assert _rows(queue_depths(spark, f"{tmp}/none")) == []
    _write(spark, tmp, "a", [("m", "publish", 0, 1, "p"), ("n", "publish", 0, 2, "p"), ("m", "fetch", 1, 3, "c1")])
    assert _drain(spark, tmp) == [("q", "g", 1, 1, 0, 0, 1)]
    _write(spark, tmp, "b", [("n", "publish", 301, 4, "p")])
    assert _drain(spark, tmp) == [("q", "g", 2, 0, 0, 0, 1)]            # the lease of m ran out, m had no new event
    _write(spark, tmp, "c", [("m", "ack", 200, 5, "c1"), ("n", "fetch", 302, 6, "c2"), ("n", "fetch", None, 7, "c3")])
    assert _drain(spark, tmp) == [("q", "g", 0, 1, 1, 0, 2)]            # late: m had been acknowledged; no time, no part
    _write(spark, tmp, "d", [("m", "fetch", 210, 8, None), ("m", "fetch", 220, 9, "c1"), ("n", "nack", 303, 10, "c2")])
    assert _drain(spark, tmp) == [("q", "g", 1, 1, 0, 0, 2)]            # late: a newer lease than the acknowledged one
    _write(spark, tmp, "e", [("n", "publish", 600, 11, "p")])
    assert _drain(spark, tmp) == [("q", "g", 1, 0, 0, 1, 2)]            # which ran out as the third delivery


@pytest.mark.parametrize(("seed", "files"), [(1, 2), (2, 1)])
def test_equals_batch_over_files_in_any_order(spark, tmp, seed, files):
    rng = random.Random(seed)
    rows = [(rng.choice(["q", "r", None]), f"g{rng.randint(0, 1)}", rng.choice(["c0", "c1", "c2", None]), f"m{rng.randint(0, 9)}",
             rng.choice(["fetch", "fetch", "ack", "nack", "publish"]),
             T0 + timedelta(seconds=rng.randint(0, 9_000), microseconds=rng.choice([0, 1, 999_999])), k) for k in range(500)]
    rows += [(None, "g9", None, None, "publish", T0, 1000), ("q", "g9", "c0", None, "fetch", T0, 1001)]
    log = spark.createDataFrame(rows, LOG)
    log.repartition(5, "seq").write.parquet(f"{tmp}/log/a")
    got = _drain(spark, tmp, files)
    # the batch form joins groups to consumers by equality, which a null topic has not
    states = delivery.delivery_state(log.withColumn("topic", F.coalesce("topic", F.lit("~"))))
    twin = delivery.queue_stats(states, log.withColumn("topic", F.coalesce("topic", F.lit("~"))))
    assert [tuple("~" if x is None else x for x in r) for r in got if r[0] is None] == [r for r in _rows(twin) if r[0] == "~"]
    assert [r for r in got if r[0] is not None] == [r for r in _rows(twin) if r[0] != "~"]
    # totals hold a row per state and consumer of a group, not per message
    last = max(n for n in fs.list_names(spark, f"{tmp}/out/depths") if n.startswith("epoch="))
    assert spark.read.parquet(f"{tmp}/out/depths/{last}").count() <= 6 * (5 + 3)


def test_an_epoch_that_was_not_committed_is_written_again(spark, tmp):
    _write(spark, tmp, "a", [("m", "publish", 0, 1, "p"), ("m", "fetch", 1, 2, "c")])
    before = _drain(spark, tmp)
    # as if the run had ended between the last epoch's totals and its end: its marker and the stream's own are gone
    last = max(int(n) for n in fs.list_names(spark, f"{tmp}/out/_checkpoints/depths/commits") if n.isdigit())
    fs.delete(spark, f"{tmp}/out/_checkpoints/depths/commits/{last}")
    fs.delete(spark, f"{tmp}/out/_checkpoints/depths/commits/.{last}.crc")
    assert _drain(spark, tmp) == before


class _State:
    def __init__(self):
        self.value, self.timers, self.sizes = None, set(), []

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value
        self.sizes.append(len(value[3]))

    def registerTimer(self, ms):
        assert ms not in self.timers
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


class _Event:
    def __init__(self, op, us, seq):
        self.op, self.ts_us, self.seq, self.consumer_id = op, us, seq, "c"


def test_state_of_a_key_does_not_grow_with_its_history():
    h, p = _State(), MessageStates(10, 3)
    p.init(h)
    for i in range(2_000):
        us = i * 4_000_000
        rows = [_Event("fetch", us, 2 * i), *([_Event("nack", us + 1, 2 * i + 1)] if i % 3 == 0 else [])]
        out = list(p.handleInputRows(("q", "g", "m"), iter(rows), _At(max(0, us // 1000 - 4000))))
        assert sum(r.change for r in out if r.kind == "state") == (1 if i == 0 else 0)
        assert len(h.timers) <= 1
    assert max(h.sizes) < 40
