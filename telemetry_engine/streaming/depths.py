"""Queue depths kept up by a stream: counters per (topic, consumer_group), changed by what changes.

A message of a group is ready, in_flight, acked, redeliver or dead_letter (``operators.delivery.delivery_state``).
Per message the stream keeps what decides that: the number of fetches, the latest one and the closes after
it.  Whenever the state changes, by an event or by an event-time timer as the lease runs out, it emits -1 for the
old one and +1 for the new; every fetch adds 1 to its consumer.  Events may come in any order: a late one changes the
state to what it would be had it come in time.  Time is the greatest event time of the batches before.

``foreachBatch`` adds an epoch's changes (summed in the tasks first) to the totals of the newest committed epoch and
writes the new totals, so an epoch costs its changes plus one row per (topic, group, state or consumer); messages
are never counted anew.  A consumer counts as long as it has a fetch.  A replayed epoch starts from the totals
before it and overwrites its own.  Totals of earlier epochs stay for ``KEEP_HOURS``, for readers that opened them.

Rows without a time take no part; null topics, groups, message ids are values of their own, null consumers do not
count; no rows give no counters.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from telemetry_engine.schemas import MAX_RETRIES, VISIBILITY_TIMEOUT_SECONDS
from telemetry_engine.session import pickle_by_value
from telemetry_engine.sources import fs
from telemetry_engine.streaming.buckets import by_buckets
from telemetry_engine.streaming.epochs import commit, epoch_dir, is_committed, state_on_disk
from telemetry_engine.streaming.redeliveries import KEY, event_micros, ticking

KEEP_HOURS = 24
COUNTER = ["topic", "consumer_group", "kind", "name"]  # kind: state | consumer
CHANGES = "topic string, consumer_group string, kind string, name string, change long"


class MessageStates(StatefulProcessor):
    """State: fetches, the latest one (us, seq), the closes after it, the state as emitted."""

    def __init__(self, visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS, max_retries: int = MAX_RETRIES):
        self.timeout_us, self.max_retries = visibility_timeout * 1_000_000, max_retries

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "fetches long, us long, seq long, closes string, state string")

    def _load(self) -> tuple[int, tuple[int, int], list[tuple[int, int, str]], str]:
        st = self.kept.get()
        if st is None:
            return 0, (0, 0), [], ""
        closes = [(int(a), int(b), op) for a, b, op in (x.split(":") for x in st[3].split(";"))] if st[3] else []
        return int(st[0]), (int(st[1]), int(st[2])), closes, st[4]

    def _expires_ms(self, us: int) -> int:
        return (us + self.timeout_us) // 1_000_000 * 1000

    def _state(self, fetches: int, last: tuple[int, int], closes: list[tuple[int, int, str]], now_ms: int) -> str:
        if not fetches:
            return "ready"
        expires = self._expires_ms(last[0])
        if closes and closes[0][0] // 1_000_000 * 1000 < expires:
            return "acked" if closes[0][2] == "a" else "ready"
        if expires > now_ms:
            return "in_flight"
        return "dead_letter" if fetches >= self.max_retries else "redeliver"

    def _settle(self, key, fetches: int, last: tuple[int, int], closes: list[tuple[int, int, str]], before: str,
                now_ms: int) -> tuple[str, list[Row]]:
        state = self._state(fetches, last, closes, now_ms)
        self.kept.update((fetches, *last, ";".join(f"{a}:{b}:{op}" for a, b, op in closes), state))
        if state == before:
            return state, []
        left = [_change(key, "state", before, -1)] if before else []
        return state, [*left, _change(key, "state", state, 1)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fetches, last, closes, before = self._load()
        lease = last if before == "in_flight" else None
        consumers: dict[str, int] = {}
        for r in rows:
            at = (int(r.ts_us), int(r.seq))
            if r.op == "fetch":
                last = max(last, at) if fetches else at
                fetches += 1
                if r.consumer_id is not None:
                    consumers[r.consumer_id] = consumers.get(r.consumer_id, 0) + 1
            elif r.op != "publish":
                closes.append((*at, r.op[0]))
        if fetches:  # those before the latest fetch have no say any more
            closes = [c for c in closes if c[:2] > last]
        closes.sort()
        now_ms = timerValues.getCurrentWatermarkInMs()
        state, out = self._settle(key, fetches, last, closes, before, now_ms)
        runs = last if state == "in_flight" else None
        if runs != lease:
            due = lambda x: None if x is None else self._expires_ms(x[0])
            if due(lease) != due(runs):
                if lease is not None and due(lease) > now_ms:
                    self.handle.deleteTimer(due(lease))
                if runs is not None:
                    self.handle.registerTimer(due(runs))
        return iter([*out, *[_change(key, "consumer", c, n) for c, n in sorted(consumers.items())]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter(self._settle(key, *self._load(), timerValues.getCurrentWatermarkInMs())[1])

    def close(self) -> None:
        pass


def _change(key, kind: str, name: str, change: int) -> Row:
    return Row(topic=key[0], consumer_group=key[1], kind=kind, name=name, change=change)


def depth_changes(log_stream: DataFrame, visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS,
                  max_retries: int = MAX_RETRIES) -> DataFrame:
    """Streaming DataFrame (append mode) of changes to the counters."""
    pickle_by_value(__name__)
    events = (log_stream.where(F.col("op").isin("publish", "fetch", "ack", "nack") & F.col("ts").isNotNull())
              .select(*KEY, "consumer_id", "op", "seq", event_micros().alias("ts_us")))
    return by_buckets(ticking(events), KEY, MessageStates(visibility_timeout, max_retries), CHANGES, "EventTime")


def start_depths(log_stream: DataFrame, out_dir: str, visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS,
                 max_retries: int = MAX_RETRIES, available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Keep up the counters of ``log_stream`` (a delivery log) below ``out_dir``."""
    base = f"{out_dir}/depths"

    def fold(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        there = _committed(session, base, epoch_id)
        rows = batch if not there else batch.unionByName(_totals(session, base, there[0]))
        (rows.groupBy(*COUNTER).agg(F.sum("change").alias("change")).where("change <> 0")
         .write.mode("overwrite").parquet(epoch_dir(base, epoch_id)))
        commit(session, out_dir, epoch_id)
        old = {p.rstrip("/").rsplit("/", 1)[-1] for p in fs.older_than(session, base, KEEP_HOURS)}
        for e in there[1:]:  # the newest before this one is what a replay starts from
            if epoch_dir("", e).lstrip("/") in old:
                fs.delete(session, f"{out_dir}/_committed/{e:010d}")
                fs.delete(session, epoch_dir(base, e))

    changes = depth_changes(log_stream, visibility_timeout, max_retries)
    w = changes.writeStream.foreachBatch(fold).outputMode("append").option("checkpointLocation", f"{out_dir}/_checkpoints/depths")
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    with state_on_disk(log_stream.sparkSession):
        return w.start()


def queue_depths(spark: SparkSession, out_dir: str) -> DataFrame:
    """The counters as of the newest committed epoch, as ``operators.delivery.queue_stats`` gives them."""
    base = f"{out_dir}/depths"
    there = _committed(spark, base)
    rows = _totals(spark, base, there[0]) if there else spark.createDataFrame([], CHANGES)
    depth = lambda *states: F.coalesce(F.sum(F.when(
        (F.col("kind") == "state") & F.col("name").isin(*states), F.col("change"))), F.lit(0)).cast("bigint")
    return rows.groupBy("topic", "consumer_group").agg(
        depth("ready", "redeliver").alias("queue_depth"), depth("in_flight").alias("pending"), depth("acked").alias("acked"),
        depth("dead_letter").alias("dead_letters"), F.count_if(F.col("kind") == "consumer").alias("consumers"))


def _committed(spark: SparkSession, base: str, before: int | None = None) -> list[int]:
    """Committed epochs (before ``before``, if given), newest first."""
    out_dir = base.rsplit("/", 1)[0]
    there = [int(n[6:]) for n in fs.list_names(spark, base) if n.startswith("epoch=")]
    return [e for e in sorted(there, reverse=True) if (before is None or e < before) and is_committed(spark, out_dir, e)]


def _totals(spark: SparkSession, base: str, epoch_id: int) -> DataFrame:
    return spark.read.schema(CHANGES).parquet(epoch_dir(base, epoch_id))
