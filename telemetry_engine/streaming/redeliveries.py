"""Redeliveries and dead letters, emitted by the stream as leases run out.

A lease that is neither closed nor taken over by another fetch is redelivered (or, from ``max_retries``
deliveries on, a dead letter) once time passes its expiry.  Time is the greatest event time of the batches before:
an event-time timer per open lease fires then, also when its key has no new event.  A close or another
fetch in time cancels the timer.  Events may come in any order and however late: an event that shows that a lease
had ended, or that there was one more delivery before it, revokes what was emitted (``change`` -1) and emits
what holds instead, so the sum of ``change`` per row is right at any moment.

State per (topic, consumer_group, message_id): a value with the latest events, and a list to which settled ones
are moved, ``CHUNK`` at a time.  A batch reads and writes the value only; the list is read by the rare event that
is older than all of the value's.  So the work of a batch does not grow with the key's history.  State lives in
RocksDB (start the query within ``epochs.state_on_disk``).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from telemetry_engine.functions.timeutil import EPOCH_NTZ
from telemetry_engine.schemas import MAX_RETRIES, VISIBILITY_TIMEOUT_SECONDS
from telemetry_engine.session import pickle_by_value
from telemetry_engine.streaming.buckets import by_buckets

KEY = ["topic", "consumer_group", "message_id"]
CHANGES = ("topic string, consumer_group string, message_id string, fetch_us long, fetch_seq long, deliveries long, "
           "outcome string, change int, emitted_ms long")
CHUNK = 64

Event = tuple[int, int, str, int]  # event time in us, seq, f(etch) | a(ck) | n(ack), deliveries as emitted (0: not)


def settled(events: list[Event], base: int, now_ms: int, timeout_us: int) -> tuple[list[Event], list[tuple], list[int], int]:
    """(events as now emitted, changes, expiries in s still ahead, how many leading events can't change any more by time).

    ``base``: fetches before the first event.  A lease is decided by the event after its fetch: it ends it
    if it comes before the expiry, in whole seconds.
    """
    out, changes, ahead, firm = [], [], [], None
    fetches = base
    for i, (us, seq, op, emitted) in enumerate(events):
        if op == "f":
            fetches += 1
            expires = (us + timeout_us) // 1_000_000
            ended = i + 1 < len(events) and events[i + 1][0] // 1_000_000 < expires
            due = not ended and expires * 1000 <= now_ms
            if not ended and not due:
                ahead.append(expires)
                firm = i if firm is None else firm
            now = fetches if due else 0
            if now != emitted:
                if emitted:
                    changes.append((us, seq, emitted, -1))
                if now:
                    changes.append((us, seq, now, 1))
            emitted = now
        out.append((us, seq, op, emitted))
    # the last event decides its lease only as long as no other comes before the next one
    firm = len(out) - 1 if firm is None else min(firm, len(out) - 1)
    return out, changes, ahead, max(0, firm)


def _text(events: list[Event]) -> str:
    return ";".join(f"{a}:{b}:{op}:{n}" for a, b, op, n in events)


def _events(text: str | None) -> list[Event]:
    return [(int(a), int(b), op, int(n)) for a, b, op, n in (x.split(":") for x in text.split(";"))] if text else []


class Redeliveries(StatefulProcessor):
    """State: ``recent`` (fetches in the list, the latest events) and the list ``old`` of chunks of settled events."""

    def __init__(self, visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS, max_retries: int = MAX_RETRIES, chunk: int = CHUNK):
        self.timeout_us, self.max_retries, self.chunk = visibility_timeout * 1_000_000, max_retries, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getValueState("recent", "base long, events string")
        self.old = handle.getListState("old", "events string")

    def _load(self) -> tuple[int, list[Event]]:
        st = self.recent.get()
        return (0, []) if st is None else (int(st[0]), _events(st[1]))

    def _settle(self, key, base: int, events: list[Event], now_ms: int, whole: bool) -> tuple[list[Row], list[int]]:
        events, changes, ahead, firm = settled(events, base, now_ms, self.timeout_us)
        chunks = []
        while firm >= self.chunk and len(events) >= 2 * self.chunk:
            part, events, firm = events[:self.chunk], events[self.chunk:], firm - self.chunk
            base += sum(e[2] == "f" for e in part)
            chunks.append((_text(part),))
        if whole:  # ``events`` began with the whole history
            if chunks:
                self.old.put(chunks)
            else:
                self.old.clear()
        else:
            for c in chunks:
                self.old.appendValue(c)
        self.recent.update((base, _text(events)))
        name = dict(topic=key[0], consumer_group=key[1], message_id=key[2])
        rows = [Row(**name, fetch_us=us, fetch_seq=seq, deliveries=n, outcome="dead_letter" if n >= self.max_retries else "redeliver",
                    change=change, emitted_ms=now_ms) for us, seq, n, change in changes]
        return rows, ahead

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = sorted((int(r.ts_us), int(r.seq), r.op[0], 0) for r in rows)
        base, events = self._load()
        # the lease before the first new event may change too
        whole = bool(base) and new[0][:2] < events[0][:2]
        if whole:
            events = [e for (text,) in self.old.get() for e in _events(text)] + events
            base = 0
        before = self._open(events)
        now_ms = timerValues.getCurrentWatermarkInMs()
        out, ahead = self._settle(key, base, sorted(events + new), now_ms, whole)
        # a lease that has ended stays so: only new fetches open one
        begun = {self._expires(us) for us, _, op, _ in new if op == "f"}
        for expires in begun & set(ahead):
            self.handle.registerTimer(expires * 1000)
        for expires in before - set(ahead):
            if expires * 1000 > now_ms:  # closed or taken over in time
                self.handle.deleteTimer(expires * 1000)
        return iter(out)

    def _expires(self, us: int) -> int:
        return (us + self.timeout_us) // 1_000_000

    def _open(self, events: list[Event]) -> set[int]:
        """Expiries, in seconds, of the leases that nothing has ended and that have not been emitted."""
        later = [*[e[0] // 1_000_000 for e in events[1:]], None]
        return {self._expires(us) for (us, _, op, emitted), then in zip(events, later)
                if op == "f" and not emitted and (then is None or then >= self._expires(us))}

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        base, events = self._load()
        out, _ = self._settle(key, base, events, timerValues.getCurrentWatermarkInMs(), False)
        return iter(out)

    def close(self) -> None:
        pass


def event_micros() -> Column:
    """``ts`` in microseconds since 1970, in no zone."""
    gap = F.col("ts") - F.lit(EPOCH_NTZ).cast("timestamp_ntz")
    part = lambda unit: F.extract(F.lit(unit), gap)
    return ((part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60).cast("bigint") * 1_000_000
            + (part("SECOND") * 1_000_000).cast("bigint"))


def ticking(events: DataFrame) -> DataFrame:
    """``events`` (with ``ts_us``), every one of which moves the clock while none is late.

    The watermark is that of a second row with a clock, which ends here, while the event itself has none.
    """
    ticked = events.withColumn("clock", F.explode(F.array(F.lit(None).cast("timestamp"), F.timestamp_micros("ts_us"))))
    return ticked.withWatermark("clock", "0 seconds").where(F.col("clock").isNull())


def redelivery_changes(log_stream: DataFrame, visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS, max_retries: int = MAX_RETRIES,
                       chunk: int = CHUNK) -> DataFrame:
    """Streaming DataFrame of changes (append mode): a row that holds (+1) or holds no more (-1)."""
    pickle_by_value(__name__)
    events = log_stream.where(F.col("op").isin("fetch", "ack", "nack")).select(*KEY, "op", "seq", event_micros().alias("ts_us"))
    return by_buckets(ticking(events), KEY, Redeliveries(visibility_timeout, max_retries, chunk), CHANGES, "EventTime")


def outstanding(changes: DataFrame) -> DataFrame:
    """What holds by all ``changes``: leases that ran out, with their outcome."""
    row = [*KEY, "fetch_us", "fetch_seq", "deliveries", "outcome"]
    fetch_ts = F.timestamp_add("MICROSECOND", F.col("fetch_us"), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))
    return (changes.groupBy(*row).agg(F.sum("change").alias("n")).where("n > 0")
            .select(*KEY, fetch_ts.alias("fetch_ts"), "fetch_seq", "deliveries", "outcome"))
