"""Lease expiry over a delivery-event stream, in any order of arrival.

Per (topic, consumer_group, message_id) the state is the list of the key's
fetches and closes in order of event time.  A micro-batch's events of a key are
merged into it wherever they belong, and the leases from the first change on
are emitted again under the key's next version: a late ack closes the lease
that it refers to, a late fetch renumbers those after it.  There is no
watermark and no eviction, so no event is dropped and no delivery count is
forgotten.  ``expired_leases`` reads what the stream wrote: the latest version
of every lease, as of the greatest event time seen or a given one.

State lives in RocksDB (start the query within ``epochs.state_on_disk``); it
and a batch's work for a key grow with the key's own events only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from telemetry_engine.schemas import MAX_RETRIES, VISIBILITY_TIMEOUT_SECONDS
from telemetry_engine.session import pickle_by_value
from telemetry_engine.streaming.buckets import by_buckets

KEY = ["topic", "consumer_group", "message_id"]
UPDATE_SCHEMA = (
    "topic string, consumer_group string, message_id string, version long, seen_us long, fetch_us long, "
    "fetch_seq long, expires_s long, deliveries long, ended boolean"
)
EPOCH = "1970-01-01 00:00:00"


def key_leases(events: list[tuple[int, int, str]], timeout_us: int) -> list[tuple[int, int, int, int, bool]]:
    """(fetch_us, fetch_seq, expires_s, deliveries, ended) of each lease of one key's ordered events."""
    out: list[list] = []
    for us, seq, op in events:
        if out and not out[-1][5]:
            # the first close of a lease ends it if it is still open, and so does another fetch
            out[-1][4] = us // 1_000_000 < out[-1][2]
            out[-1][5] = True
        if op == "f":
            out.append([us, seq, (us + timeout_us) // 1_000_000, len(out) + 1, False, False])
    return [tuple(x[:5]) for x in out]


class LeaseLog(StatefulProcessor):
    """State: the key's version and its events, as text of ``us:seq:op`` entries.

    It is read once and written once per key and micro-batch, with those of other keys (``buckets``).
    """

    def __init__(self, visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS):
        self.timeout_us = visibility_timeout * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("lease", "version long, events string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = sorted((int(r.ts_us), int(r.seq), r.op[0]) for r in rows)
        st = self.state.get()
        version, events = 1, []
        if st is not None:
            version = int(st[0]) + 1
            events = [(int(a), int(b), op) for a, b, op in (x.split(":") for x in st[1].split(";"))]
        first = bisect_left(events, new[0])
        events = events[:first] + sorted(events[first:] + new) if first < len(events) else events + new
        self.state.update((version, ";".join(f"{a}:{b}:{op}" for a, b, op in events)))
        leases = key_leases(events, self.timeout_us)
        # leases that an event at ``new[0]`` or later can change: from the one before it on
        start = max(0, bisect_left([(x[0], x[1]) for x in leases], new[0][:2]) - 1)
        base = dict(topic=key[0], consumer_group=key[1], message_id=key[2], version=version, seen_us=new[-1][0])
        out = [Row(**base, fetch_us=a, fetch_seq=b, expires_s=c, deliveries=d, ended=e) for a, b, c, d, e in leases[start:]]
        return iter(out or [Row(**base, fetch_us=None, fetch_seq=None, expires_s=None, deliveries=None, ended=None)])

    def close(self) -> None:
        pass


def lease_updates(log_stream: DataFrame, visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS) -> DataFrame:
    """Streaming DataFrame of lease versions (append mode)."""
    pickle_by_value(__name__)
    gap = F.col("ts") - F.lit(EPOCH).cast("timestamp_ntz")
    part = lambda unit: F.extract(F.lit(unit), gap)  # noqa: E731  in no zone
    us = ((part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60).cast("bigint") * 1_000_000
          + (part("SECOND") * 1_000_000).cast("bigint"))
    events = log_stream.where(F.col("op").isin("fetch", "ack", "nack")).select(*KEY, "op", "seq", us.alias("ts_us"))
    return by_buckets(events, KEY, LeaseLog(visibility_timeout), UPDATE_SCHEMA, "None")


def expired_leases(updates: DataFrame, as_of: datetime | None = None, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Leases that had run out by ``as_of`` (default: the greatest event time seen), by the latest versions.

    fetch_ts, fetch_seq, deliveries and ``outcome``: redeliver, or dead_letter
    from ``max_retries`` deliveries on.
    """
    if as_of is None:
        now = updates.agg(F.max("seen_us")).scalar()
    else:
        now = F.lit(int((as_of - datetime(1970, 1, 1)).total_seconds() * 1_000_000))
    last = (updates.where("fetch_seq is not null").groupBy(*KEY, "fetch_seq")
            .agg(F.max_by(F.struct("fetch_us", "expires_s", "deliveries", "ended"), "version").alias("l")))
    fetch_ts = F.timestamp_add("MICROSECOND", F.col("l.fetch_us"), F.lit(EPOCH).cast("timestamp_ntz"))
    outcome = F.when(F.col("l.deliveries") >= max_retries, F.lit("dead_letter")).otherwise(F.lit("redeliver"))
    return (last.where(~F.col("l.ended") & (F.col("l.expires_s") * 1_000_000 <= now))
            .select(*KEY, fetch_ts.alias("fetch_ts"), "fetch_seq", F.col("l.deliveries").alias("deliveries"),
                    outcome.alias("outcome")))
