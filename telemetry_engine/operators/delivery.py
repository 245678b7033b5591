"""Delivery semantics derived from a delivery-event log.

Log rows: (topic, consumer_group, consumer_id, message_id, op, ts, seq) with
op in publish | fetch | ack | nack.  A fetch opens a lease that lasts
``visibility_timeout`` seconds; the first ack/nack after it, while it is
still open, closes it.  Any other ack/nack matches nothing.  Lease expiry is
decided on whole seconds: open while floor(fetch_ts + timeout) > floor(t).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_engine.functions.timeutil import add_seconds, whole_seconds
from telemetry_engine.schemas import MAX_RETRIES, VISIBILITY_TIMEOUT_SECONDS
from telemetry_engine.session import materialize

KEY = ["topic", "consumer_group", "message_id"]
CLOSES = ["ack", "nack"]


# A key with more log rows than this is split by time; a task sorts fewer with ease.
HOT_ROWS = 1_000_000
# So many of them, or of their segments, are broadcast (a few MB); more are joined as Spark sees fit.
HOT_KEYS = 50_000
# Characters of a time's text: hour, minute, second, tenth, thousandth, microsecond.
GRAINS = [13, 16, 19, 21, 23, 26]


def _lease_open(fetch_ts: Column, at: Column, timeout: int) -> Column:
    return whole_seconds(add_seconds(fetch_ts, timeout)) > whole_seconds(at)


def _with_leases(e: DataFrame) -> DataFrame:
    """Rows with ``lease`` (ts, seq of the latest fetch so far) and ``close_no``, the closes since then.

    One shuffle by key and one sort: both running values share the window.
    """
    w = Window.partitionBy(*KEY).orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumn("_closes", F.count_if(F.col("op").isin(*CLOSES)).over(w))
    e = e.withColumn("_last", F.max(F.when(F.col("op") == "fetch", F.struct("ts", "seq", "_closes"))).over(w))
    return _leased(e, F.col("_closes"))


def with_segments(e: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with ``_b``, the segment of time they lie in; segments of a key sort by time as texts.

    An hour is a segment unless it holds more than ``hot_rows`` rows of its key: then its minutes are, and so
    on down to the microsecond.  Each step counts, with map-side combine, only the rows of segments just split, and its
    outcome depends on the counts alone.  Rows without a time are the first segment.
    """
    text = F.coalesce(F.col("ts").cast("string"), F.lit(""))
    e = e.withColumn("_b", F.substring(text, 1, GRAINS[0])).withColumn("_split", F.lit(True))
    for finer in GRAINS[1:]:
        rows = e.where("_split").groupBy(*KEY, "_b").agg(F.count(F.lit(1)).alias("_rows"))
        full = materialize(rows.where(F.col("_rows") > hot_rows).select(*KEY, "_b"))  # at most (rows / hot_rows)
        n = full.count()
        if not n:
            break
        full = full.withColumn("_full", F.lit(True))
        e = (e.drop("_split").join(F.broadcast(full) if n <= HOT_KEYS else full, [*KEY, "_b"], "left")
             .withColumn("_split", F.col("_full").isNotNull()).drop("_full")
             .withColumn("_b", F.when(F.col("_split"), F.substring(text, 1, finer)).otherwise(F.col("_b"))))
    return e.drop("_split")


def _with_leases_by_time(e: DataFrame, hot_rows: int) -> DataFrame:
    """``_with_leases`` for keys too large for one task: a segmented scan.

    Per (key, segment of time) the number of closes and the last fetch are
    aggregates; what earlier segments leave is a window over those one-row
    summaries; only the running values inside a segment are a window over its rows.
    """
    e = with_segments(e, hot_rows)
    inside = Window.partitionBy(*KEY, "_b").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumn("_c", F.count_if(F.col("op").isin(*CLOSES)).over(inside))
    e = e.withColumn("_in", F.max(F.when(F.col("op") == "fetch", F.struct("ts", "seq", "_c"))).over(inside))
    per = e.groupBy(*KEY, "_b").agg(F.max("_c").alias("_n"), F.max("_in").alias("_l"))
    upto = Window.partitionBy(*KEY).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    whole = lambda c: F.when(F.col(c).isNotNull(), F.struct(
        F.col(f"{c}.ts").alias("ts"), F.col(f"{c}.seq").alias("seq"), (F.col("_before") + F.col(f"{c}._c")).alias("_closes")))
    carry = per.select(*KEY, "_b", "_before", F.max(whole("_l")).over(upto).alias("_carry"))
    e = e.join(carry, [*KEY, "_b"]).withColumn("_last", F.coalesce(whole("_in"), F.col("_carry")))
    return _leased(e, F.col("_before") + F.col("_c"))


def _leased(e: DataFrame, closes: Column) -> DataFrame:
    lease = F.struct(F.col("_last.ts").alias("ts"), F.col("_last.seq").alias("seq"))
    return e.select(*KEY, "consumer_id", "op", "ts", "seq", F.when(F.col("_last").isNotNull(), lease).alias("lease"),
                    (closes - F.col("_last._closes")).alias("close_no"))


def leases(log: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The log with the lease that each row falls under; only keys found hot are split by time.

    The count per key is one pass with map-side combine; usually no key is hot
    and the rest is one scan, one shuffle and one sort.
    """
    e = log.select(*KEY, "consumer_id", "op", "ts", "seq")
    hot = e.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows).select(*KEY)
    hot = materialize(hot)  # at most (rows of the log / hot_rows) keys
    keys = hot.count()
    if not keys:
        return _with_leases(e)
    if keys <= HOT_KEYS:
        hot = F.broadcast(hot)
    return _with_leases(e.join(hot, KEY, "left_anti")).unionByName(_with_leases_by_time(e.join(hot, KEY, "left_semi"), hot_rows))


def match_acks(
    log: DataFrame,
    visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every ack/nack with ``matched`` and the lease (fetch) it refers to.

    The lease of a close is the latest fetch before it; the close is matched
    when it is the first close of that lease and the lease was still open.
    """
    first = (F.col("close_no") == 1) & _lease_open(F.col("lease.ts"), F.col("ts"), visibility_timeout)
    return leases(log.where(F.col("op").isin("fetch", *CLOSES)), hot_rows).where(F.col("op") != "fetch").select(
        *KEY, "consumer_id", "op", "ts", "seq", F.col("lease.ts").alias("lease_ts"), F.col("lease.seq").alias("lease_seq"),
        F.coalesce(first, F.lit(False)).alias("matched"))


def delivery_state(
    log: DataFrame,
    as_of: datetime | None = None,
    visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS,
    max_retries: int = MAX_RETRIES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """State of every message key as of ``as_of`` (default: latest log time).

    ready | in_flight | acked | redeliver | dead_letter, plus the number of
    deliveries (fetches) and the open/expired lease's fetch time.

    One aggregation by key over the log with its leases, which is already
    partitioned by key: no further shuffle.
    """
    if as_of is None:
        as_of = log.agg(F.max("ts")).first()[0]
    at = F.lit(as_of).cast("timestamp_ntz")
    is_fetch = F.col("op") == "fetch"
    first_close = F.when(F.col("op").isin(*CLOSES) & (F.col("close_no") == 1), F.struct("lease", "ts", "seq", "op"))
    s = leases(log.where(F.col("ts") <= at), hot_rows).groupBy(*KEY).agg(
        F.max(F.when(is_fetch, F.struct("ts", "seq"))).alias("last_fetch"),
        F.count_if(is_fetch).alias("deliveries"),
        F.max(first_close).alias("closed_by"),
    )
    lf_ts = F.col("last_fetch.ts")
    closed = F.coalesce((F.col("closed_by.lease") == F.col("last_fetch"))
                        & _lease_open(lf_ts, F.col("closed_by.ts"), visibility_timeout), F.lit(False))
    state = (
        F.when(F.col("last_fetch").isNull(), F.lit("ready"))
        .when(closed & (F.col("closed_by.op") == "ack"), F.lit("acked"))
        .when(closed, F.lit("ready"))
        .when(_lease_open(lf_ts, at, visibility_timeout), F.lit("in_flight"))
        .when(F.col("deliveries") >= max_retries, F.lit("dead_letter"))
        .otherwise(F.lit("redeliver"))
    )
    return s.select(*KEY, state.alias("state"), F.col("deliveries"), lf_ts.alias("last_fetch_ts"))


def lease_outcomes(
    log: DataFrame,
    as_of: datetime | None,
    visibility_timeout: int = VISIBILITY_TIMEOUT_SECONDS,
    max_retries: int = MAX_RETRIES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every lease of the log: fetch_ts, fetch_seq, deliveries (fetches of its key so far), expires, ``ended``.

    ``ended``: closed, refetched (a later fetch came while it was open), or
    null: it ran out, or will at ``expires``.  ``as_of`` leaves out later rows.
    """
    e = log if as_of is None else log.where(F.col("ts") <= F.lit(as_of).cast("timestamp_ntz"))
    l = leases(e.where(F.col("op").isin("fetch", *CLOSES)), hot_rows)  # noqa: E741
    first = F.when((F.col("op") != "fetch") & (F.col("close_no") == 1), F.col("ts"))
    per = (l.where(F.col("lease").isNotNull()).groupBy(*KEY, "lease").agg(F.min(first).alias("close_ts"))
           .select(*KEY, F.col("lease.ts").alias("fetch_ts"), F.col("lease.seq").alias("fetch_seq"), "close_ts"))
    w = Window.partitionBy(*KEY).orderBy("fetch_ts", "fetch_seq")
    per = per.withColumn("deliveries", F.row_number().over(w).cast("bigint")).withColumn("_next", F.lead("fetch_ts").over(w))
    open_at = lambda at: F.coalesce(_lease_open(F.col("fetch_ts"), at, visibility_timeout), F.lit(False))
    ended = F.when(open_at(F.col("close_ts")), F.lit("closed")).when(open_at(F.col("_next")), F.lit("refetched"))
    return per.select(
        *KEY, "fetch_ts", "fetch_seq", "deliveries", whole_seconds(add_seconds("fetch_ts", visibility_timeout)).alias("expires"),
        ended.alias("ended"),
        F.when(F.col("deliveries") >= max_retries, F.lit("dead_letter")).otherwise(F.lit("redeliver")).alias("outcome"))


def dead_letters(states: DataFrame) -> DataFrame:
    return states.where(F.col("state") == "dead_letter")


def expired_leases(states: DataFrame) -> DataFrame:
    """Leases that ran out without an ack/nack (requeued or dead-lettered)."""
    return states.where(F.col("state").isin("redeliver", "dead_letter"))


def queue_stats(states: DataFrame, log: DataFrame) -> DataFrame:
    """Per (topic, consumer_group): ready depth, in-flight (pending), acked,
    dead letters, and the number of distinct consumers that fetched (0 for a
    group without a fetch)."""
    s = states.groupBy("topic", "consumer_group").agg(*_depths())
    c = (
        log.where(F.col("op") == "fetch")
        .groupBy("topic", "consumer_group")
        .agg(F.count_distinct("consumer_id").alias("consumers"))
    )
    return s.join(c, ["topic", "consumer_group"], "left").select(
        "topic", "consumer_group", "queue_depth", "pending", "acked", "dead_letters",
        F.coalesce(F.col("consumers"), F.lit(0)).alias("consumers"),
    )


def topic_depth(states: DataFrame) -> DataFrame:
    """Per topic and, as topic ``*``, over all: groups, ready depth, pending, acked, dead letters."""
    per = states.groupBy("topic", "consumer_group").agg(*_depths())
    out = per.rollup("topic").agg(
        F.count(F.lit(1)).alias("groups"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("queue_depth", "pending", "acked", "dead_letters")])
    return out.withColumn("topic", F.coalesce("topic", F.lit("*")))


def _depths() -> list[Column]:
    state = F.col("state")
    return [F.count_if(state.isin("ready", "redeliver")).alias("queue_depth"),
            F.count_if(state == "in_flight").alias("pending"), F.count_if(state == "acked").alias("acked"),
            F.count_if(state == "dead_letter").alias("dead_letters")]
