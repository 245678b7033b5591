"""Device history: validation, point query, bulk (table of requests) query.

Point query: a filtered, ordered, limited scan.  With a telemetry table
partitioned by ``event_date`` and sorted by (gpu_uuid, timestamp) inside each
partition, the uuid/time predicates become PushedFilters + partition pruning
and the ordered limit plans as TakeOrderedAndProject.

Bulk query: requests are validated as columns and answered in branches (with or
without limit, start, end), each joined to telemetry on gpu_uuid with its own
date pruning and the time range as a residual predicate; limited branches are
cut with a two-stage (salted) top-k so a device holding a large share of all
rows is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_engine.functions.scalars import blank_to_empty, parse_int, uuid_is_valid
from telemetry_engine.functions.timeutil import EPOCH_NTZ, parse_rfc3339
from telemetry_engine.functions.pytime import parse_rfc3339_py
from telemetry_engine.schemas import HISTORY_MAX_LIMIT, UUID_PATTERN
from telemetry_engine.session import materialize

API_COLUMNS = ["gpu_uuid", "metric_name", "value", "timestamp", "labels_raw"]


def newest_first() -> list:
    """Newest first; seq breaks ties (a whole batch shares one timestamp)."""
    return [F.col("timestamp").desc(), F.col("seq").desc()]


# Spark's default for the greatest limit that it pushes below a window's shuffle.
SMALL_LIMIT = 1000


class HistoryRequestError(ValueError):
    """A history request was rejected; ``code`` is one of the status values."""

    def __init__(self, code: str, message: str = ""):
        super().__init__(f"{code}: {message}" if message else code)
        self.code = code


@dataclass(frozen=True)
class HistoryFilter:
    start: datetime | None = None
    end: datetime | None = None
    limit: int | None = None


def validate_request(uuid: str, start_time: str = "", end_time: str = "", limit: str = "") -> HistoryFilter:
    """Driver-side validation of one request, fixed precedence.

    uuid present -> uuid format -> start -> end -> start <= end -> limit
    integer -> limit >= 1 -> limit <= 10000.  Existence is checked later.
    """
    import re

    if not uuid:
        raise HistoryRequestError("missing_uuid", "no device named")
    if not re.fullmatch(UUID_PATTERN, uuid):
        raise HistoryRequestError("invalid_uuid", uuid)
    start = end = None
    if start_time:
        start = parse_rfc3339_py(start_time)
        if start is None:
            raise HistoryRequestError("invalid_start", start_time)
    if end_time:
        end = parse_rfc3339_py(end_time)
        if end is None:
            raise HistoryRequestError("invalid_end", end_time)
    if start is not None and end is not None and start > end:
        raise HistoryRequestError("invalid_range", f"{start_time} .. {end_time}")
    n = None
    if limit:
        if not re.fullmatch(r"[+-]?[0-9]+", limit):
            raise HistoryRequestError("invalid_limit", limit)
        n = int(limit)
        if n < 1 or n > HISTORY_MAX_LIMIT:
            raise HistoryRequestError("invalid_limit", limit)
    return HistoryFilter(start, end, n)


def _time_predicates(df: DataFrame, start, end) -> list:
    preds = []
    has_date = "event_date" in df.columns
    if start is not None:
        preds.append(F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
        if has_date:
            preds.append(F.col("event_date") >= F.lit(start.date()))
    if end is not None:
        preds.append(F.col("timestamp") <= F.lit(end).cast("timestamp_ntz"))
        if has_date:
            preds.append(F.col("event_date") <= F.lit(end.date()))
    return preds


def device_history(
    telemetry: DataFrame,
    uuid: str,
    start_time: str = "",
    end_time: str = "",
    limit: str | int = "",
    devices: DataFrame | None = None,
) -> DataFrame:
    """Rows of one device, newest first, time range inclusive on both ends.

    Raises HistoryRequestError for invalid input and, when ``devices`` is
    given, ``not_found`` for an unknown device (distinct from empty history).
    """
    f = validate_request(uuid, start_time, end_time, str(limit) if limit != "" else "")
    if devices is not None and devices.where(F.col("uuid") == uuid).limit(1).count() == 0:
        raise HistoryRequestError("not_found", uuid)
    df = telemetry.where(F.col("gpu_uuid") == uuid)
    for p in _time_predicates(telemetry, f.start, f.end):
        df = df.where(p)
    df = df.orderBy(*newest_first())
    if f.limit is not None:
        df = df.limit(f.limit)
    return df.select(*API_COLUMNS)


def validate_requests(requests: DataFrame) -> DataFrame:
    """Columnar twin of :func:`validate_request`.

    Adds start_ts, end_ts, limit_n and ``status`` (null when the request is
    valid; existence is decided by :func:`request_status`).
    """
    u = blank_to_empty("uuid")
    s = blank_to_empty("start_time")
    e = blank_to_empty("end_time")
    lim = blank_to_empty("limit")
    start_ts = F.when(s != "", parse_rfc3339(s))
    end_ts = F.when(e != "", parse_rfc3339(e))
    limit_n = F.when(lim != "", parse_int(lim))
    out = requests.select(
        "request_id", u.alias("uuid"), start_ts.alias("start_ts"),
        end_ts.alias("end_ts"), limit_n.alias("limit_n"), lim.alias("_lim"),
        s.alias("_s"), e.alias("_e"),
    )
    status = (
        F.when(F.col("uuid") == "", F.lit("missing_uuid"))
        .when(~uuid_is_valid("uuid"), F.lit("invalid_uuid"))
        .when((F.col("_s") != "") & F.col("start_ts").isNull(), F.lit("invalid_start"))
        .when((F.col("_e") != "") & F.col("end_ts").isNull(), F.lit("invalid_end"))
        .when(F.col("start_ts") > F.col("end_ts"), F.lit("invalid_range"))
        .when(
            (F.col("_lim") != "")
            & (F.col("limit_n").isNull() | (F.col("limit_n") < 1) | (F.col("limit_n") > HISTORY_MAX_LIMIT)),
            F.lit("invalid_limit"),
        )
    )
    return out.withColumn("status", status).drop("_lim", "_s", "_e")


def request_status(requests: DataFrame, devices: DataFrame) -> DataFrame:
    """Validate requests and decide not_found / ok for the valid ones.

    The requests are validated once (written to the shared folder), as both the
    lookup and the result read them.  The requested uuids are joined to the
    registry's distinct matches, so a registry with repeated uuids cannot
    multiply requests.
    """
    v = materialize(validate_requests(requests))
    wanted = v.where("status is null").select("uuid").distinct()
    known = devices.select("uuid").join(wanted, "uuid", "left_semi").distinct().withColumn("_found", F.lit(True))
    status = F.coalesce("status", F.when(F.col("_found"), F.lit("ok")).otherwise(F.lit("not_found")))
    return v.join(known, "uuid", "left").withColumn("status", status).select(*v.columns)


@dataclass(frozen=True)
class _Branch:
    """Requests that are answered alike: without a limit (0) or with one up to ``most``, and their time bounds."""

    most: int
    requests: DataFrame
    lo: datetime | None
    hi: datetime | None


def _branches(statuses: DataFrame, by_limit: bool = True) -> list[_Branch]:
    """The non-empty groups of ``ok`` requests by (limit: none, small, large; both time bounds or not).

    One open-ended request leaves the bounds of the others alone, and one large
    limit leaves the early cut of the others alone.  At most six groups, two
    where limits make no difference.
    """
    ok = materialize(statuses.where(F.col("status") == "ok").select(
        "request_id", F.col("uuid").alias("_uuid"), "start_ts", "end_ts", "limit_n"))
    size = F.when(F.col("limit_n").isNull(), 0).when(F.col("limit_n") <= SMALL_LIMIT, 1).otherwise(2) if by_limit else F.lit(0)
    closed = F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull()
    every = lambda c, value: F.when(F.count_if(F.col(c).isNull()) == 0, value)  # noqa: E731  a bound only if all have one
    groups = (ok.groupBy(size.alias("l"), closed.alias("c"))
              .agg(F.coalesce(F.max("limit_n"), F.lit(0)).alias("most"), every("start_ts", F.min("start_ts")).alias("lo"),
                   every("end_ts", F.max("end_ts")).alias("hi")).orderBy("l", "c").collect())
    return [_Branch(g["most"], ok.where((size == g["l"]) & (closed == g["c"])), g["lo"], g["hi"]) for g in groups]


def _within(branch: _Branch, telemetry: DataFrame, columns: list[str]) -> DataFrame:
    """Telemetry within the branch's time bounds, with ``_day``."""
    t = telemetry
    for p in _time_predicates(telemetry, branch.lo, branch.hi):
        t = t.where(p)
    day = F.col("event_date") if "event_date" in telemetry.columns else F.col("timestamp").cast("date")
    return t.select(*columns, day.alias("_day"))


def request_days(branch: _Branch, points: DataFrame) -> DataFrame:
    """The branch's requests once for every day that they need of their device, with its number of points ``_n``.

    One count per (device, day), combined where the points are read.  A day
    that lies between the bounds counts in full, so a limited request needs no
    day older than those that fill its limit.
    """
    wanted = branch.requests.select(F.col("_uuid").alias("gpu_uuid")).distinct()
    days = points.join(wanted, "gpu_uuid", "left_semi").groupBy("gpu_uuid", "_day").agg(F.count(F.lit(1)).alias("_n"))
    r = branch.requests
    first, last = F.col("start_ts").cast("date"), F.col("end_ts").cast("date")
    reach = F.coalesce(F.col("_day") >= first, F.lit(True)) & F.coalesce(F.col("_day") <= last, F.lit(True))
    out = days.join(r, (days.gpu_uuid == r._uuid) & reach).drop("gpu_uuid")
    if branch.most:
        whole = F.coalesce(F.col("_day") > first, F.lit(True)) & F.coalesce(F.col("_day") < last, F.lit(True))
        newer = Window.partitionBy("request_id").orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
        full = F.coalesce(F.sum(F.when(whole, F.col("_n")).otherwise(0)).over(newer), F.lit(0))
        out = out.withColumn("_newer", full).where((F.col("_newer") < F.col("limit_n")) | F.col("limit_n").isNull()).drop("_newer")
    return out


def _matches(branch: _Branch, telemetry: DataFrame, columns: list[str]) -> DataFrame:
    """Telemetry joined to the requests that it answers, by device and day.

    The days join as keys, so what is joined is near the answer however many
    requests share a device, and a device spreads over its days; the ends of a
    request decide only within its first and last day.
    """
    days = request_days(branch, _within(branch, telemetry, ["gpu_uuid"]))
    days = days.select("request_id", "_uuid", F.col("_day").alias("_on"), "start_ts", "end_ts", "limit_n")
    t = _within(branch, telemetry, columns)
    in_time = F.coalesce(t.timestamp >= days.start_ts, F.lit(True)) & F.coalesce(t.timestamp <= days.end_ts, F.lit(True))
    return t.join(days, (t.gpu_uuid == days._uuid) & (t._day == days._on) & in_time, "inner").drop("_day", "_on")


def bulk_history(statuses: DataFrame, telemetry: DataFrame, salts: int | None = None) -> DataFrame:
    """Rows answering every ``ok`` request of ``statuses`` (see request_status).

    Output: request_id + API columns.  Requests without a limit get every
    matching row; limited requests get their newest ``limit_n`` rows.  Requests
    with and without limits and bounds are answered in branches of their own,
    each with its own pruning of dates.
    """
    cols = ["request_id", *API_COLUMNS]
    out = None
    for b in _branches(statuses):
        rows = _matches(b, telemetry, [*API_COLUMNS, "seq"])
        one = (_newest(rows, b.most, salts) if b.most else rows).select(*cols)
        out = one if out is None else out.unionByName(one)
    if out is None:
        kind = statuses.schema["request_id"].dataType
        out = telemetry.where(F.lit(False)).select(F.lit(None).cast(kind).alias("request_id"), *API_COLUMNS)
    return out


def _newest(rows: DataFrame, most: int, salts: int | None) -> DataFrame:
    """The newest ``limit_n`` rows of each request, by a two-stage top-k.

    ``most``, the branch's greatest limit, is a constant bound that lets Spark cut
    each map task's rows before the shuffle (up to its own threshold, ``SMALL_LIMIT``).  Stage 1 spreads a hot request over ``salts``
    tasks (as many as there are shuffle partitions); stage 2 sees at most
    salts * limit survivors of it.
    """
    n = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w1 = Window.partitionBy("request_id", "_salt").orderBy(*newest_first())
    w2 = Window.partitionBy("request_id").orderBy(*newest_first())
    cut = lambda df, w: (df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most)
                         .where(F.col("_r") <= F.col("limit_n")))
    return cut(cut(rows.withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(n))), w1), w2)


FOREVER = "9999-12-31 23:59:59.999999"


def _counts(branch: _Branch, telemetry: DataFrame) -> DataFrame:
    """request_id, ``_n``: matching points, as the difference of two running counts.

    Points become counts per (device, hour), and per time only in hours that
    hold the end of some request; both are combined where the points are read.
    Requests come in as bounds among them: one sweep by (device, hour, time)
    gives every bound the points up to it.  No row stands for a pair of request and
    point, and an hour of a device is the most that one task orders.
    """
    epoch = F.lit(EPOCH_NTZ).cast("timestamp_ntz")
    hour = lambda c: F.timestamp_diff("HOUR", epoch, c)
    r = branch.requests
    ends = F.array(
        F.struct(F.coalesce("end_ts", F.lit(FOREVER).cast("timestamp_ntz")).alias("at"), F.lit(2).alias("kind"), F.lit(1).alias("sign")),
        F.struct(F.col("start_ts").alias("at"), F.lit(0).alias("kind"), F.lit(-1).alias("sign")))
    bounds = r.select("request_id", F.col("_uuid").alias("gpu_uuid"), F.inline(ends)).where("at is not null")
    bounds = materialize(bounds.withColumn("_hour", hour(F.col("at"))))

    points = _within(branch, telemetry, ["gpu_uuid", "timestamp"]).select("gpu_uuid", "timestamp", hour(F.col("timestamp")).alias("_hour"))
    wanted = bounds.select("gpu_uuid").distinct()
    cut = bounds.select("gpu_uuid", "_hour").distinct().withColumn("_cut", F.lit(True))
    points = points.join(wanted, "gpu_uuid", "left_semi").join(cut, ["gpu_uuid", "_hour"], "left")
    none = F.lit(None)
    counts = points.groupBy("gpu_uuid", "_hour", F.when(F.col("_cut"), F.col("timestamp")).alias("at")).agg(F.count(F.lit(1)).alias("_n"))
    line = counts.select("gpu_uuid", "_hour", "at", F.lit(1).alias("kind"), "_n", none.cast(r.schema["request_id"].dataType).alias("request_id"),
                         none.cast("int").alias("sign"))
    line = line.unionByName(bounds.withColumn("_n", F.lit(0).cast("long")))

    upto = Window.partitionBy("gpu_uuid", "_hour").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.withColumn("_upto", F.sum("_n").over(upto))
    hours = line.groupBy("gpu_uuid", "_hour").agg(F.sum("_n").alias("_sum"))
    before = Window.partitionBy("gpu_uuid").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select("gpu_uuid", "_hour", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    ranks = line.where(F.col("sign").isNotNull()).join(hours, ["gpu_uuid", "_hour"])
    return ranks.groupBy("request_id").agg(F.sum(F.col("sign") * (F.col("_before") + F.col("_upto"))).alias("_n"))


def history_totals(statuses: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Per request: status and ``total`` = rows that ``bulk_history`` would return.

    The matches are counted (see ``_counts``) and cut to the limit.  Non-ok
    requests have a null total; ok requests with no rows 0.
    """
    statuses = materialize(statuses)
    counts = None
    for b in _branches(statuses, by_limit=False):
        one = _counts(b, telemetry)
        counts = one if counts is None else counts.unionByName(one)
    total = F.lit(0)
    out = statuses
    if counts is not None:
        out = statuses.join(counts, "request_id", "left")
        total = F.least(F.coalesce(F.col("_n"), F.lit(0)), F.coalesce("limit_n", "_n", F.lit(0)))
    return out.select("request_id", "uuid", "status", F.when(F.col("status") == "ok", total.cast("bigint")).alias("total"))
