"""Time scalars as Column expressions (all JVM-side, codegen friendly).

Timestamps inside the engine are ``timestamp_ntz`` holding UTC wall time, so
no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 3339 as accepted by a strict parser: date 'T' time, optional fraction,
# then 'Z' or a +hh:mm / -hh:mm offset.  A bare date is rejected.
RFC3339_REGEX = (
    r"([0-9]{4}-[0-9]{2}-[0-9]{2})T([0-9]{2}:[0-9]{2}:[0-9]{2})(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})"
)

EPOCH_NTZ = "1970-01-01 00:00:00"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def matches_whole(s: Column, pattern: str) -> Column:
    """The whole text matches; unlike with ``$``, a final line feed counts."""
    return s.rlike(rf"\A(?:{pattern})\z")


def is_rfc3339(s: Column | str) -> Column:
    s = _c(s)
    return matches_whole(s, RFC3339_REGEX) & parse_rfc3339(s).isNotNull()


def parse_rfc3339(s: Column | str) -> Column:
    """Strict RFC 3339 text -> UTC ``timestamp_ntz``; invalid text -> null.

    One regex guards the strict shape, so the parts have fixed places.  The wall
    time is cast without a zone and the offset, of up to 23:59 hours, taken off by
    arithmetic.  The fraction may be of any length; digits below the microsecond
    are cut.
    """
    s = _c(s)
    zulu = F.endswith(s, F.lit("Z"))
    zone = F.right(s, F.lit(6))
    number = lambda at: F.substring(zone, at, 2).try_cast("int")
    hours, minutes = F.when(zulu, 0).otherwise(number(2)), F.when(zulu, 0).otherwise(number(5))
    fraction = F.substring(s, F.lit(20), F.least(F.lit(7), F.length(s) - 19 - F.when(zulu, 1).otherwise(6)))
    local = F.concat(F.substring(s, 1, 10), F.lit(" "), F.substring(s, 12, 8), fraction).try_cast("timestamp_ntz")
    east = F.when(F.startswith(zone, F.lit("-")) & ~zulu, -1).otherwise(1)
    none = F.lit(0)
    utc = local - F.make_dt_interval(none, none, east * (hours * 60 + minutes), F.lit(0))
    return F.when(matches_whole(s, RFC3339_REGEX) & (hours < 24) & (minutes < 60), utc)


def _text(ts: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` with the shortest exact fraction: the wall time's own text, in no zone."""
    return _c(ts).cast("timestamp_ntz").cast("string")


def format_rfc3339(ts: Column | str) -> Column:
    """UTC timestamp -> ``YYYY-MM-DDTHH:MM:SSZ`` (seconds precision)."""
    t = _text(ts)
    return F.concat(F.substring(t, 1, 10), F.lit("T"), F.substring(t, 12, 8), F.lit("Z"))


def format_rfc3339_nano(ts: Column | str) -> Column:
    """UTC timestamp -> RFC 3339 with the shortest exact fraction.

    Trailing zeros of the fraction are removed, and the dot with them when the
    fraction is zero, then ``Z`` is appended.
    """
    return F.concat(F.translate(_text(ts), " ", "T"), F.lit("Z"))


def format_hour(ts: Column | str) -> Column:
    """``YYYY-MM-DDTHH:00:00Z`` of the hour that holds ``ts``."""
    t = _text(ts)
    return F.concat(F.substring(t, 1, 10), F.lit("T"), F.substring(t, 12, 2), F.lit(":00:00Z"))


def format_micros(ts: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS.ffffff``."""
    t = _text(ts)
    return F.concat(F.substring(t, 1, 19), F.lit("."), F.rpad(F.substring(t, 21, 6), 6, "0"))


def whole_seconds(ts: Column | str) -> Column:
    second = F.extract(F.lit("SECOND"), _c(ts))
    none = F.lit(0)
    return _c(ts) - F.make_dt_interval(none, none, none, second - F.floor(second))


def start_of_day(ts: Column | str) -> Column:
    return _c(ts).cast("date").cast("timestamp_ntz")


def end_of_day(ts: Column | str) -> Column:
    """Last representable instant of the day (23:59:59.999999)."""
    return start_of_day(ts) + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 0.000001 SECOND")


def add_seconds(ts: Column | str, seconds: Column | int) -> Column:
    secs = F.lit(seconds) if isinstance(seconds, int) else seconds
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Signed whole seconds from ``start`` to ``end`` (end - start), of timestamp_ntz values."""
    gap = _c(end) - _c(start)
    part = lambda unit: F.extract(F.lit(unit), gap)
    return (part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60).cast("bigint") + part("SECOND").cast("bigint")
