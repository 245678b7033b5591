"""Driver-side twins of the time scalars, for literal request parameters."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from telemetry_engine.functions.timeutil import RFC3339_REGEX


def parse_rfc3339_py(s: str) -> datetime | None:
    """Strict RFC 3339 -> naive UTC datetime (microseconds), else None."""
    m = re.fullmatch(RFC3339_REGEX, s or "")
    if not m:
        return None
    date, clock, frac, zone = m.group(1), m.group(2), m.group(3) or "", m.group(4)
    try:
        local = datetime.strptime(f"{date} {clock}", "%Y-%m-%d %H:%M:%S")
    except ValueError:
        return None
    if frac:
        local = local.replace(microsecond=int(frac[1:7].ljust(6, "0")))
    if zone == "Z":
        return local
    hh, mm = int(zone[1:3]), int(zone[4:6])
    if hh >= 24 or mm >= 60:
        return None
    off = timedelta(hours=hh, minutes=mm)
    try:
        return local - off if zone[0] == "+" else local + off
    except OverflowError:
        return None


def format_rfc3339_nano_py(ts: datetime) -> str:
    """Naive UTC datetime -> RFC 3339 with the shortest exact fraction + 'Z'."""
    s = ts.strftime("%Y-%m-%dT%H:%M:%S")
    if ts.microsecond:
        s += ("." + f"{ts.microsecond:06d}").rstrip("0")
    return s + "Z"
