"""Event-time column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def millis_to_timestamp(c: Column | str) -> Column:
    """Epoch milliseconds (long) to a timestamp."""
    return F.timestamp_millis(_c(c))


def timestamp_to_millis(c: Column | str) -> Column:
    """Timestamp (with or without zone) to epoch milliseconds, floored."""
    return F.unix_millis(_c(c).cast("timestamp"))


_EPOCH_LOCAL = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def local_time_to_millis(c: Column | str) -> Column:
    """TIMESTAMP_NTZ (wall clock, read as UTC) to epoch milliseconds.

    Zone-free: unlike a cast to TIMESTAMP it does not depend on the
    session time zone (or its daylight-saving jumps)."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_LOCAL), _c(c)) / 1000) \
        .cast("long")


def local_time_to_micros(c: Column | str) -> Column:
    """TIMESTAMP_NTZ to epoch microseconds, zone-free."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_LOCAL), _c(c))


def millis_to_local_time(c: Column | str) -> Column:
    """Epoch milliseconds to TIMESTAMP_NTZ (UTC wall clock), zone-free."""
    return F.timestamp_add("MILLISECOND", _c(c), F.expr(_EPOCH_LOCAL))


def as_event_time(c: Column | str) -> Column:
    """A timestamp usable by ``withWatermark`` (which refuses TIMESTAMP_NTZ).

    Sessions run in UTC, so the wall-clock value is kept.
    """
    return _c(c).cast("timestamp")


def as_local_time(c: Column | str) -> Column:
    """Back to TIMESTAMP_NTZ for results compared with zone-less engines."""
    return _c(c).cast("timestamp_ntz")


# Microseconds per duration unit.
_MICROS = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
           "hour": 3_600_000_000, "day": 86_400_000_000}


def duration_micros(spec: str) -> int:
    """``'30 minutes'`` -> 1_800_000_000."""
    n, unit = spec.split()
    return int(float(n) * _MICROS[unit.lower().rstrip("s")])


def interval(spec: str) -> Column:
    """``'30 minutes'`` -> an interval literal usable in arithmetic."""
    return F.expr(f"INTERVAL {spec}")
