"""Wall-clock arithmetic in microseconds.

Local times are ``timestamp_ntz``.  Range frames and grid steps want numbers, so
the one conversion between the two lives here; sessions run in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR
STEP = 5 * MINUTE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock time."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def from_micros(us) -> Column:
    """Inverse of :func:`micros`."""
    return F.timestamp_micros(_c(us).cast("bigint")).cast("timestamp_ntz")


def shift_minutes(ts, minutes) -> Column:
    """Time moved by a number of minutes; null if either is null."""
    return from_micros(micros(ts) + _c(minutes).cast("bigint") * F.lit(MINUTE))


def floor_to(us, width: int = STEP) -> Column:
    """Microseconds rounded down to a multiple of ``width``."""
    u = _c(us)
    return u - F.pmod(u, F.lit(width))


def floor_5min(ts) -> Column:
    """Time with seconds dropped and minute lowered to a multiple of five."""
    return from_micros(floor_to(micros(ts)))


def bucket(us, width: int = DAY) -> Column:
    """Number of the fixed-width bucket (a day unless said otherwise) holding a time."""
    u = _c(us)
    return ((u - F.pmod(u, F.lit(width))) / F.lit(width)).cast("bigint")
