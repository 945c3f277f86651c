"""Write time and time-to-live of stored cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.types import parse_text

WRITE_TIME = "_writetime"
EXPIRES_AT = "_expires_at"
WRITTEN = "_written"

# Time-to-live units and their length in seconds.
TTL_UNITS = {"Seconds": 1, "Minutes": 60, "Hours": 3600, "Days": 86400}


def writetime(write_time: Column | str = WRITE_TIME) -> Column:
    """Microseconds of the write that won (bigint)."""
    c = F.col(write_time) if isinstance(write_time, str) else write_time
    return c.cast("bigint")


def to_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone."""
    return F.unix_micros(ts.cast("timestamp"))


def ttl(as_of: Column, expires_at: Column | str = EXPIRES_AT) -> Column:
    """Whole seconds a cell has left at ``as_of`` (int); null if it never expires or already has."""
    c = F.col(expires_at) if isinstance(expires_at, str) else expires_at
    left = to_micros(c) - to_micros(as_of)
    return F.when(left > 0, F.call_function("div", left, F.lit(1000000)).try_cast("int"))


def ttl_seconds(value: Column, unit: Column) -> Column:
    """Seconds of a time-to-live setting (bigint).

    No unit gives -1; blank, negative and non-numeric values give null (ignored).
    """
    # digits only: blanks around a number make it unreadable, as a sign in front ignores it
    digits = F.when(F.rlike(value, F.lit("^[+]?[0-9]+$")), value)
    number = parse_text(digits, T.IntegerType()).cast("bigint")
    seconds = F.when(unit == "None", F.lit(-1).cast("bigint"))
    for name, size in TTL_UNITS.items():
        seconds = seconds.when(unit == name, number * F.lit(size))
    return F.when(number.isNotNull(), seconds)


def expiry(write_time: Column, seconds: Column) -> Column:
    """Instant a cell written at ``write_time`` (µs) expires; null unless ``seconds`` > 0."""
    return F.when(seconds > 0, F.timestamp_micros(expiry_micros(write_time, seconds)))


def expiry_micros(write_time: Column, seconds: Column) -> Column:
    """The same as epoch microseconds; null where they leave the range of a bigint."""
    return F.try_add(write_time, F.try_multiply(seconds.cast("bigint"), F.lit(1000000).cast("bigint")))
