"""Time carried in version-1 UUID text, decoded with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 100 ns ticks from 1582-10-15 to 1970-01-01, and ticks per millisecond.
EPOCH_TICKS = 122192928000000000
TICKS_PER_MS = 10000
VERSION_1 = "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-1[0-9A-Fa-f]{3}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"


def unix_timestamp_of(uuid: Column) -> Column:
    """Epoch milliseconds of a version-1 UUID (bigint); null for other versions and other text."""
    digits = F.concat(F.substring(uuid, 16, 3), F.substring(uuid, 10, 4), F.substring(uuid, 1, 8))
    ticks = F.conv(digits, 16, 10).cast("bigint") - F.lit(EPOCH_TICKS)
    # div truncates: take the remainder off first, so instants before 1970 round down too
    whole = ticks - F.pmod(ticks, F.lit(TICKS_PER_MS))
    millis = F.call_function("div", whole, F.lit(TICKS_PER_MS))
    # the pattern comes first: digits of other text must not be read at all
    return F.when(F.rlike(uuid, F.lit(VERSION_1)), millis)


def date_of(uuid: Column) -> Column:
    """Instant of a version-1 UUID, to the millisecond."""
    return F.timestamp_millis(unix_timestamp_of(uuid))


def time_uuid(ts: Column, node: str = "0242ac120002", clock: str = "8000") -> Column:
    """Version-1 UUID text for an instant; the inverse of :func:`date_of` to the microsecond."""
    ticks = F.unix_micros(ts.cast("timestamp")) * F.lit(10) + F.lit(EPOCH_TICKS)
    digits = F.lower(F.lpad(F.hex(ticks), 15, "0"))
    return F.concat_ws(
        "-",
        F.substring(digits, 8, 8),
        F.substring(digits, 4, 4),
        F.concat(F.lit("1"), F.substring(digits, 1, 3)),
        F.lit(clock),
        F.lit(node),
    )
