"""Time expressions. Stored action times have an unpadded hour: ``2021-01-27 4:34:30``."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text format of stored action times.
ACTION_TIME_FORMAT = "yyyy-MM-dd H:mm:ss"

SECONDS_PER_DAY = 86_400


def parse_action_time(text: Column) -> Column:
    """Text to timestamp without zone; accepts padded and unpadded hours."""
    return F.to_timestamp_ntz(text, F.lit(ACTION_TIME_FORMAT))


def format_action_time(time: Column) -> Column:
    return F.date_format(time, ACTION_TIME_FORMAT)


def time_earlier(left: Column, right: Column) -> Column:
    """True when the first stored time is strictly before the second."""
    return parse_action_time(left) < parse_action_time(right)


def time_parts(text: Column) -> Column:
    """Array of the six text parts (year, month, day, hour, minute, second)."""
    return F.split(text, "[- :]")


def wall_seconds(time: Column) -> Column:
    """Whole seconds of the wall clock since 1970, whatever the session time zone."""
    return (
        F.unix_date(F.to_date(time)).cast("bigint") * SECONDS_PER_DAY
        + F.hour(time) * 3600
        + F.minute(time) * 60
        + F.second(time)
    )


def wall_micros(time: Column) -> Column:
    """Microseconds of the wall clock since 1970, whatever the session time zone."""
    fraction = F.date_part(F.lit("SECOND"), time) - F.second(time)
    return wall_seconds(time) * 1_000_000 + (fraction * 1_000_000).cast("bigint")


def use_order(time: Column, number: Column | None = None) -> Column:
    """One number in the order of time, then of a 64-bit number: a fixed-width key, which
    hash aggregates can keep where a struct would need a sort."""
    key = wall_micros(time).cast("decimal(18,0)") * F.lit(Decimal(10**20)).cast("decimal(21,0)")
    if number is None:
        return key.cast("decimal(38,0)")
    shifted = number.cast("decimal(19,0)") + F.lit(Decimal(2**63)).cast("decimal(19,0)")
    return (key.cast("decimal(38,0)") + shifted).cast("decimal(38,0)")


def elapsed_seconds(start: Column, end: Column, wrap_day: bool = False) -> Column:
    """Seconds from ``start`` to ``end``; ``wrap_day`` drops whole days."""
    seconds = wall_seconds(end) - wall_seconds(start)
    return F.pmod(seconds, F.lit(SECONDS_PER_DAY).cast("bigint")) if wrap_day else seconds
