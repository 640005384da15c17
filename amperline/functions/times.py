"""Time columns.  All of them assume the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(text: Column) -> Column:
    """Instant of an ISO date-time, null where it is not one."""
    return F.try_to_timestamp(text)


def iso_text(ts: Column) -> Column:
    """``2024-01-31T10:20:30.456Z``; digits beyond milliseconds are cut."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def from_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def minute_ms(ms: Column) -> Column:
    """Start of the minute that holds an epoch-millisecond value."""
    return ms - F.pmod(ms, F.lit(60_000))
