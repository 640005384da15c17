"""Natural keys of readings and cases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a stored reading lives for 30 days after its write.
RETENTION_SECONDS = 30 * 24 * 60 * 60


def reading_key(timestamp: Column, reading_type: Column) -> Column:
    """Sort key of a reading within its sensor."""
    return F.concat_ws("#", timestamp, reading_type)


def expiry_seconds(written: Column) -> Column:
    return F.unix_seconds(written) + F.lit(RETENTION_SECONDS)


def case_key(sensor: Column, timestamp: Column, reading_type: Column) -> Column:
    """Key of a case, null where one of the three parts is null or empty."""
    parts = [F.nullif(part, F.lit("")) for part in (sensor, timestamp, reading_type)]
    return F.concat(parts[0], F.lit("#"), parts[1], F.lit("#"), parts[2])
