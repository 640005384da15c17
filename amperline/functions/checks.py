"""Predicates for text fields that arrive from outside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from amperline.functions.times import parse_time

# The accepted shapes of a sensor name and of a date-time.
# ``\z`` and not ``$``, which would let a trailing newline pass.
SENSOR_NAME = r"^sensor-[a-z0-9-]+\z"
DATETIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})\z"


def matches(text: Column, pattern: str) -> Column:
    """True or false, never null."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def name_ok(text: Column) -> Column:
    return matches(text, SENSOR_NAME)


def datetime_ok(text: Column) -> Column:
    """Shape and calendar both have to hold: February 30th has the shape only."""
    return matches(text, DATETIME) & parse_time(text).isNotNull()


def codes(*rules: tuple[str, Column]) -> Column:
    """Codes of the rules whose condition is true, as an array.

    ``array_except`` drops the nulls within generated code, which a lambda
    filter would leave.
    """
    found = F.array(*[F.when(broken, F.lit(code)) for code, broken in rules])
    return F.array_except(found, F.array(F.lit(None).cast("string")))
