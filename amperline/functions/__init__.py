"""Column functions shared by the operators."""

from amperline.functions.checks import codes, datetime_ok, matches, name_ok
from amperline.functions.keys import case_key, expiry_seconds, reading_key
from amperline.functions.text import number_literal, number_sql, number_text
from amperline.functions.times import (
    epoch_ms,
    from_ms,
    iso_text,
    minute_ms,
    parse_time,
)

__all__ = [
    "case_key",
    "codes",
    "datetime_ok",
    "epoch_ms",
    "expiry_seconds",
    "from_ms",
    "iso_text",
    "matches",
    "minute_ms",
    "name_ok",
    "number_literal",
    "number_sql",
    "number_text",
    "parse_time",
    "reading_key",
]
