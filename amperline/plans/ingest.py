"""The batch form of ingest: route, validate, drop copies, keep first writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from amperline.operators.dedup import drop_redelivered, first_writes
from amperline.operators.validation import rejected_rows, valid_rows, validate
from amperline.sources.stores import with_keys
from amperline.sources.telemetry import route


@dataclass(frozen=True)
class Ingest:
    """The frames of one ingest run; all lazy, nothing is cached."""

    checked: DataFrame
    valid: DataFrame
    rejected: DataFrame
    writes: DataFrame
    kept: DataFrame


def ingest(raw: DataFrame) -> Ingest:
    """Split raw records into kept readings, duplicates and rejects.

    Layer one drops redelivered sequence numbers, layer two keeps the first
    write of a natural key; only the second kind is counted as a duplicate.
    """
    checked = validate(route(raw), sensor="partition_key")
    valid = valid_rows(checked)
    writes = drop_redelivered(valid)
    return Ingest(checked, valid, rejected_rows(checked), writes, with_keys(first_writes(writes)))
