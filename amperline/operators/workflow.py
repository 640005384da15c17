"""Alert workflow: acknowledgement wait, escalation, execution status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wait for an acknowledgement, and the limit of a whole execution.
WAIT_MS = 15 * 60 * 1000
TIMEOUT_MS = 60 * 60 * 1000


def ack_escalation(alerts: DataFrame, acks: DataFrame, wait_ms: int = WAIT_MS) -> DataFrame:
    """Each alert with its first acknowledgement in time, and whether it escalates.

    ``alerts`` has ``case_pk`` and ``notified_ms``, when the notice was sent: the wait starts there, however late the
    reading came.  Acknowledgements are reduced to the earliest usable one per case and alert
    before they are attached; an alert has one row however often it was acked.
    """
    in_time = (
        alerts.select("case_pk", "notified_ms")
        .join(acks, "case_pk")
        .where(F.col("ack_ms").between(F.col("notified_ms"), F.col("notified_ms") + wait_ms))
        .groupBy("case_pk")
        .agg(F.min("ack_ms").alias("ack_ms"))
    )
    joined = alerts.join(in_time, "case_pk", "left")
    return joined.withColumn("escalated", F.col("ack_ms").isNull()).withColumn(
        "escalated_ms", F.when(F.col("escalated"), F.col("notified_ms") + wait_ms)
    )


def escalations(waited: DataFrame) -> DataFrame:
    """Alerts nobody acknowledged in time, as escalated alerts."""
    return waited.where("escalated").withColumn("alert_ms", F.col("escalated_ms"))


def execution_status(runs: DataFrame, as_of_ms: int, timeout_ms: int = TIMEOUT_MS) -> DataFrame:
    """Status and stop time of each execution as of a moment.

    An execution fails at once on invalid input, is aborted if someone stops it,
    runs out of time, or succeeds when its wait is over.
    """
    ends = runs.withColumn(
        "end_ms",
        F.when(F.col("invalid_input"), F.col("start_ms")).otherwise(
            F.least(
                F.col("aborted_ms"), F.col("start_ms") + timeout_ms, F.col("start_ms") + F.col("wait_ms")
            )
        ),
    )
    over = F.col("end_ms") <= as_of_ms
    how = (
        F.when(F.col("invalid_input"), F.lit("FAILED"))
        .when(F.col("end_ms") == F.col("aborted_ms"), F.lit("ABORTED"))
        .when(F.col("start_ms") + F.col("wait_ms") <= F.col("end_ms"), F.lit("SUCCEEDED"))
        .otherwise(F.lit("TIMED_OUT"))
    )
    return ends.where(F.col("start_ms") <= as_of_ms).select(
        "name",
        "start_ms",
        F.when(over, F.col("end_ms")).alias("stop_ms"),
        F.when(over, how).otherwise(F.lit("RUNNING")).alias("status"),
    )
