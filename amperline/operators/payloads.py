"""Notification payloads, subjects and the publish rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tiers of payloads made without a classification, subject length.
FALLBACK_TIER, ESCALATED_TIER = "P2", "P1"
SUBJECT_LENGTH = 100
ALERT_TOPIC, OPS_TOPIC = "grid-alerts", "ops-alerts"


def threshold_struct() -> Column:
    """The broken bound, null for a reading in range."""
    return F.when(
        F.col("exceeded"),
        F.struct(F.col("broken_min").alias("min"), F.col("broken_max").alias("max")),
    )


def fallback_payload(alerts: DataFrame) -> DataFrame:
    """JSON made from the reading alone; null fields are left out."""
    tier = F.when(F.col("escalated"), F.lit(ESCALATED_TIER)).otherwise(F.lit(FALLBACK_TIER))
    body = F.struct(
        tier.alias("severity"),
        "sensorId", "timestamp", "readingType", "value", "unit", "gridZone",
        threshold_struct().alias("threshold"),
        "details", "escalated",
    )
    return alerts.withColumn("payload", F.to_json(body))


def enriched_payload(alerts: DataFrame) -> DataFrame:
    """JSON with the classification, the plan, the texts and what was dispatched."""
    body = F.struct(
        "severity",
        F.col("confidence").alias("severityConfidence"),
        F.col("reasoning").alias("severityReasoning"),
        "sensorId", "timestamp", "readingType", "value", "unit", "gridZone",
        threshold_struct().alias("threshold"),
        "details",
        F.lit(False).alias("escalated"),
        F.struct(
            F.struct("email", "sms").alias("channels"),
            F.col("override_applied").alias("overrideApplied"),
            F.col("override_reason").alias("overrideReason"),
        ).alias("routing"),
        F.struct(F.col("email_text").alias("email"), F.col("sms_text").alias("sms")).alias("narratives"),
        F.struct("delivered", "failed", "skipped").alias("dispatch"),
    )
    return alerts.withColumn("payload", F.to_json(body))


def alert_subject(tier: Column, sensor: Column, escalated: Column) -> Column:
    prefix = F.when(escalated, F.lit("[P1 ESCALATED]")).otherwise(
        F.concat(F.lit("["), F.coalesce(tier, F.lit(FALLBACK_TIER)), F.lit("]"))
    )
    text = F.concat(prefix, F.lit(" Grid sensor breach: "), sensor)
    return F.substring(text, 1, SUBJECT_LENGTH)


def channel_subject(tier: Column, sensor: Column, reading_type: Column) -> Column:
    text = F.concat(F.lit("["), tier, F.lit("] "), sensor, F.lit(" "), reading_type, F.lit(" breach"))
    return F.substring(text, 1, SUBJECT_LENGTH)


def subjects(classified: DataFrame) -> DataFrame:
    tier, sensor = F.col("severity"), F.col("sensorId")
    return classified.select(
        "*",
        alert_subject(tier, sensor, F.lit(False)).alias("notify_subject"),
        alert_subject(tier, sensor, F.lit(True)).alias("escalation_subject"),
        channel_subject(tier, sensor, F.col("readingType")).alias("channel_subject"),
    )


def alert_outbox(alerts: DataFrame) -> DataFrame:
    """Alerts to publish: those that fell back or were escalated.

    An alert that was enriched has been delivered by the dispatcher already.
    Needs ``used_fallback``, ``escalated`` and ``alert_ms``.
    """
    due = fallback_payload(alerts.where(F.col("used_fallback") | F.col("escalated")))
    return due.select(
        F.lit(ALERT_TOPIC).alias("topic"),
        alert_subject(F.lit(FALLBACK_TIER), F.col("sensorId"), F.col("escalated")).alias("subject"),
        F.col("payload").alias("message"),
        F.col("alert_ms").alias("created_ms"),
    )


def ops_outbox(ops_alerts: DataFrame) -> DataFrame:
    return ops_alerts.select(
        F.lit(OPS_TOPIC).alias("topic"), "subject", "message", F.col("received_ms").alias("created_ms")
    )
