"""Dispatch of alerts to channels: fan-out, skip reasons, outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.operators.payloads import channel_subject

# Channels that have a handler.  The list is part of the plan, so adding a
# channel means adding its name.
HANDLERS = ("email", "sms")
# Fixed value: where the stand-in for sms keeps its log.
SMS_LOG = "https://example-sms.invalid/log/"
# Fixed value: reserved test number used where no recipient is set.
TEST_PHONE = "+15555550100"


def selected_channels(plans: DataFrame, channels: Sequence[str] = ("email", "sms")) -> DataFrame:
    """One row per alert and selected channel."""
    chosen = F.array_except(
        F.array(*[F.when(F.col(c), F.lit(c)) for c in channels]),
        F.array(F.lit(None).cast("string")),
    )
    return plans.withColumn("channel", F.explode(chosen))


def channel_input(df: DataFrame) -> DataFrame:
    """What the channel's adapter receives."""
    channel = F.col("channel")
    email, sms = channel == "email", channel == "sms"
    subject = channel_subject(F.col("severity"), F.col("sensorId"), F.col("readingType"))
    return df.select(
        "*",
        F.when(email, subject).alias("subject"),
        F.when(sms, F.lit(TEST_PHONE)).alias("phone_number"),
        F.when(email | sms, F.col("narrative")).alias("body"),
    )


def dispatch_outcomes(attempts: DataFrame, handlers: Sequence[str] = HANDLERS) -> DataFrame:
    """Delivered, failed or skipped for every attempt.

    ``adapter_status`` tells what the adapter answers if it is called.  The
    first delivery of a case and channel is found by an aggregate, so a case
    with endless retries is no single group; later attempts are skipped.
    """
    known = ", ".join(f"'{name}'" for name in handlers)
    reasoned = attempts.selectExpr(
        "*",
        f"""CASE WHEN coalesce(narrative, '') = '' THEN 'narrative_missing'
          WHEN channel NOT IN ({known}) THEN 'no_handler_registered' END AS early""",
    )
    first = (
        reasoned.where("early IS NULL AND adapter_status = 'delivered'")
        .groupBy("case_pk", "channel")
        .agg(F.min("attempt_no").alias("delivered_at"))
    )
    joined = reasoned.join(first, ["case_pk", "channel"], "left")
    sent = joined.selectExpr(
        "*",
        """coalesce(early, if(attempt_no > delivered_at, 'retry_already_delivered', NULL))
          AS skip_reason""",
    ).selectExpr("*", "if(skip_reason IS NULL, adapter_status, 'skipped') AS kind")
    # A stand-in adapter has no outside id: its own is made from the case and
    # the attempt, so equal attempts get equal ids.
    identified = sent.selectExpr(
        "*",
        """CASE kind WHEN 'failed' THEN '' WHEN 'delivered' THEN if(channel = 'sms',
            concat('MOCK-sms-', cast(attempt_ms AS string), '-',
              substring(sha2(concat(case_pk, '#', channel), 256), 1, 6)),
            concat('msg-', substring(sha2(concat(case_pk, '#', cast(attempt_no AS string)), 256), 1, 12)))
          END AS case_id""",
    )
    return identified.selectExpr(
        "case_pk", "channel", "attempt_no", "attempt_ms", "severity", "kind", "skip_reason", "case_id",
        f"if(kind = 'delivered' AND channel = 'sms', concat('{SMS_LOG}', case_id), NULL) AS external_url",
        "if(kind = 'failed', error, NULL) AS error",
        "if(kind = 'skipped', NULL, latency_ms) AS latency_ms",
    )


def dispatch_summary(outcomes: DataFrame) -> DataFrame:
    """Per alert attempt, the channels that were delivered, failed and skipped.

    The sets hold channel names, so their size is bounded by the channels.
    """
    def names(kind: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("channel"))))

    return outcomes.groupBy("case_pk", "attempt_no").agg(
        names("delivered").alias("delivered"),
        names("failed").alias("failed"),
        names("skipped").alias("skipped"),
    )
