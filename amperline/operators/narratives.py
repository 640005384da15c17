"""Texts for people and models: channel narratives, prompts and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.functions import codes, number_text

# Accepted lengths per channel.
EMAIL_LENGTH = (20, 1200)
SMS_LENGTH = (10, 160)


def zone_text() -> Column:
    return F.coalesce("gridZone", F.lit("unknown"))


def selected_text() -> Column:
    return F.concat_ws(
        ", ", F.when(F.col("email"), F.lit("email")), F.when(F.col("sms"), F.lit("sms"))
    )


def narratives(plans: DataFrame) -> DataFrame:
    """One text per selected channel, null for the others.

    Texts are whole; one that breaks a length rule shows in ``audit_narratives``, and its alert takes the fallback.
    """
    zone = "coalesce(gridZone, 'unknown')"
    selected = "concat_ws(', ', if(email, 'email', NULL), if(sms, 'sms', NULL))"
    return plans.selectExpr(
        "*",
        f"""if(email, concat(severity, ' breach on ', sensorId, ' (', {zone}, ') at ',
          timestamp, ': ', details, '. ', reasoning, ' Notified by ', {selected}, '.'), NULL) AS email_text""",
        "if(sms, concat(severity, ' ', sensorId, ' ', details), NULL) AS sms_text",
    )


def narrative_errors() -> Column:
    """Codes of broken rules: length of a text, and a text iff its channel is selected."""
    def bad_length(name: str, limits: tuple[int, int]) -> Column:
        return F.coalesce(~F.char_length(name).between(*limits), F.lit(False))

    def mismatch(channel: str, text: str) -> Column:
        return F.coalesce(F.col(channel), F.lit(False)) != F.col(text).isNotNull()

    return codes(
        ("email_length", bad_length("email_text", EMAIL_LENGTH)),
        ("sms_length", bad_length("sms_text", SMS_LENGTH)),
        ("email_selection", mismatch("email", "email_text")),
        ("sms_selection", mismatch("sms", "sms_text")),
    )


def audit_narratives(texts: DataFrame) -> DataFrame:
    return texts.withColumn("errors", narrative_errors())


def prompt_texts(plans: DataFrame) -> DataFrame:
    """User prompts of the three model steps, for an outside batch-inference job."""
    # The labels and the order of the lines.
    subject = [
        F.concat(F.lit("Sensor: "), F.col("sensorId")),
        F.concat(F.lit("Reading type: "), F.col("readingType")),
        F.concat(F.lit("Value: "), number_text("value"), F.lit(" "), F.col("unit")),
        F.concat(F.lit("Timestamp: "), F.col("timestamp")),
        F.concat(F.lit("Grid zone: "), zone_text()),
    ]
    confidence = number_text("confidence")
    selected = selected_text()
    return plans.select(
        "*",
        F.concat_ws(
            "\n", *subject, F.concat(F.lit("Threshold breach: "), F.col("details"))
        ).alias("severity_prompt"),
        F.concat_ws(
            "\n",
            F.concat(F.lit("Severity classification: "), F.col("severity")),
            F.concat(F.lit("Severity confidence: "), confidence),
            F.concat(F.lit("Severity reasoning: "), F.col("reasoning")),
            F.lit(""),
            *subject,
        ).alias("routing_prompt"),
        F.concat_ws(
            "\n",
            F.concat(
                F.lit("Severity: "), F.col("severity"), F.lit(" (confidence "), confidence, F.lit(")")
            ),
            F.concat(F.lit("Severity reasoning: "), F.col("reasoning")),
            F.lit(""),
            F.concat(
                F.lit("Routing plan selected: "),
                F.when(selected == "", F.lit("(none)")).otherwise(selected),
            ),
            F.concat(
                F.lit("Routing override applied: "),
                F.when(F.col("override_applied"), F.col("override_reason")).otherwise(
                    F.lit("no (baseline matrix)")
                ),
            ),
            F.lit(""),
            *subject,
            F.lit(""),
            F.lit('Generate narratives ONLY for the channels in "Routing plan selected" above.'),
        ).alias("narrative_prompt"),
    )
