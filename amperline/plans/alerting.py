"""The batch form of alerting: breach, tier, plan, text, dispatch, cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.functions import case_key
from amperline.operators.narratives import audit_narratives, narratives
from amperline.operators.routing import Signals, audit_plans, routing_plan
from amperline.operators.severity import answer_errors, classify
from amperline.operators.thresholds import DEFAULT_BOUNDS, Bounds, evaluate
from amperline.session import stored


def classified_breaches(readings: DataFrame, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    found = classify(evaluate(readings, bounds).where("exceeded"))
    return found.withColumn(
        "case_pk", case_key(F.col("sensorId"), F.col("timestamp"), F.col("readingType"))
    )


def enrich_breaches(breaches: DataFrame, signals: Signals = Signals()) -> DataFrame:
    """Classified breaches with routing plan and channel texts, and whether a broken text calls for the fallback.

    The signals look at the breaches three times, so hand in a stored table.
    """
    told = audit_narratives(narratives(routing_plan(breaches, signals)))
    return told.withColumn("used_fallback", F.size("errors") > 0).drop("errors")


def enriched_alerts(
    readings: DataFrame, bounds: Bounds = DEFAULT_BOUNDS, signals: Signals = Signals()
) -> DataFrame:
    """From readings to alerts; the breaches are stored in between, read from one scan."""
    return enrich_breaches(stored(classified_breaches(readings, bounds), "breaches"), signals)


def audit_enrichment(answers: DataFrame) -> DataFrame:
    """Outside answers with ``used_fallback``: true where any of the three checks fails."""
    severity = answer_errors(F.col("answer_severity"), F.col("confidence"), F.col("reasoning"))
    tiered = answers.withColumn("severity_errors", severity)
    planned = audit_plans(tiered).withColumnRenamed("errors", "plan_errors")
    told = audit_narratives(planned).withColumnRenamed("errors", "text_errors")
    broken = F.size("severity_errors") + F.size("plan_errors") + F.size("text_errors")
    return told.withColumn("used_fallback", broken > 0)
