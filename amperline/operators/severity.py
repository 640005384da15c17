"""Severity tiers of breaches and the audit of severity answers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.functions import codes, number_sql

TIERS = ("P0", "P1", "P2", "P3")

# Distance outside the band at which a tier starts.  P0 starts
# above its edge, P1 and P2 at theirs, and everything smaller is P3.
EDGES: Mapping[str, tuple[float, float, float]] = {
    "frequency": (2.0, 1.0, 0.5),
    "voltage": (15.0, 8.0, 4.0),
}
# Half-width of the zone around an edge in which a tier is less certain.
MARGIN: Mapping[str, float] = {"frequency": 0.05, "voltage": 0.4}
CLEAR, UNSURE = 0.95, 0.7


def _by_type(build) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {build(name)}" for name in sorted(EDGES))
    return f"CASE readingType {cases} END"


def _tier(name: str) -> str:
    top, high, mid = EDGES[name]
    return (
        f"CASE WHEN deviation > {top}D THEN 'P0' WHEN deviation >= {high}D THEN 'P1'"
        f" WHEN deviation >= {mid}D THEN 'P2' ELSE 'P3' END"
    )


def _confidence(name: str) -> str:
    gaps = ", ".join(f"round(abs(deviation - {edge}D), 6)" for edge in EDGES[name])
    return f"if(least({gaps}) <= {MARGIN[name]}D, {UNSURE}D, {CLEAR}D)"


def classify(breaches: DataFrame) -> DataFrame:
    """Add deviation, tier, confidence and reasoning to rows that ``evaluate`` flagged.

    The deviation is the distance outside the broken bound.  Rows that are no
    breach get nulls: they take the fallback path.
    """
    sized = breaches.selectExpr(
        "*", "round(coalesce(broken_min - value, value - broken_max), 6) AS deviation"
    )
    tiered = sized.selectExpr(
        "*",
        f"if(deviation IS NULL, NULL, {_by_type(_tier)}) AS severity",
        f"if(deviation IS NULL, NULL, {_by_type(_confidence)}) AS confidence",
    )
    return tiered.selectExpr(
        "*",
        f"""concat(readingType, ' of ', {number_sql('value')}, unit, ' is ',
          {number_sql('deviation')}, unit,
          if(broken_min IS NOT NULL, ' below min ', ' above max '),
          {number_sql('coalesce(broken_min, broken_max)')}, '; tier ', severity, '.') AS reasoning""",
    )


def answer_errors(severity: Column, confidence: Column, reasoning: Column) -> Column:
    """Codes of the rules a severity answer breaks."""
    size = F.char_length(reasoning)
    return codes(
        ("severity", ~F.coalesce(severity.isin(*TIERS), F.lit(False))),
        ("confidence", ~F.coalesce(confidence.between(0.0, 1.0), F.lit(False))),
        ("reasoning", ~F.coalesce(size.between(10, 500), F.lit(False))),
    )


def audit_answers(answers: DataFrame) -> DataFrame:
    """Check a table of severity answers; ``answer_severity`` holds the tier."""
    return answers.withColumn(
        "errors",
        answer_errors(F.col("answer_severity"), F.col("confidence"), F.col("reasoning")),
    )
