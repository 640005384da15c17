"""Threshold evaluation of readings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.functions import number_literal, number_sql

Bounds = Mapping[str, tuple[float, float]]

# Inclusive bounds per reading type.
DEFAULT_BOUNDS: Bounds = {"frequency": (59.5, 60.5), "voltage": (114.0, 126.0)}


def constant_by_type(values: Mapping[str, str]) -> str:
    """SQL for one constant per reading type, null where there is none.

    Bounds are part of the plan, so evaluation stays in the scan stage and takes
    no join.
    """
    cases = " ".join(f"WHEN '{name}' THEN {value}" for name, value in sorted(values.items()))
    return f"CASE readingType {cases} END"


def is_breach(bounds: Bounds = DEFAULT_BOUNDS) -> Column:
    """The one definition of a breach; false for types without bounds."""
    tests = " OR ".join(
        f"(readingType = '{name}' AND (value < {float(low)}D OR value > {float(high)}D))"
        for name, (low, high) in sorted(bounds.items())
    )
    return F.expr(f"coalesce({tests}, false)")


def judge(df: DataFrame, low_text: str, high_text: str) -> DataFrame:
    """Compare ``value`` with the columns ``low`` and ``high``, which are dropped.

    The bounds themselves are in range.  A null bound means there is none.
    """
    shown = f"concat(readingType, '=', {number_sql('value')}, unit"
    return df.selectExpr(
        "* EXCEPT (low, high)",
        "coalesce(value < low OR value > high, false) AS exceeded",
        f"""CASE WHEN low IS NULL OR high IS NULL THEN concat(readingType, ': no threshold configured')
          ELSE {shown}, CASE WHEN value < low THEN concat(' below min ', {low_text})
            WHEN value > high THEN concat(' above max ', {high_text})
            ELSE concat(' within [', {low_text}, ', ', {high_text}, ']') END) END AS details""",
        "CASE WHEN value < low THEN low END AS broken_min",
        "CASE WHEN value > high AND NOT coalesce(value < low, false) THEN high END AS broken_max",
    )


def evaluate(df: DataFrame, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """Add ``exceeded``, ``details`` and the broken bound to each reading."""
    def pick(side: int, form) -> str:
        return constant_by_type({name: form(pair[side]) for name, pair in bounds.items()})

    def number(value: float) -> str:
        return f"{float(value)}D"

    def text(value: float) -> str:
        return f"'{number_literal(value)}'"

    bounded = df.selectExpr("*", f"{pick(0, number)} AS low", f"{pick(1, number)} AS high")
    return judge(bounded, pick(0, text), pick(1, text))


def evaluate_per_sensor(
    df: DataFrame, mappings: DataFrame, range_column: str = "thresholdRange"
) -> DataFrame:
    """Judge each reading by the bounds its own sensor is mapped to.

    A mapping counts for the metric it names.  The join carries no broadcast
    hint: the registry grows with the fleet, so its measured size decides, and a
    sensor with many readings is split by the adaptive skew join.
    """
    wanted = mappings.select(
        F.col("sensorId"),
        F.col("metricType").alias("readingType"),
        F.col(f"{range_column}.min").alias("low"),
        F.col(f"{range_column}.max").alias("high"),
    )
    # Of several mappings of a sensor's metric the narrowest from below counts.
    one = wanted.groupBy("sensorId", "readingType").agg(F.max(F.struct("low", "high")).alias("b"))
    joined = df.join(one.select("sensorId", "readingType", "b.low", "b.high"), ["sensorId", "readingType"], "left")
    return judge(joined, number_sql("low"), number_sql("high"))
