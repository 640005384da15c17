"""Notification routing: the baseline matrix, context signals and overrides."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from amperline.functions import codes

# Channels each tier uses by default.
BASELINE: Mapping[str, tuple[str, ...]] = {
    "P0": ("email", "sms"),
    "P1": ("email", "sms"),
    "P2": ("email",),
    "P3": ("email",),
}
CHANNELS = ("email", "sms")


@dataclass(frozen=True)
class Signals:
    """When context outside the matrix counts as a signal."""

    recurrence_seconds: int = 1800
    recurrence_count: int = 3
    cascade_seconds: int = 900
    cascade_slide: int = 300
    cascade_sensors: int = 3
    quiet_from: int = 22
    quiet_until: int = 6
    quiet_tiers: tuple[str, ...] = ("P2",)


def baseline_routing(
    classified: DataFrame, matrix: Mapping[str, tuple[str, ...]] = BASELINE
) -> DataFrame:
    """One boolean column per channel.  The matrix is a constant of the plan."""
    def used_by(channel: str) -> str:
        tiers = ", ".join(f"'{name}'" for name, used in matrix.items() if channel in used)
        return f"severity IN ({tiers or 'NULL'}) AS {channel}"

    return classified.selectExpr("*", *[used_by(channel) for channel in CHANNELS])


def recurrence(breaches: DataFrame, seconds: int = 1800) -> DataFrame:
    """Breaches of the same sensor in the trailing window, itself included.

    Counts are first summed per sensor and second.  Each second is then placed
    in its own time block and, as history only, in the next one, so a window
    group holds at most two blocks of seconds however busy its sensor is.
    """
    second = F.unix_seconds("event_ts")
    marked = breaches.withColumn("at_second", second)
    counts = marked.groupBy("sensorId", "at_second").agg(F.count("*").alias("n"))
    block = F.floor(F.col("at_second") / seconds)
    placed = counts.withColumn("block", F.explode(F.array(block, block + 1)))
    trailing = (
        Window.partitionBy("sensorId", "block").orderBy("at_second").rangeBetween(-seconds, 0)
    )
    recent = (
        placed.withColumn("recent_breaches", F.sum("n").over(trailing))
        .where(F.col("block") == block)
        .select("sensorId", "at_second", "recent_breaches")
    )
    return marked.join(recent, ["sensorId", "at_second"]).drop("at_second")


def zone_cascade(breaches: DataFrame, seconds: int = 900, slide: int = 300) -> DataFrame:
    """Distinct breaching sensors per zone and sliding window.

    Sensors are reduced to one row per zone, sensor and slide before the rows
    are spread over the windows they belong to; a zone is never one group.
    """
    step = F.floor(F.unix_seconds("event_ts") / slide)
    pairs = (
        breaches.where(F.col("gridZone").isNotNull())
        .select("gridZone", "sensorId", step.alias("step"))
        .distinct()
    )
    spread = pairs.select(
        "gridZone",
        "sensorId",
        F.explode(F.sequence(F.col("step") - (seconds // slide - 1), F.col("step"))).alias("window_step"),
    ).distinct()
    return (
        spread.groupBy("gridZone", "window_step")
        .agg(F.count("*").alias("sensors"))
        .select("gridZone", (F.col("window_step") * slide).alias("window_start"), "sensors")
    )


def cascade_size(breaches: DataFrame, seconds: int = 900, slide: int = 300) -> DataFrame:
    """Add the largest cascade among the windows that cover each breach."""
    windows = zone_cascade(breaches, seconds, slide)
    # Best window per slide step first, so a breach needs one equality join.
    per_step = (
        windows.withColumn(
            "step",
            F.explode(
                F.sequence(
                    F.col("window_start").cast("bigint"),
                    F.col("window_start") + (seconds - slide),
                    F.lit(slide).cast("bigint"),
                )
            ),
        )
        .groupBy("gridZone", "step")
        .agg(F.max("sensors").alias("cascade_sensors"))
    )
    step = F.floor(F.unix_seconds("event_ts") / slide) * slide
    return (
        breaches.withColumn("step", step)
        .join(per_step, ["gridZone", "step"], "left")
        .drop("step")
    )


def routing_plan(classified: DataFrame, signals: Signals = Signals()) -> DataFrame:
    """Baseline channels, raised to sms where a context signal asks for it."""
    base = baseline_routing(classified)
    with_recent = recurrence(base, signals.recurrence_seconds)
    with_all = cascade_size(with_recent, signals.cascade_seconds, signals.cascade_slide)
    tiers = ", ".join(f"'{tier}'" for tier in signals.quiet_tiers)
    either = "OR" if signals.quiet_from > signals.quiet_until else "AND"
    signalled = with_all.selectExpr(
        "*",
        f"recent_breaches >= {signals.recurrence_count} AS _repeated",
        f"coalesce(cascade_sensors >= {signals.cascade_sensors}, false) AS _cascading",
        f"""severity IN ({tiers}) AND (hour(event_ts) >= {signals.quiet_from}
          {either} hour(event_ts) < {signals.quiet_until}) AS _quiet""",
    ).selectExpr("*", "NOT sms AND (_repeated OR _cascading OR _quiet) AS override_applied")
    return signalled.selectExpr(
        "* EXCEPT (sms, _repeated, _cascading, _quiet)",
        "sms OR override_applied AS sms",
        f"""if(override_applied, concat_ws('; ',
          if(_repeated, concat(cast(recent_breaches AS string),
            ' breaches of this sensor in {signals.recurrence_seconds // 60} minutes'), NULL),
          if(_cascading, concat(cast(cascade_sensors AS string),
            ' sensors of the zone breached within {signals.cascade_seconds // 60} minutes'), NULL),
          if(_quiet, 'breach outside staffed hours', NULL)), NULL) AS override_reason""",
    )


def plan_errors(
    email: Column, sms: Column, override_applied: Column, override_reason: Column
) -> Column:
    """Codes of the rules a routing plan breaks."""
    size = F.char_length(override_reason)
    rules = [
        ("email", email.isNull()),
        ("sms", sms.isNull()),
        ("overrideApplied", override_applied.isNull()),
        (
            "overrideReason",
            F.coalesce(override_applied & override_reason.isNull(), F.lit(False))
            | F.coalesce(~size.between(10, 500), F.lit(False)),
        ),
    ]
    return codes(*rules)


def audit_plans(plans: DataFrame) -> DataFrame:
    return plans.withColumn(
        "errors",
        plan_errors(
            F.col("email"), F.col("sms"), F.col("override_applied"), F.col("override_reason")
        ),
    )


def override_audit(plans: DataFrame) -> DataFrame:
    """Overrides per tier."""
    return plans.groupBy("severity").agg(
        F.count("*").alias("plans"),
        F.count_if(F.col("override_applied")).alias("overrides"),
    )
