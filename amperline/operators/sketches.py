"""Mergeable sketches: latency quantiles by KLL, distinct sensors by theta sketches.

Sketches of short periods are stored once and merged for longer ones; the rows they were made from are not read again.
They stand next to the exact forms in ``metrics`` and ``reads``; that of distinct sensors is here, from each day's sensors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from amperline.operators.metrics import PERCENTILES, percentile_name

MINUTE_MS, DAY_MS = 60_000, 86_400_000
# With this size a quantile's rank is off by less than 0.7 % with 99 % probability; RANK_ERROR is three times that.
QUANTILE_SIZE = 400
RANK_ERROR = 0.02
# 4,096 entries: exact up to that many sensors; beyond them the standard error is 1.6 %.
DISTINCT_LOG_SIZE = 12


def _start(column: str, period_ms: int):
    return F.col(column) - F.pmod(F.col(column), F.lit(period_ms))


def latency_sketches(log: DataFrame, period_ms: int = MINUTE_MS) -> DataFrame:
    """``minute_ms, readingType, sketch, events``; a task sends one sketch per group, however many events it has."""
    return log.groupBy(_start("processed_ms", period_ms).alias("minute_ms"), "readingType").agg(
        F.kll_sketch_agg_double(F.col("latency_ms").cast("double"), F.lit(QUANTILE_SIZE)).alias("sketch"),
        F.count("latency_ms").alias("events"),
    )


def merged(sketches: DataFrame, period_ms: int) -> DataFrame:
    """The sketches of longer periods; ``minute_ms`` is their start."""
    return sketches.groupBy(_start("minute_ms", period_ms).alias("minute_ms"), "readingType").agg(
        F.kll_merge_agg_double("sketch", F.lit(QUANTILE_SIZE)).alias("sketch"), F.sum("events").alias("events")
    )


def sketch_percentiles(sketches: DataFrame, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Percentiles of each sketch, in the columns of ``metrics.latency_percentiles``: alarms take either."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(percentile_name(p)) for p in percentiles]
    return sketches.where("events > 0").select("minute_ms", "readingType", "events", *found)


def rank_errors(found: DataFrame, log: DataFrame, period_ms: int, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """``rank_error`` of each row of ``found``: how far the share of events up to a value is from the share asked for, at most."""
    keyed = log.where("latency_ms IS NOT NULL").withColumn("minute_ms", _start("processed_ms", period_ms))
    parts = []
    for p in percentiles:
        below = F.count_if(F.col("latency_ms") < F.col(percentile_name(p))) / F.count("*")
        upto = F.count_if(F.col("latency_ms") <= F.col(percentile_name(p))) / F.count("*")
        parts.append(F.greatest(below - p, F.lit(p) - upto, F.lit(0.0)))
    worst = F.greatest(*parts) if len(parts) > 1 else parts[0]
    errors = keyed.join(found, ["minute_ms", "readingType"]).groupBy("minute_ms", "readingType").agg(worst.alias("rank_error"))
    return found.join(errors, ["minute_ms", "readingType"])


def sensor_sketches(readings: DataFrame) -> DataFrame:
    """``day, readingType, sketch`` of the sensors seen."""
    day = F.to_date("event_ts").alias("day")
    return readings.groupBy(day, "readingType").agg(F.theta_sketch_agg("sensorId", F.lit(DISTINCT_LOG_SIZE)).alias("sketch"))


def distinct_sensors(sketches: DataFrame, days: int = 7) -> DataFrame:
    """Per day and type: sensors of the day, of the last ``days`` days, and those of the day before that are silent.

    A day's sketch is handed to the days it counts for and merged there, so a range of any length reads one row per day.
    """
    own = sketches.select("day", "readingType", F.theta_sketch_estimate("sketch").alias("sensors"), "sketch")
    later = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    spread = sketches.select("day", "readingType", "sketch", later.alias("shift"))
    ranged = spread.groupBy(F.date_add("day", F.col("shift")).alias("day"), "readingType").agg(
        F.theta_sketch_estimate(F.theta_union_agg("sketch", F.lit(DISTINCT_LOG_SIZE))).alias("sensors_in_range")
    )
    before = sketches.select(F.date_add("day", 1).alias("day"), "readingType", F.col("sketch").alias("previous"))
    silent = F.coalesce(F.theta_sketch_estimate(F.theta_difference("previous", "sketch")), F.lit(0))
    joined = own.join(ranged, ["day", "readingType"]).join(before, ["day", "readingType"], "left")
    return joined.select("day", "readingType", "sensors", "sensors_in_range", silent.cast("bigint").alias("silent_since_yesterday"))


def sensor_days(readings: DataFrame) -> DataFrame:
    """``day, readingType, sensorId``, each once: the exact counterpart of ``sensor_sketches``; days of it add up by union."""
    return readings.select(F.to_date("event_ts").alias("day"), "readingType", "sensorId").distinct()


def exact_distinct_sensors(held: DataFrame, days: int = 7) -> DataFrame:
    """The columns of ``distinct_sensors``, exact for any number of sensors.

    A sensor counts from a day on until it is seen again or the range is over, so it counts once in each range.  These
    stretches are counted by first day and length, at most ``days`` rows per day and type; only these are spread over days.
    """
    longest = max(days, 2)
    later = Window.partitionBy("readingType", "sensorId").orderBy("day")
    until_next = F.least(F.datediff(F.lead("day").over(later), "day"), F.lit(longest))
    # A day of readings without a sensor is a row too, of none.
    stretches = (
        held.where("day IS NOT NULL AND readingType IS NOT NULL")
        .withColumn("length", F.coalesce(until_next, F.lit(longest)))
        .groupBy("day", "readingType", "length").agg(F.count("sensorId").alias("n"))
    )
    spread = stretches.withColumn("shift", F.explode(F.sequence(F.lit(0), F.col("length") - 1)))
    per_day = spread.groupBy(F.date_add("day", F.col("shift")).alias("day"), "readingType").agg(
        F.sum(F.when(F.col("shift") == 0, F.col("n"))).alias("sensors"),
        F.sum(F.when(F.col("shift") < days, F.col("n"))).alias("sensors_in_range"),
        F.coalesce(F.sum(F.when(F.col("shift") == 1, F.col("n"))), F.lit(0)).cast("bigint").alias("silent_since_yesterday"),
    )
    return per_day.where("sensors IS NOT NULL")
