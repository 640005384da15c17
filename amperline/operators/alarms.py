"""Alarms over metric series.

A series has one row per period: ``period_ms`` (start) and ``value``.  A missing
period does not breach, so nothing has to be filled in: a breaching period
counts for itself and the evaluations that follow it, and a sum tells which
evaluations have all their periods breaching.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

COMPARATORS = {
    ">": lambda value, limit: value > limit,
    ">=": lambda value, limit: value >= limit,
    "<": lambda value, limit: value < limit,
    "<=": lambda value, limit: value <= limit,
}

DAY_SECONDS = 86_400


@dataclass(frozen=True)
class Rule:
    """When a metric series is in alarm."""

    name: str
    comparator: str
    threshold: float
    periods: int = 1
    period_ms: int = 60_000


# The alarms of the pipeline.
DLQ_DEPTH = Rule("dlq-messages", ">=", 1)
P99_LATENCY = Rule("p99-latency", ">", 2000, periods=3)
WORKFLOW_FAILURES = Rule("workflow-failures", ">=", 1)
TOKEN_RUNAWAY = Rule("token-runaway", ">", 1_000_000, period_ms=3_600_000)


def alarm_periods(series: DataFrame, rule: Rule) -> DataFrame:
    """Periods at whose end the alarm is on."""
    breaching = series.where(COMPARATORS[rule.comparator](F.col("value"), F.lit(rule.threshold)))
    if rule.periods == 1:
        return breaching.select("period_ms")
    later = F.explode(F.array(*[F.lit(i * rule.period_ms) for i in range(rule.periods)]))
    return (
        breaching.select("period_ms", later.alias("shift"))
        .groupBy((F.col("period_ms") + F.col("shift")).alias("period_ms"))
        .agg(F.count("*").alias("n"))
        .where(F.col("n") == rule.periods)
        .select("period_ms")
    )


def state_changes(series: DataFrame, rule: Rule) -> DataFrame:
    """Times at which the alarm changes between OK and ALARM."""
    on = alarm_periods(series, rule).select(
        F.inline(
            F.array(
                F.struct(F.col("period_ms").alias("at_ms"), F.lit(1).alias("now"), F.lit(0).alias("before")),
                F.struct(
                    (F.col("period_ms") + rule.period_ms).alias("at_ms"),
                    F.lit(0).alias("now"),
                    F.lit(1).alias("before"),
                ),
            )
        )
    )
    merged = on.groupBy("at_ms").agg(F.max("now").alias("now"), F.max("before").alias("before"))
    return merged.where("now <> before").select(
        F.lit(rule.name).alias("alarm"),
        F.col("at_ms"),
        F.when(F.col("now") == 1, "ALARM").otherwise("OK").alias("state"),
    )


def _depth_days(per_second: DataFrame) -> DataFrame:
    """Each day with changes: the depth at its start and its end, and the next such day.

    Sums in two levels: months on top of each other, then the days within their month.  Only days and months with changes are
    rows, so a message from long ago adds one of each.  ``era`` is one key for 10,000 years of months.
    """
    days = per_second.groupBy("month", "day").agg(F.sum(F.col("came") - F.col("went")).alias("net"))
    months = days.groupBy("month").agg(F.sum("net").alias("net"), F.min("day").alias("first_day"))

    def earlier(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("net").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    along = Window.partitionBy(F.expr("month DIV 120000").alias("era")).orderBy("month")
    months = months.select("month", earlier(along).alias("before"), F.lead("first_day").over(along).alias("next_first"))
    within = Window.partitionBy("month").orderBy("day")
    days = days.select("month", "day", "net", earlier(within).alias("added"), F.lead("day").over(within).alias("next"))
    start = F.col("before") + F.col("added")
    return days.join(months, "month").select(
        "day", start.alias("at_start"), (start + F.col("net")).alias("at_end"), F.coalesce("next", "next_first").alias("next_day")
    )


def _depth(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(days, minutes)``; minutes with changes: depth before, largest depth, depth after.

    A message waits from ``received_ms`` until ``handled_ms``; if that is null or its inspection failed it stays.  Changes are
    summed per second first; the running sum within a day stands on the day's start, so no task sees more than one day of
    seconds.  Arrivals of a second count before departures.
    """
    gone = F.when(F.col("inspection") == "ok", F.col("handled_ms"))
    marks = F.array(
        F.struct(F.floor(F.col("received_ms") / 1000).alias("second"), F.lit(1).alias("came"), F.lit(0).alias("went")),
        F.struct(F.floor(gone / 1000).alias("second"), F.lit(0).alias("came"), F.lit(1).alias("went")),
    )
    changes = messages.select(F.inline(marks)).where("second IS NOT NULL")
    per_second = changes.groupBy("second").agg(F.sum("came").alias("came"), F.sum("went").alias("went"))
    per_second = per_second.withColumn("day", F.floor(F.col("second") / DAY_SECONDS)).withColumn(
        "month", F.expr("12L * year(date_from_unix_date(int(day))) + month(date_from_unix_date(int(day)))")
    )
    days = _depth_days(per_second)
    running = F.sum(F.col("came") - F.col("went")).over(Window.partitionBy("day").orderBy("second"))
    seconds = per_second.withColumn("after", running)
    minutes = seconds.groupBy("day", F.floor(F.col("second") / 60).alias("minute")).agg(
        F.min_by(F.expr("after - came + went"), "second").alias("before"),
        F.max(F.expr("after + went")).alias("peak"),
        F.max_by("after", "second").alias("after"),
    )
    based = minutes.join(days.select("day", "at_start"), "day")
    levels = {c: F.col(c) + F.col("at_start") for c in ("before", "peak", "after")}
    return days, based.withColumns(levels).withColumn("peak", F.greatest("before", "peak")).drop("at_start")


def dlq_depth_changes(messages: DataFrame, rule: Rule = DLQ_DEPTH) -> DataFrame:
    """State changes of an alarm on the number of waiting dead letters, from the minutes with changes alone.

    Between two of them the depth stays, so a minute is compared with the one before it, and the minute after it with itself.
    The series ends with the last day of a change.
    """
    if rule.periods != 1 or rule.period_ms != 60_000:
        raise ValueError("the depth alarm looks at single minutes")
    days, minutes = _depth(messages)

    def on(column: str) -> Column:
        return COMPARATORS[rule.comparator](F.col(column), F.lit(rule.threshold))

    def mark(at: Column, now: Column, before: Column, now_rank: int, before_rank: int) -> Column:
        ranks = (F.lit(now_rank).alias("now_rank"), F.lit(before_rank).alias("before_rank"))
        return F.struct(at.cast("bigint").alias("at_ms"), now.alias("now"), before.alias("before"), *ranks)

    start = F.col("minute") * 60_000
    own = mark(start, on("peak"), on("before"), 2, 2)
    after = mark(start + 60_000, on("after"), on("peak"), 1, 3)
    end = mark((F.col("day") + 1) * (DAY_SECONDS * 1000), F.lit(False), on("at_end"), 3, 1)
    marks = minutes.select(F.inline(F.array(own, after)))
    marks = marks.unionByName(days.where("next_day IS NULL").select(F.inline(F.array(end))))
    merged = marks.groupBy("at_ms").agg(F.max_by("now", "now_rank").alias("now"), F.max_by("before", "before_rank").alias("before"))
    return merged.where("now <> before").select(
        F.lit(rule.name).alias("alarm"), "at_ms", F.when(F.col("now"), "ALARM").otherwise("OK").alias("state")
    )


def dlq_depth(messages: DataFrame) -> DataFrame:
    """Largest number of waiting dead letters in each minute of each day from the first to the last one with a change.

    The dense form, for charts; alarms use ``dlq_depth_changes``.
    """
    days, minutes = _depth(messages)
    minute = F.explode(F.sequence(F.col("day") * 1440, F.col("day") * 1440 + 1439)).alias("minute")
    busy = days.select("day", "at_start", minute).join(minutes.drop("before"), ["day", "minute"], "left")
    before = Window.partitionBy("day").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.last("after", ignorenulls=True).over(before), F.col("at_start"))
    filled = busy.select("minute", F.coalesce("peak", carried).alias("value"))
    idle = days.where("next_day > day + 1").select("at_end", F.explode(F.sequence(F.col("day") + 1, F.col("next_day") - 1)).alias("day"))
    filled = filled.unionByName(idle.select(minute, F.col("at_end").alias("value")))
    return filled.select((F.col("minute") * 60_000).alias("period_ms"), F.col("value").cast("double").alias("value"))


def p99_series(percentiles: DataFrame, reading_type: str = "voltage") -> DataFrame:
    """The p99 stream one reading type stands for."""
    return percentiles.where(F.col("readingType") == reading_type).select(
        F.col("minute_ms").alias("period_ms"), F.col("p99").alias("value")
    )


def workflow_series(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.col("minute_ms").alias("period_ms"), F.col("failed").cast("double").alias("value")
    )


def token_series(hourly: DataFrame) -> DataFrame:
    return hourly.select(
        F.col("hour_ms").alias("period_ms"), F.col("tokens").cast("double").alias("value")
    )
