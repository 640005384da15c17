"""Metrics: counts, percentiles and token sums per time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from amperline.functions import minute_ms
from amperline.operators.dedup import NATURAL_KEY

PERCENTILES = (0.5, 0.95, 0.99)


def percentile_name(p: float) -> str:
    return f"p{round(p * 100)}"


def events_by_type(log: DataFrame) -> DataFrame:
    """Processed events per minute and reading type."""
    return log.groupBy(
        minute_ms(F.col("processed_ms")).alias("minute_ms"), "readingType"
    ).agg(F.count("*").alias("events"))


def events_total(log: DataFrame) -> DataFrame:
    """Sum over all reading types, built from the per-type sums."""
    return events_by_type(log).groupBy("minute_ms").agg(F.sum("events").alias("events"))


def events_rollup(log: DataFrame) -> DataFrame:
    """Per-type and all-type sums in one pass; the latter have type ``(all)``."""
    by_type = events_by_type(log)
    minute, kind = F.col("minute_ms"), F.col("readingType")
    return (
        by_type.groupingSets([[minute, kind], [minute]], minute, kind)
        .agg(F.sum("events").alias("events"))
        .withColumn("readingType", F.coalesce("readingType", F.lit("(all)")))
    )


def latency_percentiles(
    log: DataFrame, percentiles: Sequence[float] = PERCENTILES, exact: bool = True
) -> DataFrame:
    """Latency percentiles per minute and reading type.

    The exact form counts each distinct millisecond value, so its buffer is
    bounded by the range of latencies and not by the number of events; the
    approximate form bounds it where latencies have no such range.
    """
    wanted = F.array(*[F.lit(float(p)) for p in percentiles])
    pick = (
        F.percentile("latency_ms", wanted)
        if exact
        else F.percentile_approx("latency_ms", wanted, 10_000)
    )
    grouped = log.groupBy(minute_ms(F.col("processed_ms")).alias("minute_ms"), "readingType").agg(
        pick.alias("found")
    )
    return grouped.select(
        "minute_ms",
        "readingType",
        *[F.col("found")[i].cast("double").alias(percentile_name(p)) for i, p in enumerate(percentiles)],
    )


def worst_latency(per_type: DataFrame, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Per minute the worst of the per-type percentiles, which is not a pooled percentile."""
    return per_type.groupBy("minute_ms").agg(
        *[F.max(percentile_name(p)).alias(percentile_name(p)) for p in percentiles]
    )


def duplicates_per_minute(writes: DataFrame) -> DataFrame:
    """Writes per arrival minute that found their natural key already stored.

    Writes are counted per key and minute before the window, so a key that is
    written again and again holds one row per minute.
    """
    per_minute = writes.groupBy(*NATURAL_KEY, minute_ms(F.col("arrival_ms")).alias("minute_ms")).agg(
        F.count("*").alias("n")
    )
    first = F.min("minute_ms").over(Window.partitionBy(*NATURAL_KEY))
    extra = per_minute.withColumn(
        "n", F.col("n") - (F.col("minute_ms") == first).cast("bigint")
    )
    return extra.groupBy("minute_ms").agg(F.sum("n").alias("duplicate_writes"))


def failure_counters(checked: DataFrame, writes: DataFrame) -> DataFrame:
    """Validation errors, failed batch items and duplicate writes per arrival minute.

    ``writes`` are the valid records left after the first de-duplication layer.
    """
    failed = F.size("errors") > 0
    errors = checked.groupBy(minute_ms(F.col("arrival_ms")).alias("minute_ms")).agg(
        F.count_if(failed).alias("validation_errors"),
        F.count_if(failed).alias("partial_batch_failures"),
    )
    both = errors.withColumn("duplicate_writes", F.lit(0).cast("bigint")).unionByName(
        duplicates_per_minute(writes).select(
            "minute_ms",
            F.lit(0).cast("bigint").alias("validation_errors"),
            F.lit(0).cast("bigint").alias("partial_batch_failures"),
            "duplicate_writes",
        )
    )
    names = ("validation_errors", "partial_batch_failures", "duplicate_writes")
    return (
        both.groupBy("minute_ms")
        .agg(*[F.sum(n).alias(n) for n in names])
        .where(" + ".join(names) + " > 0")
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Notified, escalated and refused alerts per minute and reading type."""
    return (
        alerts.groupBy(minute_ms(F.col("alert_ms")).alias("minute_ms"), "readingType")
        .pivot("kind", ["notified", "escalated", "validation_failed"])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )


# Latencies are counted by value, so a percentile sees each value once: the number of values is bounded by the
# resolution (tenths of a millisecond) and not by the rows.
LATENCY_DIGITS = 1


def dispatch_metrics(outcomes: DataFrame) -> DataFrame:
    """Per channel: cases created and retried, failures, latency of real attempts."""
    kind = F.col("kind")
    latency = F.round(F.when(kind.isin("delivered", "failed"), F.col("latency_ms")), LATENCY_DIGITS).alias("latency")
    counts = outcomes.groupBy("channel", latency).agg(
        F.count_if(kind == "delivered").alias("delivered"),
        F.count_if(F.col("skip_reason") == "retry_already_delivered").alias("retried"),
        F.count_if(kind == "failed").alias("failed"),
        F.count("*").alias("n"),
    )
    timed = F.when(F.col("latency").isNotNull(), F.col("n"))
    return counts.groupBy("channel").agg(
        F.sum("delivered").alias("cases_created"),
        F.sum("retried").alias("cases_retried"),
        F.sum("failed").alias("channel_failures"),
        F.round(F.sum(F.col("latency") * F.col("n")) / F.sum(timed), 6).alias("avg_latency_ms"),
        F.percentile("latency", F.lit(0.95), F.col("n")).alias("p95_latency_ms"),
    )


def query_metrics(checked: DataFrame, served: DataFrame) -> DataFrame:
    """Per request day: queries served, their items and latency, refused queries."""
    day = F.to_date(F.timestamp_millis("requested_ms")).cast("string")
    joined = checked.join(served.select("request_id", "item_count"), "request_id", "left")
    ok = F.size("errors") == 0
    latency = F.round(F.when(ok, F.col("latency_ms")), LATENCY_DIGITS).alias("latency")
    counts = joined.groupBy(day.alias("day"), latency).agg(
        F.count_if(ok).alias("served"), F.count_if(~ok).alias("refused"),
        F.sum(F.when(ok, F.col("item_count"))).alias("items"), F.count("*").alias("n"),
    )
    return counts.groupBy("day").agg(
        F.sum("served").alias("queries_served"),
        F.sum("refused").alias("query_validation_errors"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("items_returned"),
        F.percentile("latency", F.lit(0.95), F.col("n")).alias("p95_latency_ms"),
    )


def token_count(response: Column) -> Column:
    """Tokens of one model response.

    The first of two metadata places with any number counts; within it the total
    if given, else input plus output, else zero.
    """
    usage = "struct<input_tokens: double, output_tokens: double, total_tokens: double>"
    parsed = F.from_json(
        response, f"usage_metadata {usage}, response_metadata struct<usage: {usage}>"
    )

    def total(place: Column) -> Column:
        parts = [place["input_tokens"], place["output_tokens"]]
        summed = F.coalesce(parts[0], F.lit(0.0)) + F.coalesce(parts[1], F.lit(0.0))
        present = F.coalesce(place["total_tokens"], *parts).isNotNull()
        return F.when(present, F.coalesce(place["total_tokens"], summed))

    first = total(parsed["usage_metadata"])
    second = total(parsed["response_metadata"]["usage"])
    return F.coalesce(first, second, F.lit(0.0)).cast("bigint")


def tokens_hourly(calls: DataFrame) -> DataFrame:
    """Model calls, tokens and latency per hour."""
    hour = F.unix_millis(F.date_trunc("hour", "event_ts"))
    counted = calls.select(
        hour.alias("hour_ms"), "latency_ms", token_count(F.col("response")).alias("tokens")
    )
    return counted.groupBy("hour_ms").agg(
        F.count("*").alias("invocations"),
        F.sum("tokens").alias("tokens"),
        F.max("latency_ms").alias("max_latency_ms"),
    )


def workflow_counts(executions: DataFrame) -> DataFrame:
    """Executions started, succeeded and failed per minute."""
    marks = executions.select(
        F.inline(
            F.array(
                F.struct(F.col("start_ms").alias("at_ms"), F.lit("STARTED").alias("mark")),
                F.struct(F.col("stop_ms").alias("at_ms"), F.col("status").alias("mark")),
            )
        )
    ).where(F.col("at_ms").isNotNull() & F.col("mark").isin("STARTED", "SUCCEEDED", "FAILED"))
    mark = F.col("mark")
    return marks.groupBy(minute_ms(F.col("at_ms")).alias("minute_ms")).agg(
        F.count_if(mark == "STARTED").alias("started"),
        F.count_if(mark == "SUCCEEDED").alias("succeeded"),
        F.count_if(mark == "FAILED").alias("failed"),
    )


def dlq_counters(messages: DataFrame) -> DataFrame:
    """Dead letters received and failed inspections per minute; the former exclude the latter."""
    failed = F.col("inspection") == "failed"
    return messages.groupBy(minute_ms(F.col("received_ms")).alias("minute_ms")).agg(
        F.count_if(~failed).alias("messages_received"),
        F.count_if(failed).alias("inspection_failures"),
    )
