"""Metrics over streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.functions import minute_ms
from amperline.operators.metrics import PERCENTILES, events_by_type, percentile_name
from amperline.streaming.jobs import read_or_empty, run_to_end, write_batch

COUNTS = "minute_ms bigint, readingType string, events bigint, batch_id bigint"
PROCESSED = "minute_ms bigint, readingType string, events bigint, latency_ms bigint, batch_id bigint"
FAILURE_NAMES = ("validation_errors", "partial_batch_failures", "duplicate_writes")
FAILURES = f"minute_ms bigint, {', '.join(f'{n} bigint' for n in FAILURE_NAMES)}, batch_id bigint"


def events_per_minute(records: DataFrame, time: str = "arrival_ts") -> DataFrame:
    """Records per minute of ``time`` (their arrival) and reading type."""
    minute = F.unix_millis(F.date_trunc("minute", time)).alias("minute_ms")
    return records.groupBy(minute, "readingType").agg(F.count("*").alias("events"))


def run_events_per_minute(records: DataFrame, root: str) -> None:
    """Append the counts of each batch; ``current_counts`` adds them up.

    No state and no watermark: a record counts whenever it comes.
    """
    writer = records.writeStream.foreachBatch(
        lambda batch, batch_id: write_batch(events_per_minute(batch), f"{root}/counts", batch_id)
    )
    run_to_end(writer, f"{root}/checkpoint")


def current_counts(spark: SparkSession, root: str) -> DataFrame:
    """Counts so far of every minute."""
    rows = read_or_empty(spark, f"{root}/counts", COUNTS)
    return rows.groupBy("minute_ms", "readingType").agg(F.sum("events").alias("events"))


def processed_per_minute(kept: DataFrame, latency_ms: int) -> DataFrame:
    """Readings a batch stored, per minute of arrival and reading type, and the time from the batch's start until they stood."""
    counted = events_by_type(kept.withColumnRenamed("arrival_ms", "processed_ms"))
    return counted.withColumn("latency_ms", F.lit(latency_ms).cast("bigint"))


def failures_per_minute(refused: DataFrame, written: DataFrame, kept: DataFrame) -> DataFrame:
    """The failure counters of a batch by minute of arrival; ``written`` are the first copies, ``kept`` those of them that were stored.

    A write that was not stored found its natural key there, from this batch or an earlier one.
    """
    def marked(rows: DataFrame, mark: str) -> DataFrame:
        return rows.select(minute_ms(F.col("arrival_ms")).alias("minute_ms"), F.lit(mark).alias("mark"))

    marks = marked(refused, "refused").unionByName(marked(written, "written")).unionByName(marked(kept, "kept"))
    n = {m: F.count_if(F.col("mark") == m) for m in ("refused", "written", "kept")}
    found = (n["refused"], n["refused"], n["written"] - n["kept"])
    counted = marks.groupBy("minute_ms").agg(*[c.alias(name) for c, name in zip(found, FAILURE_NAMES, strict=True)])
    return counted.where(" + ".join(FAILURE_NAMES) + " > 0")


def processed_counts(spark: SparkSession, path: str) -> DataFrame:
    """Processed events so far of every minute and reading type, from the rows of all batches."""
    return read_or_empty(spark, path, PROCESSED).groupBy("minute_ms", "readingType").agg(F.sum("events").alias("events"))


def processing_latency(spark: SparkSession, path: str, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Latency percentiles per minute and reading type over all batches, exact, in the columns of the batch form."""
    wanted = F.array(*[F.lit(float(p)) for p in percentiles])
    found = read_or_empty(spark, path, PROCESSED).groupBy("minute_ms", "readingType").agg(F.percentile("latency_ms", wanted, F.col("events")).alias("found"))
    return found.select("minute_ms", "readingType", *[F.col("found")[i].alias(percentile_name(p)) for i, p in enumerate(percentiles)])


def failure_counts(spark: SparkSession, path: str) -> DataFrame:
    """Failure counters so far of every minute, from the rows of all batches."""
    return read_or_empty(spark, path, FAILURES).groupBy("minute_ms").agg(*[F.sum(n).alias(n) for n in FAILURE_NAMES])
