"""Stored tables: readings, raw archive, quarantine and outbox."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.functions.keys import RETENTION_SECONDS, expiry_seconds, reading_key

# Rows per archive file; keeps a day's gzip files at a readable size.
ARCHIVE_ROWS_PER_FILE = 2_000_000


def with_event_date(df: DataFrame) -> DataFrame:
    """Partition column of the readings table."""
    return df.withColumn("event_date", F.to_date("event_ts"))


def with_keys(df: DataFrame, written: Column | None = None) -> DataFrame:
    """Keys of a stored reading: ``pk``, ``sk``, and ``ttl`` from the time it was written, by default its arrival."""
    written = F.timestamp_millis("arrival_ms") if written is None else written
    return df.withColumns({
        "pk": F.col("sensorId"),
        "sk": reading_key(F.col("timestamp"), F.col("readingType")),
        "ttl": expiry_seconds(written),
    })


def write_readings(df: DataFrame, path: str, mode: str = "append") -> None:
    """Readings by event date, sorted so that sensor ranges skip row groups.

    The rebalance brings a day's rows together and splits a large day into
    files near the advised partition size, a busy sensor's rows included.
    """
    _write_days(with_event_date(df), path, mode)


def _write_days(rows: DataFrame, path: str, mode: str) -> None:
    (
        rows.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "sensorId", "event_ts")
        .write.mode(mode)
        .partitionBy("event_date")
        .parquet(path)
    )


def read_readings(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def in_time_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of an inclusive event-time range.

    The partition column gets the same bounds by day, since Spark does not
    derive a filter on ``event_date`` from one on ``event_ts``.
    """
    stored = "event_date" in df.columns
    if start is not None:
        low = F.lit(start).cast("timestamp")
        df = df.where(F.col("event_ts") >= low)
        df = df.where(F.col("event_date") >= F.to_date(low)) if stored else df
    if end is not None:
        high = F.lit(end).cast("timestamp")
        df = df.where(F.col("event_ts") <= high)
        df = df.where(F.col("event_date") <= F.to_date(high)) if stored else df
    return df


def archive_parts(df: DataFrame, arrival: str | Column = "arrival_ts") -> DataFrame:
    return df.select(
        "*",
        F.date_format(arrival, "yyyy").alias("year"),
        F.date_format(arrival, "MM").alias("month"),
        F.date_format(arrival, "dd").alias("day"),
    )


def write_archive(df: DataFrame, path: str, errors: DataFrame | None = None) -> None:
    """All records as gzip JSON by arrival day; failures under ``errors/<type>``."""

    def put(frame: DataFrame, target: str, *before: str) -> None:
        (
            archive_parts(frame)
            .hint("rebalance", "year", "month", "day")
            .write.mode("append")
            .partitionBy(*before, "year", "month", "day")
            .option("compression", "gzip")
            .option("maxRecordsPerFile", ARCHIVE_ROWS_PER_FILE)
            .json(target)
        )

    put(df, f"{path}/raw")
    if errors is not None:
        put(errors, f"{path}/errors", "error_type")


def archive_daily_counts(raw: DataFrame) -> DataFrame:
    """Records per archive day, by arrival."""
    parts = archive_parts(raw.withColumn("arrival_ts", F.timestamp_millis("arrival_ms")))
    return parts.groupBy("year", "month", "day").agg(
        F.count("*").alias("records"),
        F.sum(F.char_length("payload")).cast("bigint").alias("payload_chars"),
    )


def first_live_day(today: date) -> date:
    """The earliest day that can still hold unexpired rows: a day has expired when the retention after its end has passed."""
    return today - timedelta(days=RETENTION_SECONDS // 86_400)


def expire_days(spark: SparkSession, path: str, today: str) -> DataFrame:
    """Readings of the days that still hold unexpired rows as of ``today``; the partition filter skips the others' files.

    For a folder of readings; the table of an ingest job has its expired days removed (``streaming.ingest.remove_expired``).
    """
    first = first_live_day(date.fromisoformat(today))
    return spark.read.parquet(path).where(F.col("event_date") >= F.lit(first))


def write_outbox(messages: DataFrame, path: str) -> None:
    """Append notifications; delivery is done by whoever reads the outbox."""
    messages.write.mode("append").partitionBy("topic").parquet(path)
