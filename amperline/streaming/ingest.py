"""Ingest as one stream: archive, validate, drop redeliveries, store first writes, quarantine, count metrics."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.operators.dedup import LEDGER_HOURS, MAX_ATTEMPTS, NATURAL_KEY, SEQUENCE_KEY, drop_redelivered, first_writes, is_exhausted
from amperline.operators.validation import FIELDS, validate
from amperline.sources.stores import ARCHIVE_ROWS_PER_FILE, archive_parts, first_live_day, with_event_date, with_keys
from amperline.sources.tables import DayTable
from amperline.sources.telemetry import topic_sensor
from amperline.streaming import metrics
from amperline.streaming.jobs import read_or_empty, run_to_end, write_batch

# Columns of the stored tables, without the day and the batch.
READINGS = (
    "pk string, sk string, ttl bigint, sensorId string, timestamp string, event_ts timestamp, readingType string,"
    " value double, unit string, gridZone string, shard_id string, sequence_number string, arrival_ms bigint"
)
KEYS = "sensorId string, timestamp string, readingType string, event_ts timestamp"
LEDGER = "shard_id string, sequence_number string, arrival_ms bigint"
COUNTS = "records bigint, quarantined bigint, redelivered bigint, duplicates bigint, kept bigint"
HOUR_MS = 3_600_000
# The sensor of a telemetry topic, and what else a checked record has besides its raw columns.
ROUTED = "routed_sensor"
CHECKED = (*FIELDS, "event_ts", "errors", ROUTED)
ARCHIVE_DAY = ("year", "month", "day")
# A day of more partitions than this is put together, and so often the job looks for such days.
LOOSE_BATCHES = 32
FOLD_EVERY = 32

Clock = int | Callable[[], int] | None


def checked_stream(raw: DataFrame) -> DataFrame:
    """Every raw record as it came, with its validated fields and the sensor its topic names.

    Records of other topics have no such sensor: they are archived, and go no further.  No watermark: a lagging shard loses
    nothing, and what was seen before is told by the ledger.
    """
    return validate(raw.withColumn(ROUTED, topic_sensor(F.col("topic"))), sensor=ROUTED)


def archive_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Raw records of one batch as gzip JSON by arrival day, in partitions that a replay overwrites.

    The batch's partition has a name of its own, as raw records may carry a ``batch_id``.
    """
    (
        archive_parts(rows, F.timestamp_millis("arrival_ms"))
        .hint("rebalance", *ARCHIVE_DAY)
        .withColumn("ingest_batch", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*ARCHIVE_DAY, "ingest_batch")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ARCHIVE_ROWS_PER_FILE)
        .json(path)
    )


def _arrival_day(ms: str) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def new_sequences(rows: DataFrame, ledger: DayTable, batch_id: int) -> DataFrame:
    """The first copy of each sequence number that no earlier batch has processed.

    A copy arrives at most the ledger's hours after its first one, so the catalogue names the ledger's partitions of that
    range and no others.  Its buckets are those of the join, so only the batch is shuffled.
    """
    low, high = rows.agg(F.min("arrival_ms"), F.max("arrival_ms")).first()
    first = drop_redelivered(rows)
    if low is None:
        return first
    span = LEDGER_HOURS * HOUR_MS
    days = [F.to_date(F.timestamp_millis(F.lit(ms))) for ms in (low - span, high + span)]
    known = ledger.all_rows(rows.sparkSession).where(F.col("arrival_day").between(*days) & (F.col("batch_id") != batch_id))
    known = known.where(F.col("arrival_ms").between(low - span, high + span))
    return first.join(known.select(*SEQUENCE_KEY), [*SEQUENCE_KEY], "left_anti")


def write_ledger(rows: DataFrame, ledger: DayTable, batch_id: int) -> None:
    ledger.put(rows.withColumn("arrival_day", _arrival_day("arrival_ms")), batch_id)


def unstored(valid: DataFrame, keys: DayTable, batch_id: int) -> DataFrame:
    """First writes of natural keys that no earlier batch has stored.

    The key holds the event time, so only stored keys within the batch's range of event times count; the catalogue
    names their days' partitions.
    """
    low, high = valid.agg(F.min("event_ts"), F.max("event_ts")).first()
    first = first_writes(valid)
    if low is None:
        return first
    known = keys.all_rows(valid.sparkSession).where(F.col("event_date").between(F.to_date(F.lit(low)), F.to_date(F.lit(high))))
    known = known.where(F.col("event_ts").between(F.lit(low), F.lit(high)) & (F.col("batch_id") != batch_id))
    return first.join(known.select(*NATURAL_KEY), [*NATURAL_KEY], "left_anti")


@dataclass(frozen=True)
class IngestTarget:
    """Folders and tables of one ingest job; ``buckets`` is the number the key tables start with, by default the shuffle's."""

    root: str
    buckets: int | None = None

    @property
    def readings(self) -> str:
        return f"{self.root}/readings"

    @property
    def readings_table(self) -> DayTable:
        return DayTable(self.readings, READINGS, "event_date")

    @property
    def keys_table(self) -> DayTable:
        return DayTable(f"{self.root}/keys", KEYS, "event_date", NATURAL_KEY, self.buckets)

    @property
    def ledger_table(self) -> DayTable:
        return DayTable(self.ledger, LEDGER, "arrival_day", SEQUENCE_KEY, self.buckets)

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    @property
    def fresh(self) -> str:
        return f"{self.root}/fresh"

    @property
    def counts(self) -> str:
        return f"{self.root}/counts"

    @property
    def processed(self) -> str:
        return f"{self.root}/metrics/processed"

    @property
    def failures(self) -> str:
        return f"{self.root}/metrics/failures"

    @property
    def archive(self) -> str:
        return f"{self.root}/archive"

    @property
    def raw_archive(self) -> str:
        """What ingest archives; ``run_archive`` keeps a log of its own files in the folder above."""
        return f"{self.archive}/raw"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def _batch_time(spark: SparkSession, target: IngestTarget, batch_id: int, clock: Clock) -> int | None:
    """The time a batch's ages count from: asked for once, kept for a replay."""
    if not callable(clock):
        return clock
    place, schema = f"{target.root}/clock/batch_id={batch_id}", "as_of_ms bigint"
    if read_or_empty(spark, place, schema).isEmpty():
        spark.createDataFrame([(clock(),)], schema).write.mode("overwrite").parquet(place)
    return spark.read.schema(schema).parquet(place).first().as_of_ms


def store_batch(target: IngestTarget, as_of_ms: Clock = None):
    """The function each micro-batch of ``checked_stream`` is handed to.

    Every raw record is archived.  Every telemetry record also ends in one place: readings, quarantine (rejected, or given up
    by age or tries), or it is counted as redelivered or duplicate.  Metrics are kept per minute of arrival: events and
    latency of what was stored, records that validation refused, duplicate writes.  ``as_of_ms`` is the time of processing
    that ages count from: a fixed one, or a function that is asked for each batch of a job that runs on.  A replay of old
    records has none, and then only tries count.
    """
    ledger, keys, readings = target.ledger_table, target.keys_table, target.readings_table

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, started = batch.sparkSession, time.monotonic()
        now = _batch_time(spark, target, batch_id, as_of_ms)
        # Several writes use the batch: it is parsed once into a shared folder, which the next batch overwrites.
        batch.write.mode("overwrite").parquet(target.staging)
        rows = spark.read.schema(batch.schema).parquet(target.staging)
        archive_batch(rows.drop(*CHECKED), target.raw_archive, batch_id)
        rows = rows.where(F.col(ROUTED).isNotNull()) if ROUTED in rows.columns else rows
        attempts = F.col("attempts") if "attempts" in rows.columns else F.lit(1)
        aged = is_exhausted(F.lit(1), F.col("arrival_ms"), now) if now is not None else F.lit(False)
        tired = attempts > MAX_ATTEMPTS
        reasons = F.when(aged, F.array(F.lit("aged"))).when(tired, F.array(F.lit("exhausted"))).otherwise(F.col("errors"))
        rows = rows.withColumn("errors", reasons)
        ok = F.size("errors") == 0
        refused = rows.where(~ok & ~F.coalesce(aged | tired, F.lit(False)))
        quarantined = rows.where(~ok).select("shard_id", "sequence_number", "topic", "payload", "errors", "arrival_ms")
        write_batch(quarantined, target.quarantine, batch_id)
        # What ledger and readings are made from is told from copies once, without the columns that are not stored.
        needed = [c for c in rows.columns if c in readings._fields]
        found = new_sequences(rows.where(ok).select(*needed, "payload"), ledger, batch_id)
        found.write.mode("overwrite").parquet(target.fresh)
        fresh = spark.read.schema(found.schema).parquet(target.fresh)
        write_ledger(fresh, ledger, batch_id)
        new = with_keys(unstored(with_event_date(fresh), keys, batch_id))
        readings.put(new, batch_id)
        latency_ms = round((time.monotonic() - started) * 1000)
        # From the stored rows: keys never name a reading that is not there.
        mine = F.col("batch_id") == batch_id
        kept, written = (table.all_rows(spark).where(mine) for table in (readings, ledger))
        keys.put(kept, batch_id)
        write_batch(metrics.processed_per_minute(kept, latency_ms), target.processed, batch_id)
        write_batch(metrics.failures_per_minute(refused, written, kept), target.failures, batch_id)
        # Counted from what was stored, so that the numbers are right after a lost executor or a replay too.
        tally = rows.agg(F.count("*").alias("records"), F.count_if(~ok).alias("quarantined"))
        for stored, name in ((written, "processed"), (kept, "kept")):
            tally = tally.join(stored.agg(F.count("*").alias(name)))
        tally = tally.selectExpr("records", "quarantined", "records - quarantined - processed AS redelivered", "processed - kept AS duplicates", "kept")
        write_batch(tally.where("records > 0"), target.counts, batch_id)
        if batch_id % FOLD_EVERY == FOLD_EVERY - 1:
            # The batches before this one are finished.
            for table in (ledger, keys):
                table.fold(spark, batch_id - 1, LOOSE_BATCHES)

    return run


def last_finished(spark: SparkSession, target: IngestTarget) -> int:
    """The last batch that is never replayed: one after it has been counted.  -1 where there is none."""
    seen = read_or_empty(spark, target.counts, f"{COUNTS}, batch_id bigint").agg(F.max("batch_id")).first()[0]
    return -1 if seen is None else seen - 1


def compact_days(spark: SparkSession, target: IngestTarget, before: date) -> list[date]:
    """Put each closed day (earlier than ``before``) of readings and keys into one partition, between or while batches run."""
    up_to, done = last_finished(spark, target), set()
    for table, order in ((target.readings_table, ("sensorId", "event_ts")), (target.keys_table, ()), (target.ledger_table, ())):
        for day in sorted(d for d in table.partitions(spark) if d < before):
            if table.compact(spark, day, up_to, order):
                done.add(day)
    return sorted(done)


def remove_expired(spark: SparkSession, target: IngestTarget, today: date) -> list[date]:
    """Remove the days of readings that hold no live row as of the start of ``today``, with their keys; returns the days.

    Only days as old as the retention are looked at.  A reading that came late keeps its day until its own time has passed.
    The ledger loses the arrival days that no copy can reach any more.
    """
    first, midnight = first_live_day(today), F.unix_seconds(F.lit(today).cast("timestamp"))
    old = target.readings_table.rows(spark).where(F.col("event_date") < F.lit(first))
    gone = [r.event_date for r in old.groupBy("event_date").agg(F.max("ttl").alias("last")).where(F.col("last") <= midnight).collect()]
    for table in (target.readings_table, target.keys_table):
        table.remove_days(spark, gone)
    ledger = target.ledger_table
    ledger.remove_days(spark, [d for d in ledger.partitions(spark) if d < first])
    return sorted(gone)


def run_dedup(raw: DataFrame, root: str) -> None:
    """One row per sequence number of a shard, over the whole stream: ``root``/rows."""
    ledger = DayTable(f"{root}/ledger", LEDGER, "arrival_day", SEQUENCE_KEY)

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(new_sequences(batch, ledger, batch_id), f"{root}/rows", batch_id)
        # Only this batch's folder is listed; without it the batch had nothing new.
        own = read_or_empty(batch.sparkSession, f"{root}/rows/batch_id={batch_id}", LEDGER)
        write_ledger(own, ledger, batch_id)

    run_to_end(raw.writeStream.foreachBatch(run).outputMode("append"), f"{root}/checkpoint")


def run_ingest(raw: DataFrame, target: IngestTarget, as_of_ms: Clock = None, every: str | None = None) -> None:
    """Ingest everything the stream has, or go on with a batch ``every`` so often; safe to stop and start again.

    A job that runs on takes a function for ``as_of_ms``, such as ``lambda: time.time_ns() // 1_000_000``.
    """
    writer = checked_stream(raw).writeStream.foreachBatch(store_batch(target, as_of_ms)).outputMode("append")
    run_to_end(writer, f"{target.checkpoint}/ingest", every)


def run_archive(raw: DataFrame, target: IngestTarget) -> None:
    """Archive every raw record, copies included, by arrival day: for records that no ingest job archives."""
    writer = (
        archive_parts(raw)
        .writeStream.format("json")
        .partitionBy("year", "month", "day")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ARCHIVE_ROWS_PER_FILE)
        .option("path", target.archive)
        .outputMode("append")
    )
    run_to_end(writer, f"{target.checkpoint}/archive")
