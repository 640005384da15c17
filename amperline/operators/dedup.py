"""De-duplication, ingest control, ordering and expiry of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The stream keeps a record for 24 hours and the sequence ledger
# remembers it one hour longer, so a redelivery always meets its first copy.
STREAM_RETENTION_HOURS = 24
LEDGER_HOURS = 25
# A record is given up after this many tries or at this age.
MAX_ATTEMPTS = 5
MAX_AGE_HOURS = 24

SEQUENCE_KEY = ("shard_id", "sequence_number")
NATURAL_KEY = ("sensorId", "timestamp", "readingType")
# What a record carries besides its parsed reading.
RAW_COLUMNS = ("payload", "topic", "partition_key", "errors")
ARRIVAL = ("arrival_ms", "shard_id", "sequence_number")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in arrival order.

    An aggregate and not a window: each task keeps one row per key before the
    shuffle, so a key with very many copies sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*").select(*df.columns)


def drop_redelivered(df: DataFrame) -> DataFrame:
    """First layer: one row per sequence number of a shard.  Silent by design.

    The record's raw columns don't go on: of copies that arrive at one time a hash of the payload decides, so the payload
    itself stays out of both shuffles.
    """
    narrow = df.withColumn("payload_hash", F.xxhash64("payload")).drop(*RAW_COLUMNS)
    return first_per_key(narrow, SEQUENCE_KEY, ("arrival_ms", "payload_hash")).drop("payload_hash")


def first_writes(valid: DataFrame) -> DataFrame:
    """Second layer: the first write of a natural key wins, later ones are no-ops."""
    return first_per_key(valid, NATURAL_KEY, ARRIVAL)


def duplicate_writes(valid: DataFrame) -> DataFrame:
    """Per sensor, the writes that found their key already stored."""
    per_key = valid.groupBy(*NATURAL_KEY).agg(F.count("*").alias("n"))
    return (
        per_key.groupBy("sensorId")
        .agg((F.sum("n") - F.count("*")).alias("duplicates"), F.sum("n").alias("writes"))
        .where("duplicates > 0")
    )


def batch_failures(checked: DataFrame) -> DataFrame:
    """Per batch, how many records failed; batches without failures included."""
    failed = F.size("errors") > 0
    return checked.groupBy("batch_id").agg(
        F.count("*").alias("records"), F.count_if(failed).alias("failures")
    )


def failed_items(checked: DataFrame) -> DataFrame:
    """The item identifiers a batch reports back, one row each."""
    return checked.where(F.size("errors") > 0).select(
        "batch_id", F.col("sequence_number").alias("item_identifier")
    )


def is_exhausted(attempts: Column, arrival_ms: Column, as_of_ms: int) -> Column:
    oldest = as_of_ms - MAX_AGE_HOURS * 3_600_000
    return (attempts > MAX_ATTEMPTS) | (arrival_ms < oldest)


def dead_letters(failed: DataFrame, as_of_ms: int) -> DataFrame:
    """Failed records with the route they take: another try, or the dead letters."""
    gone = is_exhausted(F.col("attempts"), F.col("arrival_ms"), as_of_ms)
    return failed.withColumn("route", F.when(gone, "dead_letter").otherwise("retry"))


def stream_order(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows of one sensor together and in arrival order, for an ordered export.

    Range partitioning on sensor and arrival splits a busy sensor over several
    tasks and still keeps the order across and within files.
    """
    keys = ("sensorId", "arrival_ms", "sequence_number")
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    block: Column,
    name: str = "previous",
) -> DataFrame:
    """``lag`` of a column per key without putting a whole key into one task.

    ``block`` numbers stretches of the order.  A window runs within key and
    block.  Only the first row of a block lacks its predecessor; it is found
    among the first and last rows of all blocks, at most two per block.  Both
    parts read the same shuffle, so the input is computed once.
    """
    within = Window.partitionBy(key, "_block").orderBy(*order)
    local = df.withColumn("_block", block).select(
        "*",
        F.lag(value).over(within).alias(name),
        (F.row_number().over(within) == 1).alias("_first"),
        F.lead(F.lit(1)).over(within).isNull().alias("_last"),
    )
    helpers = ("_block", "_first", "_last")
    across = Window.partitionBy(key).orderBy("_block", *order)
    edges = local.where("_first OR _last").withColumn(name, F.lag(value).over(across))
    return (
        local.where("NOT _first")
        .drop(*helpers)
        .unionByName(edges.where("_first").drop(*helpers))
    )


def out_of_order(df: DataFrame, block_ms: int = 60_000) -> DataFrame:
    """Records whose event time is before that of the sensor's previous arrival."""
    timed = df.withColumn("event_ms", F.unix_millis("event_ts"))
    block = F.floor(F.col("arrival_ms") / block_ms)
    order = ("arrival_ms", "sequence_number")
    stepped = with_previous(timed, "sensorId", order, "event_ms", block, "previous_ms")
    return stepped.where(F.col("event_ms") < F.col("previous_ms"))


def active_readings(readings: DataFrame, as_of_seconds: int) -> DataFrame:
    """Readings whose time to live has not passed."""
    return readings.where(F.col("ttl") > as_of_seconds)
