"""Telemetry input: stream and batch readers, topic route, payload decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.functions import matches
from amperline.operators.validation import decode_base64

# The topic shape whose second segment names the sensor.
TELEMETRY_TOPIC = r"^sensors/[^/]+/telemetry\z"

RAW_SCHEMA = (
    "shard_id string, sequence_number string, partition_key string, topic string,"
    " arrival_ts timestamp, payload string"
)


def timed(raw: DataFrame) -> DataFrame:
    """With the arrival as epoch milliseconds, which ingest works with."""
    return raw.withColumn("arrival_ms", F.unix_millis("arrival_ts"))


def read_batch(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return timed(spark.read.schema(RAW_SCHEMA).format(fmt).load(path))


def read_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Files of a folder as a stream, oldest first."""
    reader = spark.readStream.schema(RAW_SCHEMA).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return timed(reader.load(path))


def read_kafka(
    spark: SparkSession, servers: str, topic: str, records_per_trigger: int | None = None
) -> DataFrame:
    """A Kafka topic as a stream, from the oldest record.

    Needs Spark's Kafka connector on the class path; the record key carries the
    device topic and the partition stands for the shard.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if records_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", records_per_trigger)
    return timed(reader.load().select(
        F.concat(F.lit("shard-"), F.col("partition").cast("string")).alias("shard_id"),
        F.col("offset").cast("string").alias("sequence_number"),
        F.split_part(F.col("key").cast("string"), F.lit("/"), F.lit(2)).alias("partition_key"),
        F.col("key").cast("string").alias("topic"),
        F.col("timestamp").alias("arrival_ts"),
        F.col("value").cast("string").alias("payload"),
    ))


def topic_sensor(topic: Column) -> Column:
    """The sensor a telemetry topic names, null for any other topic."""
    return F.when(matches(topic, TELEMETRY_TOPIC), F.split_part(topic, F.lit("/"), F.lit(2)))


def route(df: DataFrame) -> DataFrame:
    """Keep telemetry topics; the topic's sensor is the partition key.

    The sensor named by the topic takes the place of the one in the payload:
    pass ``sensor="partition_key"`` to ``validate``.
    """
    return df.where(matches(F.col("topic"), TELEMETRY_TOPIC)).withColumn(
        "partition_key", F.split_part(F.col("topic"), F.lit("/"), F.lit(2))
    )


def decode(df: DataFrame, data: str = "data") -> DataFrame:
    """Base64 data to text in ``payload``; null where it cannot be decoded."""
    return df.withColumn("payload", decode_base64(F.col(data)))
