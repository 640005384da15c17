"""Dead-letter envelopes: inspection and ops alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.operators.payloads import SUBJECT_LENGTH

# The member names and types of a dead-letter envelope.
ENVELOPE = (
    "requestContext struct<requestId: string, functionArn: string, condition: string,"
    " approximateInvokeCount: bigint>,"
    " responseContext struct<statusCode: int, executedVersion: string, functionError: string>,"
    " KinesisBatchInfo struct<shardId: string, startSequenceNumber: string,"
    " endSequenceNumber: string, approximateArrivalOfFirstRecord: string,"
    " approximateArrivalOfLastRecord: string, batchSize: bigint, streamArn: string>,"
    " _broken string"
)
# Fixed value: what an ops alert says about replay.
REPLAY_POLICY = "manual triage required (REPLAY_TO_KINESIS not set)"


def inspect(messages: DataFrame) -> DataFrame:
    """Reason, sequence range and size of each dead-lettered batch.

    A body that is not JSON is read as an empty envelope, not as an error.
    """
    parsed = F.from_json(
        F.col("body"),
        ENVELOPE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"},
    )
    env = F.when(parsed["_broken"].isNull(), parsed)
    opened = messages.withColumn("env", env)
    batch = F.col("env.KinesisBatchInfo")
    def part(name: str):
        return F.coalesce(batch[name], F.lit("undefined"))

    return opened.select(
        *messages.columns,
        F.coalesce(
            F.col("env.responseContext.functionError"),
            F.col("env.requestContext.condition"),
            F.lit("unknown"),
        ).alias("reason"),
        F.when(
            batch.isNotNull(),
            F.concat(part("startSequenceNumber"), F.lit(".."), part("endSequenceNumber")),
        ).otherwise(F.lit("unknown")).alias("sequence_range"),
        F.coalesce(batch["batchSize"], F.lit(1)).alias("batch_size"),
        F.coalesce(F.col("env.requestContext.approximateInvokeCount"), F.lit(0)).alias("invoke_count"),
        batch["streamArn"].alias("stream_arn"),
        F.col("env.requestContext.functionArn").alias("function_arn"),
    )


def ops_alerts(inspected: DataFrame, pipeline: str = "Telemetry pipeline") -> DataFrame:
    """One ops alert per inspected message; messages whose inspection failed get none.

    ``pipeline`` is the name the subject carries.
    """
    subject = F.concat(
        F.lit(f"[DLQ] {pipeline}: "),
        F.col("batch_size").cast("string"),
        F.lit(" record(s) dead-lettered"),
    )
    body = F.struct(
        F.lit("P3").alias("severity"),
        "reason",
        F.col("sequence_range").alias("sequenceRange"),
        F.col("batch_size").alias("batchSize"),
        F.col("invoke_count").alias("approximateInvokeCount"),
        F.col("message_id").alias("sqsMessageId"),
        F.col("stream_arn").alias("streamArn"),
        F.col("function_arn").alias("functionArn"),
        F.lit(REPLAY_POLICY).alias("replayPolicy"),
    )
    return inspected.where(F.col("inspection") != "failed").select(
        "message_id",
        "received_ms",
        F.substring(subject, 1, SUBJECT_LENGTH).alias("subject"),
        F.to_json(body).alias("message"),
    )


def still_queued(messages: DataFrame) -> DataFrame:
    """Messages whose inspection failed; they stay for another try."""
    return messages.where(F.col("inspection") == "failed").select(
        F.col("message_id").alias("item_identifier"), "received_ms"
    )
