"""Case tables as folds of the append-only log of dispatch outcomes.

Nothing is updated in place: a replayed or retried attempt only adds a log row,
and folding the same rows again gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METADATA_ROW = "__metadata__"


def case_metadata(outcomes: DataFrame, acks: DataFrame | None = None) -> DataFrame:
    """One row per case: tier and creation of the first attempt, time of the last."""
    folded = outcomes.groupBy("case_pk").agg(
        F.min_by("severity", F.struct("attempt_no", "severity")).alias("severity"),
        F.min("attempt_ms").alias("created_ms"),
        F.max("attempt_ms").alias("updated_ms"),
    )
    if acks is None:
        return folded.withColumn("resolved_ms", F.lit(None).cast("bigint"))
    resolved = acks.groupBy("case_pk").agg(F.min("ack_ms").alias("resolved_ms"))
    return folded.join(resolved, "case_pk", "left")


def _last(column: str, condition: Column) -> Column:
    """Value of the newest row for which the condition holds, null if there is none."""
    return F.max_by(column, F.when(condition, F.col("attempt_no")))


def case_channels(outcomes: DataFrame) -> DataFrame:
    """One row per case and channel that was ever sent.

    A field that an attempt does not set keeps its older value, so an error
    stays on a row whose next attempt is delivered.  A skipped retry moves the
    update time only; an attempt without a text touches nothing.
    """
    sent = F.col("kind").isin("delivered", "failed")
    touched = sent | (F.col("skip_reason") == "retry_already_delivered")
    rows = outcomes.where(touched)
    return (
        rows.groupBy("case_pk", "channel")
        .agg(
            _last("kind", sent).alias("status"),
            _last("case_id", sent).alias("case_id"),
            _last("external_url", sent & F.col("external_url").isNotNull()).alias("external_url"),
            _last("error", sent & F.col("error").isNotNull()).alias("error"),
            F.min(F.when(sent, F.col("attempt_ms"))).alias("created_ms"),
            F.max("attempt_ms").alias("updated_ms"),
        )
        .where(F.col("status").isNotNull())
    )


def case_lookup(keys: DataFrame, metadata: DataFrame, channels: DataFrame) -> DataFrame:
    """Rows of asked keys (``case_pk``, ``row``), nulls where a key has none."""
    stored = metadata.select(
        "case_pk", F.lit(METADATA_ROW).alias("row"), F.col("severity").alias("state"),
        "created_ms", "updated_ms",
    ).unionByName(
        channels.select(
            "case_pk", F.col("channel").alias("row"), F.col("status").alias("state"),
            "created_ms", "updated_ms",
        )
    )
    return keys.join(stored, ["case_pk", "row"], "left")


def retry_audit(outcomes: DataFrame) -> DataFrame:
    """Compare the email row of a case after its first and its second attempt."""
    first = F.col("attempt_no") == 1
    seen = outcomes.where("channel = 'email' AND attempt_no <= 2")
    sent = F.col("kind").isin("delivered", "failed")
    wide = seen.groupBy("case_pk").agg(
        F.max(F.when(first, F.col("case_id"))).alias("case_id_1"),
        _last("case_id", sent).alias("case_id_2"),
        F.min(F.when(first, F.col("attempt_ms"))).alias("created_1"),
        F.min("attempt_ms").alias("created_2"),
        F.max(F.when(first, F.col("attempt_ms"))).alias("updated_1"),
        F.max("attempt_ms").alias("updated_2"),
        F.count_if(F.col("skip_reason") == "retry_already_delivered").alias("cases_retried"),
        F.max("attempt_no").alias("attempts"),
    )
    return wide.where("attempts = 2").select(
        "case_pk",
        ((F.col("case_id_1") == F.col("case_id_2")) & (F.col("case_id_1") != "")).alias("case_id_stable"),
        (F.col("created_1") == F.col("created_2")).alias("created_unchanged"),
        (F.col("updated_2") > F.col("updated_1")).alias("updated_advanced"),
        "cases_retried",
    )
