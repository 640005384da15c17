"""Case rows kept up to date by a stream of dispatch outcomes and acknowledgements.

Each stored row is a partial fold: every field is a minimum or a maximum over the log rows so far, so folds merge in any
order and folding a row twice changes nothing.  Rows lie in hash buckets of the case; a micro-batch reads and rewrites only
the buckets it touches.  A bucket has two slots: a batch writes into the one that does not hold the newest version from before it.
So a batch that breaks off or is replayed still finds what it started from, and a bucket never keeps more than two versions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.operators.cases import METADATA_ROW
from amperline.streaming.jobs import read_or_empty, run_to_end

_TEXTS = ("status", "case_id", "external_url", "error")
_LEAST = ("first", "created_ms", "resolved_ms")
_MOST = ("updated_ms", *_TEXTS)
_SCHEMA = (
    "case_pk string, row string, first struct<attempt_no: bigint, severity: string>, created_ms bigint, resolved_ms bigint, updated_ms bigint, "
    + ", ".join(f"{c} struct<attempt_no: bigint, value: string>" for c in _TEXTS)
    + ", batch_id bigint, bucket int, slot int"
)


def case_log(outcomes: DataFrame, acks: DataFrame) -> DataFrame:
    """Outcomes and acknowledgements as rows of one log."""
    return outcomes.unionByName(acks.select("case_pk", "ack_ms"), allowMissingColumns=True)


def _folded(rows: DataFrame) -> DataFrame:
    """One row per case and row name, of log rows or of earlier folds."""
    return rows.groupBy("case_pk", "row").agg(*(F.min(c).alias(c) for c in _LEAST), *(F.max(c).alias(c) for c in _MOST))


def _at(column: str, condition: Column) -> Column:
    return F.when(condition, F.struct(F.col("attempt_no").cast("bigint").alias("attempt_no"), F.col(column).alias("value")))


def partial_rows(log: DataFrame) -> DataFrame:
    """The fold of some rows of the log: a metadata row per case, a row per case and channel."""
    sent = F.coalesce(F.col("kind").isin("delivered", "failed"), F.lit(False))
    touched = sent | F.coalesce(F.col("skip_reason") == "retry_already_delivered", F.lit(False))
    attempted = F.col("attempt_no").isNotNull()
    time = F.col("attempt_ms").cast("bigint")
    nothing = F.lit(None)
    case = F.struct(
        F.lit(METADATA_ROW).alias("row"),
        F.when(attempted, F.struct(F.col("attempt_no").cast("bigint").alias("attempt_no"), "severity")).alias("first"),
        time.alias("created_ms"), F.col("ack_ms").cast("bigint").alias("resolved_ms"), time.alias("updated_ms"),
        *(_at("kind", F.lit(False)).alias(c) for c in _TEXTS),
    )
    channel = F.struct(
        F.col("channel").alias("row"),
        F.when(nothing.cast("boolean"), F.struct(F.col("attempt_no").cast("bigint").alias("attempt_no"), "severity")).alias("first"),
        F.when(sent, time).alias("created_ms"), nothing.cast("bigint").alias("resolved_ms"), time.alias("updated_ms"),
        _at("kind", sent).alias("status"),
        *(_at(c, sent & F.col(c).isNotNull()).alias(c) for c in ("case_id", "external_url", "error")),
    )
    rows = log.select("case_pk", F.explode(F.array_compact(F.array(case, F.when(touched, channel)))).alias("x")).select("case_pk", "x.*")
    return _folded(rows)


def store_cases(root: str, buckets: int = 64):
    """The work of one micro-batch of the log.  The driver sees one row per touched bucket, ``buckets`` at most."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.expr(f"CAST(pmod(xxhash64(case_pk), {buckets}) AS INT)")
        batch = batch.persist()
        touched = [r.b for r in batch.select(bucket.alias("b")).distinct().collect()]
        if touched:
            before = read_or_empty(spark, f"{root}/rows", _SCHEMA).where(F.col("bucket").isin(touched) & (F.col("batch_id") < batch_id))
            newest = before.groupBy("bucket").agg(F.max_by("slot", "batch_id").alias("slot")).collect()
            taken = [r.bucket for r in newest if r.slot == 0]
            # An older version is contained in the newer one, so it may be merged as well.
            merged = _folded(partial_rows(batch).unionByName(before.drop("batch_id", "bucket", "slot")))
            merged = merged.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn("bucket", bucket)
            slot = F.when(F.col("bucket").isin(taken), 1).otherwise(0) if taken else F.lit(0)
            (
                merged.withColumn("slot", slot).repartition("bucket").sortWithinPartitions("case_pk", "row")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "slot").parquet(f"{root}/rows")
            )
        batch.unpersist()

    return run


def run_cases(log: DataFrame, root: str, every: str | None = None, buckets: int = 64) -> None:
    """Fold a stream of the log (see ``case_log``) into the case rows under ``root``."""
    run_to_end(log.writeStream.foreachBatch(store_cases(root, buckets)), f"{root}/checkpoint", every)


def current_cases(spark: SparkSession, root: str) -> DataFrame:
    """The rows as of the last batch, metadata and channels: case_pk, row, state, case_id, external_url, error and times.

    A case that has acknowledgements and no attempt yet, and a channel that was never sent, have no row.
    """
    stored = read_or_empty(spark, f"{root}/rows", _SCHEMA)
    rows = _folded(stored).where("first IS NOT NULL OR status IS NOT NULL")
    return rows.select(
        "case_pk", "row", F.coalesce("first.severity", "status.value").alias("state"),
        *(F.col(f"{c}.value").alias(c) for c in _TEXTS[1:]), "created_ms", "updated_ms", "resolved_ms",
    )
