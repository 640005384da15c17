"""Running streams to the end of their input, and replay-safe batch writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state outside the heap: the sequence ledger spans 25 hours of records."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def write_batch(df: DataFrame, path: str, batch_id: int, *parts: str) -> None:
    """Write one micro-batch into partitions of its own.

    A replayed batch overwrites what its first try left and nothing else.  The
    rebalance keeps one task's rows of a partition in one file, and splits a
    partition that is too large for one.
    """
    rows = df.hint("rebalance", *parts) if parts else df
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts, "batch_id")
        .parquet(path)
    )


def read_or_empty(
    spark: SparkSession, path: str, schema: str, globs: Sequence[str] | None = None
) -> DataFrame:
    """A parquet folder, or parts of it, or an empty frame where nothing is stored yet."""
    reader = spark.read.schema(schema)
    try:
        if globs is None:
            return reader.parquet(path)
        return reader.option("basePath", path).parquet(*[f"{path}/{g}" for g in globs])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_to_end(writer, checkpoint: str, every: str | None = None) -> None:
    """Process all input there is, then stop; with ``every`` ("1 second") run on until stopped.  Raises if the stream failed."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    query = writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    query.awaitTermination()
