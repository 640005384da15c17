"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results, so every entry point applies them.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that change plans only.  Values the cluster already set are kept.
ADVISED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere."""
    for name, value in REQUIRED.items():
        spark.conf.set(name, value)
    given = spark.conf.getAll
    for name, value in ADVISED.items():
        if name not in given:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, app: str = "amperline") -> SparkSession:
    """A one-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores).replace("*", "8"))
        .config("spark.driver.memory", "12g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For a small extract of a large scan that several branches of a plan use: the
    scan runs once, later joins see the extract's true size, and a lost executor
    does not bring the scan back.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Without the setting only a session that runs on one machine gets a folder, as in tests: elsewhere each executor
    would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
