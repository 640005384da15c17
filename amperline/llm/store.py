"""Intermediate tables of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from amperline.session import shared_folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: a lost executor does not bring its inputs' work back."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
