"""Asset registry files.  Malformed files, missing fields and duplicate keys fail at load, not at lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The members of the registry files.
ASSETS = (
    "assetId string, displayName string, assetType string, plantId string, buildingId string,"
    " floorId string, lineId string, cellId string, zoneId string, sensorIds array<string>,"
    " connectedPlcId string, safetyClassification string, maintenanceOwner string,"
    " location struct<x: double, y: double, rotation: double, units: string>"
)
FLOOR_MAPS = (
    "plantId string, buildingId string, floorId string, name string, units string,"
    " width double, height double, zones array<struct<zoneId: string, name: string,"
    " zoneType: string, polygon: array<struct<x: double, y: double>>>>"
)
MAPPINGS = (
    "sensorId string, assetId string, metricType string, unit string,"
    " normalRange struct<min: double, max: double>,"
    " thresholdRange struct<min: double, max: double>"
)


def _load(
    spark: SparkSession, path: str, schema: str, key: tuple[str, ...], required: tuple[str, ...], lines: bool, unique: bool
) -> DataFrame:
    """A registry file, or a folder of files with one object a line.

    A row without a required field fails the load, and so do two rows of one key unless ``unique`` is off: then
    ``operators.location`` takes one of them and reports the key.
    """
    rows = spark.read.schema(schema).option("multiLine", not lines).option("mode", "FAILFAST").json(path)
    missing = F.concat_ws(",", *(F.when(F.col(c).isNull(), F.lit(c)) for c in (*key, *required)))
    broken = rows.withColumn("missing", missing).where("missing <> ''").select(*key, "missing").head(5)
    if broken:
        raise ValueError(f"{path}: fields are missing: {broken}")
    if unique and (twice := rows.groupBy(*key).count().where("count > 1").head(5)):
        raise ValueError(f"{path}: keys occur more than once: {twice}")
    return rows


def load_assets(spark: SparkSession, path: str, lines: bool = False, unique: bool = True) -> DataFrame:
    required = ("displayName", "plantId", "buildingId", "floorId", "zoneId", "sensorIds")
    return _load(spark, path, ASSETS, ("assetId",), required, lines, unique)


def load_floor_maps(spark: SparkSession, path: str, lines: bool = False, unique: bool = True) -> DataFrame:
    return _load(spark, path, FLOOR_MAPS, ("plantId", "buildingId", "floorId"), ("units", "zones"), lines, unique)


def load_mappings(spark: SparkSession, path: str, lines: bool = False, unique: bool = True) -> DataFrame:
    return _load(spark, path, MAPPINGS, ("sensorId",), ("assetId", "metricType", "unit"), lines, unique)
