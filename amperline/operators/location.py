"""Asset and location enrichment, and integrity checks of the registry.

Registry tables carry no broadcast hint.  They grow with the fleet, so Spark
decides by their measured size; where it shuffles instead, the adaptive skew
join splits a sensor that sends a large part of all events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLOOR_KEY = ["plantId", "buildingId", "floorId"]
# Polygons smaller than this are indexed as if they had this side.
SMALLEST_SIDE = 1e-6


def one_per_key(rows: DataFrame, *key: str) -> DataFrame:
    """The row with the smallest other values of each key, so that a join with registry rows multiplies nothing."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.to_json(F.struct(*rest))).alias("_row")).select(*key, "_row.*")


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Integrity finding: keys with more than one registry row, and how many."""
    return rows.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def sensor_assets(mappings: DataFrame, assets: DataFrame) -> DataFrame:
    """Per mapped sensor the asset row, with ``has_asset`` false where it is missing."""
    return one_per_key(mappings.select("sensorId", "assetId"), "sensorId").join(
        one_per_key(assets, "assetId").withColumn("has_asset", F.lit(True)), "assetId", "left"
    )


def asset_zones(assets: DataFrame, floors: DataFrame) -> DataFrame:
    """Each asset with the zone its ``zoneId`` names, nulls if its floor has none."""
    zones = floors.select(*FLOOR_KEY, F.explode("zones").alias("zone")).select(
        *FLOOR_KEY,
        F.col("zone.zoneId").alias("zoneId"),
        F.col("zone.name").alias("zone_name"),
        F.col("zone.zoneType").alias("zone_type"),
    )
    return assets.join(one_per_key(zones, *FLOOR_KEY, "zoneId"), [*FLOOR_KEY, "zoneId"], "left")


def enrich(events: DataFrame, mappings: DataFrame, assets: DataFrame) -> DataFrame:
    """Attach asset and location to each event; never drops an event or invents a place."""
    # The registry tables are joined with each other first: they are small, and
    # the events then take one join.
    known = sensor_assets(mappings, assets).select(
        "sensorId",
        F.col("assetId").alias("mapped_asset"),
        F.col("has_asset"),
        F.col("displayName"),
        *FLOOR_KEY, "lineId", "cellId", "zoneId",
        F.col("location.x").alias("x"),
        F.col("location.y").alias("y"),
    )
    joined = events.join(known, "sensorId", "left")
    status = (
        F.when(F.col("mapped_asset").isNull(), F.lit("sensor_unmapped"))
        .when(F.col("has_asset").isNull(), F.lit("asset_missing"))
        .when(F.col("x").isNull() | F.col("y").isNull(), F.lit("location_missing"))
        .otherwise(F.lit("enriched"))
    )
    place = F.struct(*FLOOR_KEY, "lineId", "cellId", "zoneId", "x", "y")
    return joined.withColumn("enrichmentStatus", status).select(
        *events.columns,
        F.coalesce("mapped_asset", F.lit("")).alias("assetId"),
        F.coalesce("displayName", F.lit("")).alias("assetName"),
        F.when(F.col("enrichmentStatus") == "enriched", place).alias("locationContext"),
        "enrichmentStatus",
    )


def enriched_events(breaches: DataFrame, mappings: DataFrame, assets: DataFrame) -> DataFrame:
    """Classified breaches in the form of enriched events: one row each, named by their case key.

    ``threshold`` is the bound that was broken; ``locationContext`` is null unless the place is known.
    """
    placed = enrich(breaches, mappings, assets)
    return placed.select(
        F.col("case_pk").alias("eventId"),
        "sensorId", "assetId", "assetName", "severity",
        F.col("readingType").alias("metricName"),
        F.col("value").alias("metricValue"),
        F.coalesce("broken_min", "broken_max").alias("threshold"),
        "timestamp", "locationContext", "enrichmentStatus",
    )


def orphan_sensors(assets: DataFrame, mappings: DataFrame) -> DataFrame:
    """Sensors an asset claims that have no mapping."""
    claimed = assets.select(F.explode("sensorIds").alias("sensorId"), "assetId")
    return claimed.join(mappings, "sensorId", "left_anti")


def missing_assets(mappings: DataFrame, assets: DataFrame) -> DataFrame:
    """Mappings that name an asset without a row."""
    return mappings.join(assets, "assetId", "left_anti").select("sensorId", "assetId")


def missing_zones(assets: DataFrame, floors: DataFrame) -> DataFrame:
    """Assets whose zone is not on their floor."""
    zones = floors.select(*FLOOR_KEY, F.explode("zones").alias("zone")).select(
        *FLOOR_KEY, F.col("zone.zoneId").alias("zoneId")
    )
    return assets.join(zones, [*FLOOR_KEY, "zoneId"], "left_anti").select("assetId", "zoneId")


def unit_mismatches(assets: DataFrame, floors: DataFrame) -> DataFrame:
    """Assets measured in another unit than their floor."""
    named = one_per_key(floors.select(*FLOOR_KEY, F.col("units").alias("floor_units")), *FLOOR_KEY)
    return (
        assets.join(named, FLOOR_KEY)
        .where(F.col("location.units") != F.col("floor_units"))
        .select("assetId", F.col("location.units").alias("asset_units"), "floor_units")
    )


def inside(polygon: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in a polygon: a ray to the right crosses an odd number of edges."""
    count = F.size(polygon)

    def crossed(i: Column) -> Column:
        a = F.element_at(polygon, i)
        b = F.element_at(polygon, F.when(i == count, F.lit(1)).otherwise(i + 1))
        spans = (a["y"] > y) != (b["y"] > y)
        at = a["x"] + F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"])
        return spans & (x < at)

    return F.size(F.filter(F.sequence(F.lit(1), count), crossed)) % 2 == 1


def zones_of(floors: DataFrame) -> DataFrame:
    """``zoneId, polygon`` of each floor, one row per zone."""
    zones = floors.select(*FLOOR_KEY, F.explode("zones").alias("zone"))
    return zones.select(*FLOOR_KEY, F.col("zone.zoneId").alias("zoneId"), F.col("zone.polygon").alias("polygon"))


def zone_cells(zones: DataFrame) -> DataFrame:
    """A grid index of polygons: ``level, cx, cy, zoneId`` and, where an edge may cross the cell, the polygon.

    Cells are squares of 2 ** ``level``; each polygon takes the level at which its longer side spans about eight of them, so a
    polygon of any size has at most 17 x 17 cells.  A cell no edge comes near lies wholly inside or outside; outer
    ones are left out, and inner ones need no test of their points.
    """
    xs, ys = F.col("polygon.x"), F.col("polygon.y")
    boxed = zones.where(F.size("polygon") >= 3).select(
        "*", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1")
    )
    longer = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(SMALLEST_SIDE))
    sized = boxed.withColumn("level", (F.ceil(F.log2(longer)) - 3).cast("int")).withColumn("side", F.pow(F.lit(2.0), F.col("level")))

    def steps(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(low) / F.col("side")), F.floor(F.col(high) / F.col("side"))))

    cells = sized.withColumn("cx", steps("x0", "x1")).withColumn("cy", steps("y0", "y1"))
    polygon, side, count = F.col("polygon"), F.col("side"), F.size("polygon")

    def near(i: Column) -> Column:
        a = F.element_at(polygon, i)
        b = F.element_at(polygon, F.when(i == count, F.lit(1)).otherwise(i + 1))
        hits = [
            (F.least(a[c], b[c]) <= (F.col(k) + 1) * side) & (F.greatest(a[c], b[c]) >= F.col(k) * side)
            for c, k in (("x", "cx"), ("y", "cy"))
        ]
        return hits[0] & hits[1]

    crossed = F.exists(F.sequence(F.lit(1), count), near)
    centre = [(F.col(k) + 0.5) * side for k in ("cx", "cy")]
    kept = cells.withColumn("crossed", crossed).where(F.col("crossed") | inside(polygon, *centre))
    return kept.select(*FLOOR_KEY, "level", "cx", "cy", "zoneId", F.when(F.col("crossed"), polygon).alias("polygon"))


def zone_by_position(assets: DataFrame, floors: DataFrame) -> DataFrame:
    """Zone that holds each asset's position, the first by id if several do.

    Assets and zones meet on floor and grid cell, at each of the few levels a floor has, so no task holds all polygons of a
    floor; only assets in a cell that an edge may cross are tested against the polygon.
    """
    return zone_by_cell(assets, zone_cells(zones_of(floors)))


def zone_by_cell(assets: DataFrame, cells: DataFrame) -> DataFrame:
    x, y = F.col("location.x"), F.col("location.y")
    placed = assets.select("assetId", *FLOOR_KEY, x.alias("x"), y.alias("y")).where("x IS NOT NULL AND y IS NOT NULL").distinct()
    levels = cells.select(*FLOOR_KEY, "level").distinct()
    side = F.pow(F.lit(2.0), F.col("level"))
    points = placed.join(levels, FLOOR_KEY).withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    met = points.join(cells, [*FLOOR_KEY, "level", "cx", "cy"])
    hits = met.where(F.col("polygon").isNull() | inside(F.col("polygon"), F.col("x"), F.col("y")))
    keys = ["assetId", *FLOOR_KEY, "x", "y"]
    found = hits.groupBy(*[F.col(k).alias(f"its_{k}") for k in keys]).agg(F.min("zoneId").alias("found_zone"))
    named = assets.select("assetId", *FLOOR_KEY, F.col("zoneId").alias("named_zone"), x.alias("x"), y.alias("y"))
    same = F.col("assetId").eqNullSafe(F.col("its_assetId"))
    for k in keys[1:]:
        same &= F.col(k) == F.col(f"its_{k}")
    return named.join(found, same, "left").select("assetId", "named_zone", "x", "y", "found_zone")
