"""The registry and the enrichment with location."""

import json
import random

import pytest
from pyspark.sql import functions as F

from amperline.operators import location, thresholds
from amperline.sources import registry

ASSET = {
    "assetId": "press-09", "displayName": "Press 09", "assetType": "press", "plantId": "p", "buildingId": "b",
    "floorId": "f", "lineId": "line-1", "cellId": "cell-a", "zoneId": "zone-line-1-cell-a",
    "sensorIds": ["temp-117", "temp-118"], "safetyClassification": "s", "maintenanceOwner": "m",
    "location": {"x": 44.25, "y": 13.75, "rotation": 0, "units": "meters"},
}
FLOOR = {
    "plantId": "p", "buildingId": "b", "floorId": "f", "name": "n", "units": "meters", "width": 100, "height": 50,
    "zones": [
        {"zoneId": "zone-line-1-cell-a", "name": "A", "zoneType": "cell",
         "polygon": [{"x": 40, "y": 10}, {"x": 50, "y": 10}, {"x": 50, "y": 20}, {"x": 40, "y": 20}]},
        {"zoneId": "zone-triangle", "name": "T", "zoneType": "cell",
         "polygon": [{"x": 0, "y": 0}, {"x": 10, "y": 0}, {"x": 0, "y": 10}]},
    ],
}


def mapping(sensor, asset):
    return {"sensorId": sensor, "assetId": asset, "metricType": "temperature", "unit": "degC",
            "normalRange": {"min": 0, "max": 90}, "thresholdRange": {"min": -50, "max": 130}}


@pytest.fixture()
def loaded(spark, folder):
    files = {
        "assets": [ASSET, {**ASSET, "assetId": "no-place", "zoneId": "nowhere", "sensorIds": [], "location": None},
                   {**ASSET, "assetId": "other-unit", "sensorIds": [], "location": {"x": 2, "y": 3, "rotation": 0, "units": "cm"}}],
        "floors": [FLOOR],
        "mappings": [mapping("temp-117", "press-09"), mapping("temp-001", "gone"), mapping("temp-002", "no-place")],
    }
    for name, rows in files.items():
        with open(f"{folder}/{name}.json", "w") as out:
            json.dump(rows, out, indent=1)
    return (registry.load_assets(spark, f"{folder}/assets.json"), registry.load_floor_maps(spark, f"{folder}/floors.json"),
            registry.load_mappings(spark, f"{folder}/mappings.json"))


def test_enrichment(spark, loaded):
    assets, _, mappings = loaded
    events = spark.createDataFrame([(s,) for s in ("temp-117", "temp-001", "temp-002", "temp-999")], "sensorId string")
    rows = {r["sensorId"]: r for r in location.enrich(events, mappings, assets).collect()}
    assert {s: r["enrichmentStatus"] for s, r in rows.items()} == {
        "temp-117": "enriched", "temp-001": "asset_missing", "temp-002": "location_missing", "temp-999": "sensor_unmapped"}
    place = rows["temp-117"]["locationContext"]
    assert (place["zoneId"], place["x"], place["y"], place["floorId"]) == ("zone-line-1-cell-a", 44.25, 13.75, "f")
    assert (rows["temp-117"]["assetId"], rows["temp-117"]["assetName"]) == ("press-09", "Press 09")
    lost = rows["temp-999"]
    assert (lost["assetId"], lost["assetName"], lost["locationContext"]) == ("", "", None)


def test_zone_by_name_and_position(loaded):
    assets, floors, _ = loaded
    named = {r["assetId"]: r["zone_name"] for r in location.asset_zones(assets, floors).collect()}
    assert named == {"press-09": "A", "no-place": None, "other-unit": "A"}
    placed = {r["assetId"]: r["found_zone"] for r in location.zone_by_position(assets, floors).collect()}
    assert placed == {"press-09": "zone-line-1-cell-a", "no-place": None, "other-unit": "zone-triangle"}


def test_integrity(loaded):
    assets, floors, mappings = loaded
    assert [r["sensorId"] for r in location.orphan_sensors(assets, mappings).collect()] == ["temp-118"]
    assert [r["sensorId"] for r in location.missing_assets(mappings, assets).collect()] == ["temp-001"]
    assert [r["assetId"] for r in location.missing_zones(assets, floors).collect()] == ["no-place"]
    assert [r["assetId"] for r in location.unit_mismatches(assets, floors).collect()] == ["other-unit"]


def test_bounds_of_the_sensor_itself(spark, loaded):
    rows = [("temp-117", "temperature", 131.0, "degC"), ("temp-117", "temperature", 130.0, "degC"),
            ("temp-117", "voltage", 900.0, "V"), ("temp-999", "temperature", 900.0, "degC")]
    events = spark.createDataFrame(rows, "sensorId string, readingType string, value double, unit string")
    judged = {(r["sensorId"], r["readingType"], r["value"]): r["exceeded"]
              for r in thresholds.evaluate_per_sensor(events, loaded[2]).collect()}
    assert [judged[r[:3]] for r in rows] == [True, False, False, False]


def test_malformed_registry_fails_loudly(spark, folder):
    with open(f"{folder}/bad.json", "w") as out:
        json.dump([{**ASSET, "location": {"x": "not a number"}}], out)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        registry.load_assets(spark, f"{folder}/bad.json").collect()


def test_missing_fields_and_duplicate_keys_fail_at_load(spark, folder):
    for name, rows in {"missing": [{**ASSET, "zoneId": None}], "twice": [ASSET, {**ASSET, "displayName": "Other"}]}.items():
        with open(f"{folder}/{name}.json", "w") as out:
            json.dump(rows, out)
    with pytest.raises(ValueError, match="zoneId"):
        registry.load_assets(spark, f"{folder}/missing.json")
    with pytest.raises(ValueError, match="more than once"):
        registry.load_assets(spark, f"{folder}/twice.json")
    both = registry.load_assets(spark, f"{folder}/twice.json", unique=False)
    mappings = spark.createDataFrame([("temp-117", "press-09"), ("temp-117", "gone")], "sensorId string, assetId string")
    events = spark.createDataFrame([("temp-117", 1), ("temp-117", 2)], "sensorId string, e int")
    assert location.enrich(events, mappings, both).count() == 2
    assert [tuple(r) for r in location.duplicate_keys(both, "assetId").collect()] == [("press-09", 2)]


def test_concave_polygon(spark):
    shape = [(0, 0), (10, 0), (10, 10), (5, 2), (0, 10)]
    frame = spark.createDataFrame([([{"x": float(x), "y": float(y)} for x, y in shape],)], "p array<struct<x:double,y:double>>")
    def hit(x, y):
        return frame.select(location.inside(F.col("p"), F.lit(x), F.lit(y))).first()[0]
    assert hit(1.0, 5.0) and hit(9.0, 5.0) and not hit(5.0, 5.0) and not hit(11.0, 5.0)


def _floor(zones):
    schema = "plantId string, buildingId string, floorId string, units string, zones array<struct<zoneId: string, name: string, zoneType: string, polygon: array<struct<x: double, y: double>>>>"
    return schema, [("p", "b", f, "m", z) for f, z in zones]


def test_grid_cells_against_all_polygons(spark):
    """Polygons of very different sizes, concave and crossing ones, points on corners and edges; floors that come twice."""
    rnd = random.Random(12)
    zones = []
    for i in range(150):
        cx, cy, r = rnd.uniform(-50, 50), rnd.uniform(-50, 50), 10 ** rnd.uniform(-2, 1.7)
        points = [(round(cx + rnd.uniform(-r, r), 1), round(cy + rnd.uniform(-r, r), 1)) for _ in range(rnd.randint(3, 7))]
        zones.append((f"z{i:03d}", "n", "t", points))
    schema, rows = _floor([("1", zones), ("2", zones[:3]), ("2", zones[:3]), ("3", [("flat", "n", "t", [(1.0, 1.0), (2.0, 1.0), (3.0, 1.0)]), ("none", "n", "t", [])])])
    floors = spark.createDataFrame(rows, schema)
    corners = [p for z in zones[:40] for p in z[3]]
    spots = [(rnd.uniform(-60, 60), rnd.uniform(-60, 60)) for _ in range(400)] + corners + [(None, 1.0), (2.0, 1.0)]
    assets = [(f"a{k % 400}", "p", "b", rnd.choice("1123"), "z", (x, y)) for k, (x, y) in enumerate(spots)]
    frame = spark.createDataFrame(assets, "assetId string, plantId string, buildingId string, floorId string, zoneId string, location struct<x: double, y: double>")

    def holds(points, x, y):
        odd = False
        for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1], strict=True):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                odd = not odd
        return odd

    own = {"1": zones, "2": zones[:3], "3": []}
    want = []
    for name, _, _, floor, _, (x, y) in assets:
        hits = [z[0] for z in own[floor] if x is not None and holds(z[3], x, y)]
        want.append((name, x, y, min(hits, default=None)))
    got = [(r.assetId, r.x, r.y, r.found_zone) for r in location.zone_by_position(frame, floors).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_many_zones_on_one_floor(spark):
    """100,000 zones of one floor: a point meets the few polygons of its cells."""
    zones = spark.range(100_000).selectExpr(
        "'p' AS plantId", "'b' AS buildingId", "'1' AS floorId", "concat('z', id) AS zoneId", "double(id % 400) AS x", "double(id DIV 400) AS y"
    ).selectExpr("plantId", "buildingId", "floorId", "zoneId", "array(struct(x, y), struct(x + 1 AS x, y), struct(x + 1 AS x, y + 1 AS y), struct(x, y + 1 AS y)) AS polygon")
    assets = spark.range(2000).selectExpr("string(id) AS assetId", "'p' AS plantId", "'b' AS buildingId", "'1' AS floorId", "'' AS zoneId", "struct(id % 400 + 0.25 AS x, id % 250 + 0.75 AS y) AS location")
    found = location.zone_by_cell(assets, location.zone_cells(zones))
    assert found.where("found_zone = concat('z', int(floor(x) + 400 * floor(y)))").count() == 2000
