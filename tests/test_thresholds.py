import pytest
from pyspark.sql import functions as F

from amperline.functions import case_key, number_text
from amperline.operators import routing, severity, thresholds


def judged(spark, rows, **kw):
    frame = spark.createDataFrame(rows, "readingType string, value double, unit string")
    return thresholds.evaluate(frame, **kw).collect()


@pytest.mark.parametrize(
    "kind, inside, outside",
    [("voltage", [114, 115, 120, 125, 126], [113.9, 126.1, 0]),
     ("frequency", [59.5, 60, 60.5], [59.4, 60.6])],
)
def test_boundaries(spark, kind, inside, outside):
    rows = judged(spark, [(kind, float(x), "u") for x in inside + outside])
    assert [r["exceeded"] for r in rows] == [False] * len(inside) + [True] * len(outside)


def test_types_without_bounds_never_breach(spark):
    rows = judged(spark, [(k, 9999.0, "u") for k in ("current", "power_factor", "temperature")])
    assert not any(r["exceeded"] for r in rows)
    assert rows[0]["details"] == "current: no threshold configured"


def test_details_and_broken_bound(spark):
    low, high, ok = judged(
        spark, [("voltage", 113.9, "V"), ("voltage", 130.0, "V"), ("frequency", 60.0, "Hz")]
    )
    assert (low["details"], low["broken_min"], low["broken_max"]) == (
        "voltage=113.9V below min 114", 114.0, None)
    assert (high["details"], high["broken_min"], high["broken_max"]) == (
        "voltage=130V above max 126", None, 126.0)
    assert ok["details"] == "frequency=60Hz within [59.5, 60.5]"


def test_other_bounds(spark):
    loose = judged(spark, [("voltage", 130.0, "V")], bounds={"voltage": (100, 140)})
    tight = judged(spark, [("voltage", 122.0, "V")], bounds={"voltage": (119, 121)})
    assert (loose[0]["exceeded"], tight[0]["exceeded"], tight[0]["broken_max"]) == (False, True, 121.0)


@pytest.mark.parametrize(
    "value, text",
    [(109.0, "109"), (0.0, "0"), (-0.0, "0"), (113.9, "113.9"), (-5.25, "-5.25"), (1e7, "10000000"),
     (12345678.9, "12345678.9"), (1.5e20, "150000000000000000000"), (1e21, "1e+21"),
     (1.5e300, "1.5e+300"), (0.0005, "0.0005"), (1e-6, "0.000001"), (1.5e-6, "0.0000015"),
     (5e-7, "5e-7"), (-2e-7, "-2e-7"), (100.0, "100"), (1200.0, "1200")],
)
def test_number_text(spark, value, text):
    frame = spark.createDataFrame([(value,)], "x double")
    assert frame.select(number_text("x")).first()[0] == text


@pytest.mark.parametrize(
    "kind, value, tier",
    [("voltage", 95.0, "P0"), ("frequency", 58.2, "P1"), ("voltage", 130.0, "P2"),
     ("voltage", 113.0, "P3"), ("voltage", 99.0, "P1"), ("voltage", 106.0, "P1"),
     ("frequency", 62.5, "P1"), ("frequency", 62.6, "P0"), ("frequency", 61.0, "P2"),
     ("frequency", 60.9, "P3")],
)
def test_tiers(spark, kind, value, tier):
    frame = spark.createDataFrame([(kind, value, "u")], "readingType string, value double, unit string")
    row = severity.classify(thresholds.evaluate(frame)).first()
    assert row["severity"] == tier
    assert 10 <= len(row["reasoning"]) <= 500


def test_confidence_is_lower_near_an_edge(spark):
    frame = spark.createDataFrame(
        [("voltage", 130.0, "V"), ("voltage", 132.0, "V")], "readingType string, value double, unit string"
    )
    rows = severity.classify(thresholds.evaluate(frame)).collect()
    assert [r["confidence"] for r in rows] == [0.7, 0.95]


def test_non_breaches_are_not_classified(spark):
    frame = spark.createDataFrame([("voltage", 120.0, "V")], "readingType string, value double, unit string")
    row = severity.classify(thresholds.evaluate(frame)).first()
    assert (row["severity"], row["confidence"], row["reasoning"]) == (None, None, None)


def test_answer_audit(spark):
    rows = [("P1", 0.9, "x" * 10), ("P9", 0.9, "x" * 10), ("P1", 1.01, "x" * 10), ("P1", -0.1, "x" * 10),
            ("P1", 1.0, "x" * 500), ("P1", 0.0, "x" * 501), ("P1", 0.5, "x" * 9), (None, None, None)]
    frame = spark.createDataFrame(rows, "answer_severity string, confidence double, reasoning string")
    found = [r["errors"] for r in severity.audit_answers(frame).collect()]
    assert found == [[], ["severity"], ["confidence"], ["confidence"], [], ["reasoning"], ["reasoning"],
                     ["severity", "confidence", "reasoning"]]


def test_plan_audit(spark):
    rows = [(True, False, False, None), (True, True, True, None), (True, True, True, "too short"),
            (True, True, True, "three breaches in 30 minutes"), (True, None, False, None),
            (True, True, False, "short")]
    frame = spark.createDataFrame(
        rows, "email boolean, sms boolean, override_applied boolean, override_reason string"
    )
    found = [r["errors"] for r in routing.audit_plans(frame).collect()]
    assert found == [[], ["overrideReason"], ["overrideReason"], [], ["sms"], ["overrideReason"]]


def breaches(spark, rows):
    frame = spark.createDataFrame(rows, "e int, sensorId string, gridZone string, at string, severity string")
    return frame.withColumn("event_ts", F.col("at").cast("timestamp"))


def test_third_breach_in_half_an_hour_raises_sms(spark):
    rows = [(i, "sensor-1", "z", f"2024-01-01T12:{m:02d}:00Z", "P2") for i, m in enumerate((0, 20, 29, 59))]
    plan = {r["e"]: r for r in routing.routing_plan(breaches(spark, rows)).collect()}
    assert [plan[i]["sms"] for i in range(4)] == [False, False, True, False]
    assert plan[2]["override_reason"].startswith("3 breaches of this sensor in 30 minutes")


def test_cascade_and_quiet_hours(spark):
    cascade = [(i, f"sensor-{i}", "z1", f"2024-01-01T12:0{i}:00Z", "P3") for i in range(3)]
    quiet = [(7, "sensor-7", "z2", "2024-01-01T03:00:00Z", "P2"), (8, "sensor-8", None, "2024-01-01T03:00:00Z", "P3")]
    plan = {r["e"]: r for r in routing.routing_plan(breaches(spark, cascade + quiet)).collect()}
    assert [plan[e]["override_applied"] for e in (0, 1, 2, 7, 8)] == [True, True, True, True, False]
    assert plan[7]["override_reason"] == "breach outside staffed hours"


def test_first_rank_tiers_are_no_override(spark):
    plan = routing.routing_plan(breaches(spark, [(1, "sensor-1", "z", "2024-01-01T03:00:00Z", "P0")])).first()
    assert (plan["sms"], plan["override_applied"], plan["override_reason"]) == (True, False, None)


def test_case_key_needs_all_parts(spark):
    frame = spark.createDataFrame([("a", "b", "c"), ("", "b", "c"), ("a", None, "c")], "x string, y string, z string")
    keys = [r[0] for r in frame.select(case_key(F.col("x"), F.col("y"), F.col("z"))).collect()]
    assert keys == ["a#b#c", None, None]
