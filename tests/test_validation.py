import json

import pytest

from amperline.operators import validation as v

GOOD = {
    "sensorId": "sensor-north-7",
    "timestamp": "2025-11-19T12:00:00Z",
    "readingType": "voltage",
    "value": 120.0,
    "unit": "V",
    "gridZone": "zone-1",
}


def errors(spark, *payloads):
    rows = [(i, p if isinstance(p, str) or p is None else json.dumps(p)) for i, p in enumerate(payloads)]
    checked = v.validate(spark.createDataFrame(rows, "i int, payload string"))
    return [r["errors"] for r in sorted(checked.collect(), key=lambda r: r["i"])]


def changed(**fields):
    return {**GOOD, **fields}


def without(field):
    return {k: x for k, x in GOOD.items() if k != field}


def test_good_events(spark):
    good = [
        GOOD,
        without("gridZone"),
        changed(timestamp="2025-11-19T08:00:00-04:00"),
        changed(timestamp="2025-11-19T08:00:00.123Z"),
        changed(value=3),
        changed(value=-1.5e300),
        changed(gridZone="zone {1}"),
        changed(unit="u" * 16),
        "  " + json.dumps(GOOD) + "\n",
    ]
    assert errors(spark, *good) == [[]] * len(good)


@pytest.mark.parametrize(
    "field, values",
    [
        ("sensorId", ["sensor_abc", "Sensor-abc", "sensor-abc!", "sensor-", "", "random-id",
                      "SENSOR-001", "sensor-a\n", 7, None]),
        ("timestamp", ["2025-11-19 12:00:00", "2026/05/08T12:00:00Z", "yesterday", "",
                       "2026-02-30T12:00:00Z", "2025-11-19T12:00:00", "2025-11-19T25:00:00Z", 5]),
        ("readingType", ["power", "humidity", "PRESSURE", "", 42, None]),
        ("value", ["120", None, True, [1]]),
        ("unit", ["u" * 17, "", 3]),
        ("gridZone", [None, "", "z" * 65, 4]),
    ],
)
def test_bad_fields(spark, field, values):
    found = errors(spark, *[changed(**{field: x}) for x in values])
    assert found == [[field]] * len(values)


def test_missing_and_extra_keys(spark):
    found = errors(spark, *[without(f) for f in v.REQUIRED_FIELDS], changed(attacker="payload"))
    assert found == [[f] for f in v.REQUIRED_FIELDS] + [["unrecognized_keys"]]


def test_values_beyond_json(spark):
    huge = json.dumps(GOOD).replace("120.0", "1e400")
    assert errors(spark, huge) == [["value"]]


def test_not_objects(spark):
    whole = json.dumps(GOOD)
    bad = [
        None, "", "null", "42", "[]", '"text"', whole[:40], whole + " x", whole + "}", whole + "," + whole,
        whole + "]", whole[:-1] + ',"gridZone":"{"} x', "{'a':1}", json.dumps(GOOD).replace("120.0", "NaN"),
    ]
    assert errors(spark, *bad) == [["not_an_object"]] * len(bad)


def test_last_duplicate_key_counts(spark):
    twice = json.dumps(GOOD)[:-1] + ',"value":"text"}'
    assert errors(spark, twice) == [["value"]]


def test_one_bad_row_leaves_others(spark):
    rows = [(1, json.dumps(GOOD)), (2, "{"), (3, json.dumps(GOOD))]
    checked = v.validate(spark.createDataFrame(rows, "i int, payload string"))
    assert sorted(r["i"] for r in v.valid_rows(checked).collect()) == [1, 3]
    assert [r["i"] for r in v.rejected_rows(checked).collect()] == [2]


def test_sensor_from_topic_wins(spark):
    rows = [("sensor-1", json.dumps(changed(sensorId="BAD"))), ("BAD", json.dumps(GOOD)),
            ("sensor-2", json.dumps(without("sensorId")))]
    checked = v.validate(spark.createDataFrame(rows, "key string, payload string"), sensor="key")
    found = {r["key"]: (r["sensorId"], r["errors"]) for r in checked.collect()}
    assert found == {
        "sensor-1": ("sensor-1", []), "BAD": ("BAD", ["sensorId"]), "sensor-2": ("sensor-2", []),
    }


def test_payload_is_parsed_once(spark):
    frame = spark.createDataFrame([(json.dumps(GOOD),)], "payload string")
    plan = v.valid_rows(v.validate(frame))._jdf.queryExecution().executedPlan().toString()
    # The plain parse, and the two guarded ones for texts with inner braces.
    assert plan.count("VariantExpressionEvalUtils.parseJson") == 3


def test_escalation_projection(spark):
    state = {**GOOD, "alert": {"acknowledged": False}}
    frame = spark.createDataFrame([(json.dumps(state),)], "state string")
    assert v.validate(frame, "state").first()["errors"] == ["unrecognized_keys"]
    assert v.validate(v.escalation_event(frame)).first()["errors"] == []
