"""Operators that split busy keys, against brute force on skewed input; and plans."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from amperline.operators import alarms, dedup, metrics, reads, routing
from amperline.sources import stores


def skewed(n, seed=1):
    """Two thirds of the rows belong to one sensor."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sensor = "sensor-hot" if rng.random() < 0.66 else f"sensor-{rng.randrange(5)}"
        rows.append((i, sensor, 1_704_067_200_000 + rng.randrange(6 * 3_600_000), rng.randrange(10**6)))
    return rows


def test_recurrence_on_a_hot_sensor(spark):
    rows = [(i, s, ms) for i, s, ms, _ in skewed(1500)]
    frame = spark.createDataFrame(rows, "e int, sensorId string, ms long").withColumn(
        "event_ts", F.timestamp_millis("ms"))
    found = {r["e"]: r["recent_breaches"] for r in routing.recurrence(frame, 600).collect()}
    want = {i: sum(1 for _, t, m in rows if t == s and ms // 1000 - 600 <= m // 1000 <= ms // 1000)
            for i, s, ms in rows}
    assert found == want


def test_previous_value_across_blocks(spark):
    rows = [(s, ms, f"{i:05d}", ms + d % 7_200_000) for i, s, ms, d in skewed(800, 2)]
    frame = spark.createDataFrame(rows, "sensorId string, arrival_ms long, sequence_number string, v long")
    stepped = dedup.with_previous(
        frame, "sensorId", ("arrival_ms", "sequence_number"), "v", F.floor(F.col("arrival_ms") / 600_000))
    want, last = {}, {}
    for s, ms, seq, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        want[seq] = last.get(s)
        last[s] = v
    assert {r["sequence_number"]: r["previous"] for r in stepped.collect()} == want


def test_requests_on_a_hot_sensor(spark):
    rows = sorted({(s, ms) for _, s, ms, _ in skewed(3000, 3)})
    readings = spark.createDataFrame(rows, "sensorId string, ms long").select(
        "sensorId", F.timestamp_millis("ms").alias("event_ts"),
        F.concat(F.lpad(F.col("ms").cast("string"), 15, "0"), F.lit("#voltage")).alias("sk"),
        F.lit(1.0).alias("value"))
    base = 1_704_067_200_000

    def iso(offset):
        return f"2024-01-01T{offset // 3600:02d}:{offset % 3600 // 60:02d}:{offset % 60:02d}Z"

    asked = [(1, "sensor-hot", None, None, 7), (2, "sensor-hot", iso(5000), iso(9000), 30),
             (3, "sensor-hot", iso(3600), None, None), (4, "sensor-1", None, iso(7200), 1000),
             (5, "sensor-none", None, None, 5), (6, "sensor-hot", iso(9000), iso(5000), 5)]
    requests = spark.createDataFrame(
        asked, "request_id int, sensorId string, from_time string, to_time string, limit int")
    items = reads.request_items(requests, readings, block_seconds=900)
    found = defaultdict(list)
    for r in items.collect():
        found[r["request_id"]].append(int(r["sk"].split("#")[0]))
    bounds = {1: (0, 10**9), 2: (5000, 9000), 3: (3600, 10**9), 4: (0, 7200), 5: (0, 10**9), 6: (9000, 5000)}
    for rid, sensor, _, _, limit in asked:
        low, high = (base + 1000 * b for b in bounds[rid])
        want = sorted((ms for s, ms in rows if s == sensor and low <= ms <= high), reverse=True)[:limit]
        assert sorted(found[rid], reverse=True) == want, rid
    served = {r["request_id"]: r["item_count"] for r in reads.serve_requests(requests, items).collect()}
    assert served[5] == 0 and served[6] == 0 and served[1] == 7


@pytest.mark.parametrize("periods", [1, 2, 3])
def test_alarm_with_gaps(spark, periods):
    rng = random.Random(periods)
    on = sorted(rng.sample(range(200), 120))
    series = spark.createDataFrame(
        [(m * 60_000, 5.0 if m in on else 0.0) for m in range(200) if rng.random() < 0.95 or m in on],
        "period_ms long, value double")
    rule = alarms.Rule("a", ">", 1, periods=periods)
    state = [all(m - i in on for i in range(periods)) for m in range(201)]
    want = {(m * 60_000, "ALARM" if state[m] else "OK") for m in range(201)
            if state[m] != (state[m - 1] if m else False)}
    assert {(r["at_ms"], r["state"]) for r in alarms.state_changes(series, rule).collect()} == want


def test_depth_over_several_days(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        start = 1_704_067_200_000 + rng.randrange(4 * 86_400_000)
        rows.append((start, None if i % 50 == 0 else start + rng.randrange(7_200_000), "failed" if i % 40 == 7 else "ok"))
    frame = spark.createDataFrame(rows, "received_ms long, handled_ms long, inspection string")
    found = {r["period_ms"]: r["value"] for r in alarms.dlq_depth(frame).collect()}
    change = Counter()
    for a, b, ok in rows:
        change[a // 1000, 0] += 1
        if ok == "ok" and b is not None:
            change[b // 1000, 1] -= 1
    depth, peak, current, want = 0, {}, None, {}
    steps = sorted(change.items())
    first = min(k[0] for k in change) // 86_400 * 1440
    last = max(k[0] for k in change) // 86_400 * 1440 + 1439
    position = 0
    for minute in range(first, last + 1):
        top = depth
        while position < len(steps) and steps[position][0][0] // 60 == minute:
            depth += steps[position][1]
            top = max(top, depth)
            position += 1
        want[minute * 60_000] = float(top)
    assert found == want


def test_depth_alarm_needs_no_grid(spark):
    """From changes alone as from the dense series, idle days, midnight and a last minute with changes included."""
    day = 86_400_000
    for seed in range(3):
        rng, base = random.Random(seed), 1_704_067_200_000
        rows = []
        for _ in range(60):
            start = base + rng.choice([0, 1, 2, 9, 33]) * day + rng.choice([0, 59_000, day - 60_000, day - 1000, rng.randrange(day)])
            rows.append((start, start + rng.choice([0, 1000, 60_000, 120_000, 2 * day]), "failed" if seed == 2 and rng.random() < 0.05 else "ok"))
        frame = spark.createDataFrame(rows, "received_ms long, handled_ms long, inspection string")
        for limit in (1, 3):
            rule = alarms.Rule("depth", ">=", limit)
            want = sorted(alarms.state_changes(alarms.dlq_depth(frame), rule).collect())
            assert sorted(alarms.dlq_depth_changes(frame, rule).collect()) == want and want


def test_old_message_adds_two_changes(spark):
    rows = [(1_704_067_200_000 + i * 3_600_000, 1_704_067_200_000 + i * 3_600_000 + 60_000, "ok") for i in range(100)]
    schema = "received_ms long, handled_ms long, inspection string"
    plain = spark.createDataFrame(rows, schema)
    old = spark.createDataFrame([*rows, (5_000, 65_000, "ok")], schema)
    days, minutes = alarms._depth(old)
    assert minutes.count() == alarms._depth(plain)[1].count() + 2 and days.count() == alarms._depth(plain)[0].count() + 1
    assert alarms.dlq_depth_changes(old).count() == alarms.dlq_depth_changes(plain).count() + 2
    plan = alarms.dlq_depth_changes(old)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "sequence" not in plan


def test_first_write_wins_on_a_hot_key(spark):
    rows = [("sensor-1", "t", "voltage", 1000 - i, "s", str(i), float(i)) for i in range(500)]
    rows += [("sensor-2", "t", "voltage", 5, "s", "x", 1.0)]
    frame = spark.createDataFrame(
        rows, "sensorId string, timestamp string, readingType string, arrival_ms long, shard_id string,"
        " sequence_number string, value double").repartition(4)
    kept = {r["sensorId"]: r["value"] for r in dedup.first_writes(frame).collect()}
    assert kept == {"sensor-1": 499.0, "sensor-2": 1.0}
    plan = dedup.first_writes(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") >= 1 and "Window" not in plan


def test_duplicates_per_minute(spark):
    rows = [("a", "t", "v", 10), ("a", "t", "v", 20), ("a", "t", "v", 60_010), ("a", "t", "v", 120_010), ("b", "t", "v", 60_000)]
    frame = spark.createDataFrame(rows, "sensorId string, timestamp string, readingType string, arrival_ms long")
    found = {r["minute_ms"]: r["duplicate_writes"] for r in metrics.duplicates_per_minute(frame).collect()}
    assert found == {0: 1, 60_000: 1, 120_000: 1}


def test_percentiles_differ_from_pooled_ones(spark):
    rows = [(0, "a", x) for x in (1, 1, 1, 1)] + [(0, "b", 100)]
    log = spark.createDataFrame(rows, "processed_ms long, readingType string, latency_ms long")
    worst = metrics.worst_latency(metrics.latency_percentiles(log)).first()
    assert worst["p50"] == 100.0


def test_approximate_percentiles_are_values_of_the_log(spark):
    rows = [(0, "a", x) for x in range(1, 101)]
    log = spark.createDataFrame(rows, "processed_ms long, readingType string, latency_ms long")
    row = metrics.latency_percentiles(log, exact=False).first()
    assert (row["p50"], row["p95"], row["p99"]) == (50.0, 95.0, 99.0)


def test_payload_stays_out_of_the_shuffles(spark):
    from amperline.plans.ingest import ingest
    from amperline.sources import samples

    plan = ingest(samples.raw_telemetry(spark, "/root/testdata/sf0.001")).kept._jdf.queryExecution().sparkPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert aggregates and not any("payload#" in line for line in aggregates)


def test_ordered_export_splits_a_hot_sensor(spark):
    rows = [(s, ms, f"{i:05d}") for i, s, ms, _ in skewed(2000, 9)]
    frame = spark.createDataFrame(rows, "sensorId string, arrival_ms long, sequence_number string")
    out = dedup.stream_order(frame, 4).withColumn("part", F.spark_partition_id()).collect()
    assert [tuple(r)[:3] for r in sorted(out, key=lambda r: r["part"])] == sorted(rows)
    assert len({r["part"] for r in out if r["sensorId"] == "sensor-hot"}) > 1


def stored(spark, folder):
    rows = [(f"sensor-{i % 3}", i) for i in range(96)]
    frame = spark.createDataFrame(rows, "sensorId string, i int").select(
        "sensorId", F.col("sensorId").alias("pk"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("i") * 3600).alias("event_ts"),
        F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("i") * 3600), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("sk"),
        F.lit("voltage").alias("readingType"), F.lit(120.0).alias("value"), F.lit("V").alias("unit"))
    stores.write_readings(frame, folder)
    return stores.read_readings(spark, folder)


def test_range_query_prunes_and_pushes(spark, folder):
    rows = stored(spark, folder + "/readings")
    found = reads.sensor_range(rows, "sensor-1", "2024-01-02T00:00:00Z", "2024-01-02T12:00:00Z", limit=3).select("sk", "value")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "EqualTo(pk,sensor-1)" in plan and "GreaterThanOrEqual(event_ts" in plan
    assert "TakeOrderedAndProject" in plan
    assert [r["sk"] for r in found.collect()] == ["2024-01-02T10:00:00Z", "2024-01-02T07:00:00Z", "2024-01-02T04:00:00Z"]
    scanned = plan[plan.index("ReadSchema"):]
    assert "unit" not in scanned and "readingType" not in scanned


def test_lookback_prunes_days(spark, folder):
    rows = stored(spark, folder + "/readings")
    found = reads.recent_breaches(rows, "2024-01-03T00:00:00Z", 60)
    assert "PartitionFilters: [isnotnull(event_date" in found._jdf.queryExecution().executedPlan().toString()


def test_lexical_bounds_differ_from_time(spark):
    frame = spark.createDataFrame([("s", "2024-01-01T12:00:00.500Z#voltage"), ("s", "2024-01-01T12:00:00Z#voltage")], "pk string, sk string")
    frame = frame.withColumn("event_ts", F.substring_index("sk", "#", 1).cast("timestamp"))
    end = "2024-01-01T12:00:00Z"
    timed = reads.sensor_range(frame, "s", end=end)
    lexical = reads.sensor_range(frame, "s", end=end, mode="lexical")
    assert timed.count() == 1 and lexical.count() == 2


def test_request_checks(spark):
    rows = [("sensor-1", None, None, None), ("Sensor-1", None, None, "5"), ("sensor-1", "yesterday", None, "5"),
            ("sensor-1", None, "2024-01-01T00:00:00", ""), ("sensor-1", None, None, "1000"),
            ("sensor-1", None, None, "1001"), ("sensor-1", None, None, "2.5"), ("sensor-1", None, None, " 7 ")]
    frame = spark.createDataFrame(rows, "sensorId string, from_time string, to_time string, limit_text string")
    found = [(r["limit"], r["errors"]) for r in reads.check_requests(frame).collect()]
    assert found == [(None, []), (5, ["sensorId"]), (5, ["from"]), (None, ["to", "limit"]), (1000, []),
                     (None, ["limit"]), (None, ["limit"]), (7, [])]
