"""Sketches merged over periods against exact counts, within their stated errors."""

import random

from pyspark.sql import functions as F

from amperline.operators import alarms, metrics, sketches
from amperline.plans.catalog import QUERIES


def log(spark, size=40_000):
    rnd = random.Random(8)
    rows = [(rnd.randrange(3 * sketches.DAY_MS), "voltage" if rnd.random() < 0.7 else "current", int(rnd.expovariate(1 / 300)) if rnd.random() < 0.99 else None) for _ in range(size)]
    return spark.createDataFrame(rows, "processed_ms long, readingType string, latency_ms long").repartition(6)


def test_merged_minutes_keep_the_rank_error(spark):
    rows = log(spark).persist()
    minutes = sketches.latency_sketches(rows)
    for period in (3_600_000, sketches.DAY_MS):
        found = sketches.sketch_percentiles(sketches.merged(minutes, period)).persist()
        judged = sketches.rank_errors(found, rows, period).collect()
        assert judged and max(r.rank_error for r in judged) <= sketches.RANK_ERROR
        exact = rows.where("latency_ms IS NOT NULL").groupBy((F.col("processed_ms") - F.col("processed_ms") % period).alias("minute_ms"), "readingType").count()
        assert sorted((r.minute_ms, r.readingType, r.events) for r in judged) == sorted(tuple(r) for r in exact.collect())


def test_small_groups_are_exact_and_feed_the_alarm(spark):
    rows = spark.createDataFrame([(60_000 * m, "voltage", 5000 if m in (3, 4, 5, 9) else 10) for m in range(12)] + [(0, "x", None)], "processed_ms long, readingType string, latency_ms long")
    found = sketches.sketch_percentiles(sketches.latency_sketches(rows))
    assert found.where("readingType = 'x'").isEmpty()
    series = alarms.p99_series(found)
    exact = alarms.p99_series(metrics.latency_percentiles(rows))
    assert sorted(series.collect()) == sorted(exact.collect())
    assert sorted(alarms.state_changes(series, alarms.P99_LATENCY).collect()) == sorted(alarms.state_changes(exact, alarms.P99_LATENCY).collect())


def test_distinct_sensors_and_silent_ones(spark):
    """Far more sensors than entries: estimates within four standard errors; few sensors: exact."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("s"), F.col("id") % 20_000).alias("sensorId"),
        F.lit("voltage").alias("readingType"),
        F.timestamp_seconds(F.expr("id DIV 20000 * 86400")).alias("event_ts"),
    )
    # On the third day a quarter is silent; another type has three sensors.
    rows = rows.where("NOT (id >= 40000 AND id % 4 = 0)").union(spark.range(3).selectExpr("concat('t', id)", "'current'", "timestamp_seconds(id * 86400)"))
    got = {(str(r.day), r.readingType): r for r in sketches.distinct_sensors(sketches.sensor_sketches(rows), 2).collect()}
    near = lambda x, want: abs(x - want) <= 4 / 64 * 20_000
    assert near(got["1970-01-01", "voltage"].sensors, 20_000) and got["1970-01-01", "voltage"].silent_since_yesterday == 0
    assert near(got["1970-01-03", "voltage"].sensors, 15_000) and near(got["1970-01-03", "voltage"].sensors_in_range, 20_000)
    assert near(got["1970-01-03", "voltage"].silent_since_yesterday, 5_000)
    assert tuple(got["1970-01-02", "current"][2:]) == (1, 2, 1)


def test_query_is_exact_beyond_the_sketch_size(spark, folder):
    """The registered query on 6,000 sensors a day: its own columns against plain sets."""
    events = spark.range(18_000).selectExpr(
        "id AS event_id", "cast(timestamp_seconds(1704067200 + id DIV 6000 * 86400) AS timestamp_ntz) AS ts",
        "id % 6000 + id DIV 6000 * 500 AS user_id", "'click' AS event_type", "1D AS value", "'{}' AS props",
    )
    events.write.parquet(f"{folder}/events.parquet")
    got = QUERIES["distinct_sensors_range"](spark, folder).collect()
    assert sorted(map(tuple, got)) == [(f"2024-01-0{i + 1}", "voltage", 6_000, 6_000 + 500 * i, 500 if i else 0) for i in range(3)]


def test_exact_sensors_beyond_the_sketch_size(spark):
    """More sensors a day than a sketch has entries, gaps of all lengths, readings without sensor, type or time."""
    seen = {(day, kind, s) for day in range(12) for kind, size in (("voltage", 5_000), ("current", 40)) for s in range(size) if (s * 7 + day * day) % (2 + s % 11) == 0}
    seen |= {(day, "voltage", s) for day in (0, 9) for s in range(9_000)}
    seen = {(day, kind, s) for day, kind, s in seen if (day, kind) != (5, "current")}
    parts = spark.createDataFrame(sorted(seen), "day int, readingType string, s int").selectExpr("timestamp_seconds(day * 86400L + s) AS event_ts", "readingType", "concat('s', s) AS sensorId")
    odd = spark.sql("SELECT * FROM VALUES (timestamp_seconds(20 * 86400), 'voltage', NULL), (timestamp_seconds(5 * 86400), NULL, 's1'), (NULL, 'voltage', 's1') AS t(event_ts, readingType, sensorId)")
    held = sketches.sensor_days(parts.union(parts).union(odd))
    of = lambda day, kind: {s for d, k, s in seen if (d, k) == (day, kind)}
    for days in (1, 7):
        want = [(20, "voltage", 0, 0, 0)]
        for day, kind in sorted({(d, k) for d, k, _ in seen}):
            ranged = set().union(*[of(d, kind) for d in range(day - days + 1, day + 1)])
            want.append((day, kind, len(of(day, kind)), len(ranged), len(of(day - 1, kind) - of(day, kind))))
        got = sketches.exact_distinct_sensors(held, days).selectExpr("datediff(day, DATE'1970-01-01')", "readingType", "sensors", "sensors_in_range", "silent_since_yesterday")
        assert sorted(map(tuple, got.collect())) == sorted(want)
        assert max(w[2] for w in want) == 9_000 > 1 << sketches.DISTINCT_LOG_SIZE
    assert sketches.exact_distinct_sensors(held).columns == sketches.distinct_sensors(sketches.sensor_sketches(parts)).columns
