"""Telemetry-shaped tables derived from the ``events`` table of a data folder.

Everything here is a projection or an aggregation of the whole table, so the
derived tables grow with it.  ``e`` is the event id and ``u`` the user id; a
remainder of one of them decides which defect or counterpart a row carries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.functions import (
    case_key,
    epoch_ms,
    expiry_seconds,
    from_ms,
    iso_text,
    reading_key,
)
from amperline.operators.routing import baseline_routing
from amperline.operators.severity import classify
from amperline.operators.thresholds import evaluate

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string"
)

# Which reading each kind of source row stands for.
READING_OF = """CASE event_type WHEN 'click' THEN 'voltage' WHEN 'view' THEN 'frequency'
  WHEN 'purchase' THEN 'current' WHEN 'error' THEN 'power_factor'
  WHEN 'signup' THEN 'temperature' END"""
# Three digits at least; longer numbers are kept whole.
NAME_OF = """concat('sensor-', if(u < 1000, lpad(cast(u AS string), 3, '0'), cast(u AS string)))"""
UNIT_OF = """CASE readingType WHEN 'voltage' THEN 'V' WHEN 'frequency' THEN 'Hz'
  WHEN 'current' THEN 'A' WHEN 'power_factor' THEN 'pf' ELSE 'degC' END"""
VALUE_OF = """round(CASE readingType
  WHEN 'voltage' THEN CASE WHEN k < 900 THEN 115D + (k % 100) / 10
    WHEN k % 2 = 0 THEN 114D - (k - 899) / 5 ELSE 126D + (k - 899) / 5 END
  WHEN 'frequency' THEN CASE WHEN k < 900 THEN 59.6D + (k % 80) / 100
    WHEN k % 2 = 0 THEN 59.5D - (k - 899) / 40 ELSE 60.5D + (k - 899) / 40 END
  WHEN 'current' THEN 15D + (k - 500) / 500
  WHEN 'power_factor' THEN 0.9D + (k % 100) / 1000
  ELSE 25D + (k - 500) / 100 END, 3)"""


def source_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{folder}/events.parquet")


def spread(scan: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Deal source rows out evenly before heavy parsing: one narrow shuffle, whatever the files are like.

    Small narrow rows are put together into few tasks again, unless the number of ``tasks`` is given.
    """
    return scan.repartition(tasks, key) if tasks else scan.repartition(key)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same file as a stream."""
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )


def as_readings(events: DataFrame) -> DataFrame:
    """Clean sensor readings: one per source row, works on streams too."""
    return (
        events.selectExpr(
            "event_id AS e",
            "user_id AS u",
            "cast(ts AS timestamp) AS event_ts",
            f"{READING_OF} AS readingType",
            "(event_id * 7919) % 1000 AS k",
        )
        .selectExpr(
            "e",
            "u",
            "event_ts",
            f"{NAME_OF} AS sensorId",
            "readingType",
            f"{VALUE_OF} AS value",
            f"{UNIT_OF} AS unit",
            "concat('zone-', cast(u % 3 + 1 AS string)) AS gridZone",
        )
        .withColumn("timestamp", iso_text(F.col("event_ts")))
    )


def clean_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_readings(source_events(spark, folder))


def as_raw(readings: DataFrame) -> DataFrame:
    """Raw stream records: copies, misrouted topics and dirty payloads included."""
    copies = readings.withColumn(
        "copy",
        F.explode(
            F.expr(
                "CASE WHEN e % 40 = 3 THEN array(0, 1)"
                " WHEN e % 60 = 11 THEN array(0, 2) ELSE array(0) END"
            )
        ),
    )
    marked = copies.withColumn(
        "dirt", F.expr("CASE WHEN e % 50 = 7 THEN (e div 50) % 10 ELSE -1 END")
    )
    parts = marked.selectExpr(
        "*",
        "if(dirt = 0, upper(sensorId), sensorId) AS sid",
        "if(dirt = 1, replace(timestamp, 'T', ' '), timestamp) AS tst",
        "if(dirt = 2, 'humidity', readingType) AS rtype",
        "cast(cast(value + if(copy = 2, 0.5D, 0D) AS decimal(18,3)) AS string) AS num",
        "CASE dirt WHEN 5 THEN repeat('u', 17) WHEN 6 THEN '' ELSE unit END AS unt",
        "CASE WHEN dirt = 9 THEN ',\"gridZone\":null' WHEN u % 10 = 9 THEN ''"
        " ELSE concat(',\"gridZone\":\"', gridZone, '\"') END AS zone",
    )
    whole = parts.selectExpr(
        "*",
        """concat('{"sensorId":"', sid, '","timestamp":"', tst, '","readingType":"', rtype, '"',
             CASE dirt WHEN 4 THEN '' WHEN 3 THEN concat(',"value":"', num, '"')
                       ELSE concat(',"value":', num) END,
             ',"unit":"', unt, '"', zone,
             if(dirt = 7, ',"attacker":"payload"', ''), '}') AS text""",
    )
    return whole.selectExpr(
        "e AS event_id",
        "copy",
        "concat('shard-', cast(u % 4 AS string)) AS shard_id",
        "concat(if(copy = 2, 'r', 's'), lpad(cast(e AS string), 12, '0')) AS sequence_number",
        "concat('sensors/', sid, if(e % 200 = 13, '/status', '/telemetry')) AS topic",
        "unix_millis(event_ts) + (e * 31) % 5000 + copy * 60000 AS arrival_ms",
        "e div 10 AS batch_id",
        "if(dirt = 8, substring(text, 1, 40), text) AS payload",
    )


def raw_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    return as_raw(spread(clean_events(spark, folder), "e"))


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Stored readings with their keys; written five seconds after the event."""
    written = from_ms(epoch_ms(F.col("event_ts")) + F.lit(5000))
    return clean_events(spark, folder).select(
        "e",
        "u",
        F.col("sensorId").alias("pk"),
        reading_key(F.col("timestamp"), F.col("readingType")).alias("sk"),
        "sensorId",
        "timestamp",
        "event_ts",
        "readingType",
        "value",
        "unit",
        "gridZone",
        expiry_seconds(written).alias("ttl"),
    )


def breaches(spark: SparkSession, folder: str) -> DataFrame:
    """Classified breaches with their case key."""
    found = classify(evaluate(readings(spark, folder)).where("exceeded"))
    return found.withColumn(
        "case_pk",
        case_key(F.col("sensorId"), F.col("timestamp"), F.col("readingType")),
    )


def processing_log(kept: DataFrame) -> DataFrame:
    """One line per stored reading: when it was processed and how long it took."""
    return kept.select(
        "readingType",
        F.col("arrival_ms").alias("processed_ms"),
        F.expr("(event_id * 31) % 5000").alias("latency_ms"),
    )


def acks(found: DataFrame) -> DataFrame:
    """Acknowledgements: a third of the breaches, within half an hour."""
    return found.where("e % 3 = 0").select(
        "case_pk",
        (F.unix_seconds("event_ts") * 1000 + F.expr("(e * 17) % 1800") * 1000).alias("ack_ms"),
    )


def query_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One read request per sensor and day; some carry a bad name or limit."""
    days = (
        clean_events(spark, folder)
        .groupBy("sensorId", F.to_date("event_ts").alias("day"))
        .agg(F.min("e").alias("request_id"), F.unix_millis(F.min("event_ts")).alias("requested_ms"))
    )
    return days.selectExpr(
        "request_id",
        "requested_ms",
        "(request_id * 17) % 300 AS latency_ms",
        "CASE WHEN request_id % 7 = 0 THEN upper(sensorId)"
        " WHEN request_id % 31 = 0 THEN concat(sensorId, '-absent')"
        " ELSE sensorId END AS sensorId",
        "CASE WHEN request_id % 3 = 0 THEN NULL"
        " WHEN request_id % 37 = 0 THEN 'yesterday'"
        " ELSE concat(cast(date_sub(day, 1) AS string), 'T00:00:00Z') END AS from_time",
        "CASE WHEN request_id % 5 = 0 THEN NULL"
        " ELSE concat(cast(date_add(day, 1) AS string), 'T00:00:00Z') END AS to_time",
        "CASE request_id % 11 WHEN 0 THEN '0' WHEN 1 THEN '1001' WHEN 2 THEN 'x'"
        " WHEN 3 THEN NULL WHEN 4 THEN '2.5' ELSE CASE request_id % 13 WHEN 0 THEN '1e2'"
        " WHEN 1 THEN ' 7 ' WHEN 2 THEN '10d' WHEN 3 THEN '1000' WHEN 4 THEN '0x10' WHEN 5 THEN '10f'"
        " ELSE '10' END END AS limit_text",
    )


def case_attempts(found: DataFrame) -> DataFrame:
    """Dispatch attempts: every breach once, some again on a retry."""
    planned = baseline_routing(found)
    attempts = planned.withColumn(
        "attempt_no",
        F.explode(
            F.expr(
                "CASE WHEN e % 8 = 0 THEN array(1, 2, 3)"
                " WHEN e % 4 = 0 THEN array(1, 2) ELSE array(1) END"
            )
        ),
    )
    sent = attempts.withColumn(
        "channel",
        F.explode(
            F.expr(
                "filter(array(if(email, 'email', NULL), if(sms, 'sms', NULL)), c -> c IS NOT NULL)"
            )
        ),
    )
    return sent.selectExpr(
        "e",
        "case_pk",
        "sensorId",
        "readingType",
        "severity",
        "channel",
        "cast(attempt_no AS int) AS attempt_no",
        "unix_millis(event_ts) + attempt_no * 60000 AS attempt_ms",
        "CASE WHEN channel = 'sms' AND e % 11 = 0 THEN NULL"
        " ELSE concat(severity, ' ', sensorId, ' ', details) END AS narrative",
        "if((channel = 'email' AND (e + attempt_no) % 5 = 0)"
        " OR (channel = 'sms' AND (e + attempt_no) % 7 = 0), 'failed', 'delivered')"
        " AS adapter_status",
        "(e * 13 + attempt_no) % 400 AS latency_ms",
    ).withColumn("error", F.when(F.col("adapter_status") == "failed", F.lit("timeout")))


def model_answers(found: DataFrame) -> DataFrame:
    """Answers of an outside model about each breach, some of them defective."""
    long_text = "repeat('r', 501)"
    return baseline_routing(found).selectExpr(
        "e",
        "case_pk",
        "event_ts",
        "if(e % 17 = 4, 'P9', severity) AS answer_severity",
        "CASE e % 17 WHEN 0 THEN 1.2D WHEN 1 THEN -0.1D ELSE 0.9D END AS confidence",
        f"CASE e % 17 WHEN 2 THEN 'short' WHEN 3 THEN {long_text}"
        " ELSE concat('reading ', details) END AS reasoning",
        "email",
        "if(e % 17 = 8, NULL, sms) AS sms",
        "e % 17 IN (5, 9, 10) AS override_applied",
        "CASE e % 17 WHEN 9 THEN 'third breach in half an hour' WHEN 10 THEN 'too short'"
        " END AS override_reason",
        "CASE e % 17 WHEN 7 THEN repeat('e', 19) WHEN 11 THEN NULL"
        " ELSE concat('Breach report for ', sensorId, '.') END AS email_text",
        "CASE WHEN e % 17 = 6 THEN repeat('s', 161) WHEN coalesce(sms, false) THEN"
        " concat(severity, ' ', sensorId, ' ', details) END AS sms_text",
        """CASE WHEN e % 19 = 0 THEN '{"content":"none"}'
             WHEN e % 2 = 0 THEN concat('{"usage_metadata":{"input_tokens":',
               cast(700000 + e % 1000 AS string), ',"output_tokens":', cast(e % 300 AS string),
               if(e % 4 = 0, concat(',"total_tokens":', cast(900000 + e % 1000 AS string)), ''), '}}')
             ELSE concat('{"usage_metadata":null,"response_metadata":{"usage":{"input_tokens":',
               cast(450000 + e % 1000 AS string), '}}}') END AS response""",
        "(e * 7) % 900 AS latency_ms",
    )


def dlq_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Dead-letter envelopes, one per dirty record."""
    dirty = clean_events(spark, folder).where("e % 50 = 7")
    return dirty.selectExpr(
        "concat('m-', cast(e AS string)) AS message_id",
        "unix_millis(event_ts) AS received_ms",
        "if(e % 4 = 1, NULL, unix_millis(event_ts) + (e * 7919) % 7200000) AS handled_ms",
        "if(e % 9 = 4, 'failed', 'ok') AS inspection",
        """CASE WHEN e % 350 = 7 THEN '{"requestContext":{"cond'
             ELSE concat('{"requestContext":{"requestId":"q', cast(e AS string), '"',
               if(e % 3 = 1, ',"condition":"RetryAttemptsExhausted"', ''),
               if(e % 4 = 3, concat(',"approximateInvokeCount":', cast(e % 6 AS string)), ''),
               '},"responseContext":{"statusCode":200',
               if(e % 3 = 0, ',"functionError":"Unhandled"', ''), '}',
               if(e % 7 = 2, '', concat(',"KinesisBatchInfo":{"shardId":"shard-',
                 cast(u % 4 AS string), '","startSequenceNumber":"s', cast(e AS string),
                 '","endSequenceNumber":"s', cast(e + 9 AS string), '"',
                 if((e div 50) % 2 = 0, '', concat(',"batchSize":', cast(1 + e % 10 AS string))),
                 '}')), '}') END AS body""",
    )


def workflow_runs(found: DataFrame) -> DataFrame:
    """Alert workflow executions, one per breach."""
    return found.selectExpr(
        "concat('run-', lpad(cast(e AS string), 9, '0')) AS name",
        "unix_millis(event_ts) AS start_ms",
        "e % 13 = 5 AS invalid_input",
        "if(e % 29 = 3, unix_millis(event_ts) + 300000, NULL) AS aborted_ms",
        "if(e % 23 = 1, 5400000, 900000) AS wait_ms",
    )


def sensor_units(spark: SparkSession, folder: str) -> DataFrame:
    return source_events(spark, folder).select(F.col("user_id").alias("u")).distinct()


def sensor_mappings(spark: SparkSession, folder: str) -> DataFrame:
    return (
        sensor_units(spark, folder)
        .where("u % 25 <> 0")
        .selectExpr(
            f"{NAME_OF} AS sensorId",
            "concat('asset-', lpad(cast(u % 40 AS string), 2, '0')) AS assetId",
            "if(u % 2 = 0, 'voltage', 'frequency') AS metricType",
            "if(u % 2 = 0, 'V', 'Hz') AS unit",
            "named_struct('min', if(u % 2 = 0, 116D, 59.8D),"
            " 'max', if(u % 2 = 0, 124D, 60.2D)) AS normalRange",
            "named_struct('min', if(u % 2 = 0, 112D + u % 3, 59.4D),"
            " 'max', if(u % 2 = 0, 128D - u % 3, 60.6D)) AS thresholdRange",
        )
    )


def assets(spark: SparkSession, folder: str) -> DataFrame:
    """Assets with the sensors they claim; number 39 has no row, 38 no position."""
    grouped = (
        sensor_units(spark, folder)
        .selectExpr("u % 40 AS a", f"{NAME_OF} AS sensorId")
        .where("a <> 39")
        .groupBy("a")
        .agg(F.array_sort(F.collect_set("sensorId")).alias("sensorIds"))
    )
    return grouped.selectExpr(
        "concat('asset-', lpad(cast(a AS string), 2, '0')) AS assetId",
        "concat('Conveyor ', lpad(cast(a AS string), 2, '0')) AS displayName",
        "'conveyor' AS assetType",
        "'plant-01' AS plantId",
        "concat('building-', cast(a % 2 AS string)) AS buildingId",
        "'floor-1' AS floorId",
        "concat('line-', cast(a % 6 AS string)) AS lineId",
        "concat('cell-', cast(a % 2 AS string)) AS cellId",
        "concat('zone-line-', cast(a % 6 AS string)) AS zoneId",
        "sensorIds",
        "cast(NULL AS string) AS connectedPlcId",
        "'standard' AS safetyClassification",
        "'maintenance' AS maintenanceOwner",
        "if(a = 38, NULL, named_struct('x', (a % 6) * 10D + 0.25D + (a % 5) * 2,"
        " 'y', 1.5D + (a % 7) * 1.5, 'rotation', 0D,"
        " 'units', if(a = 7, 'cm', 'meters'))) AS location",
    )


def floor_maps(spark: SparkSession, folder: str) -> DataFrame:
    """A floor per building, with 10 by 10 squares as zones; zone 5 is left out."""
    zones = (
        sensor_units(spark, folder)
        .selectExpr("u % 6 AS z")
        .where("z <> 5")
        .distinct()
        .selectExpr(
            "z",
            "named_struct('zoneId', concat('zone-line-', cast(z AS string)),"
            " 'name', concat('Line ', cast(z AS string)), 'zoneType', 'production',"
            " 'polygon', array(named_struct('x', z * 10D, 'y', 0D),"
            " named_struct('x', z * 10D + 10, 'y', 0D),"
            " named_struct('x', z * 10D + 10, 'y', 10D),"
            " named_struct('x', z * 10D, 'y', 10D))) AS zone"
        )
    )
    return zones.groupBy(
        F.lit("plant-01").alias("plantId"),
        F.concat(F.lit("building-"), (F.col("z") % 2).cast("string")).alias("buildingId"),
        F.lit("floor-1").alias("floorId"),
    ).agg(
        F.lit("Ground floor").alias("name"),
        F.lit("meters").alias("units"),
        F.lit(60.0).alias("width"),
        F.lit(10.0).alias("height"),
        F.array_sort(F.collect_set("zone")).alias("zones"),
    )
