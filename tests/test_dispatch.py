import json

from pyspark.sql import functions as F

from amperline.operators import cases, deadletter, dispatch, metrics, narratives, payloads, workflow

ATTEMPTS = (
    "case_pk string, channel string, attempt_no int, adapter_status string, narrative string,"
    " error string"
)


def outcomes(spark, rows, **kw):
    frame = spark.createDataFrame(rows, ATTEMPTS).selectExpr(
        "*", "attempt_no * 1000L AS attempt_ms", "'P2' AS severity", "10L AS latency_ms"
    )
    return dispatch.dispatch_outcomes(frame, **kw)


def kinds(frame):
    return {(r["channel"], r["attempt_no"]): (r["kind"], r["skip_reason"]) for r in frame.collect()}


FAIL_THEN_OK = [
    ("c", "email", 1, "failed", "text", "timeout"),
    ("c", "email", 2, "delivered", "text", None),
    ("c", "email", 3, "delivered", "text", None),
    ("c", "sms", 1, "delivered", "text", None),
    ("c", "sms", 2, "delivered", "text", None),
]


def test_retry_skips_what_was_delivered(spark):
    assert kinds(outcomes(spark, FAIL_THEN_OK)) == {
        ("email", 1): ("failed", None), ("email", 2): ("delivered", None),
        ("email", 3): ("skipped", "retry_already_delivered"),
        ("sms", 1): ("delivered", None), ("sms", 2): ("skipped", "retry_already_delivered"),
    }


def test_skip_reasons_in_order(spark):
    rows = [("c", "sms", 1, "delivered", None, None), ("c", "sms", 2, "delivered", "text", None)]
    found = kinds(outcomes(spark, rows, handlers=("email",)))
    assert found == {("sms", 1): ("skipped", "narrative_missing"), ("sms", 2): ("skipped", "no_handler_registered")}


def test_channels_do_not_block_each_other(spark):
    rows = [("c", "email", 1, "failed", "t", "down"), ("c", "sms", 1, "delivered", "t", None)]
    row = dispatch.dispatch_summary(outcomes(spark, rows)).first()
    assert (row["delivered"], row["failed"], row["skipped"]) == (["sms"], ["email"], [])


def test_old_error_survives_a_later_success(spark):
    rows = {r["channel"]: r for r in cases.case_channels(outcomes(spark, FAIL_THEN_OK)).collect()}
    email = rows["email"]
    assert (email["status"], email["error"], email["created_ms"], email["updated_ms"]) == (
        "delivered", "timeout", 1000, 3000)
    assert rows["sms"]["case_id"].startswith("MOCK-sms-1000-")
    assert rows["sms"]["external_url"].endswith(rows["sms"]["case_id"])


def test_folds_are_idempotent(spark):
    log = outcomes(spark, FAIL_THEN_OK)
    once = sorted(cases.case_channels(log).collect())
    assert sorted(cases.case_channels(log.union(log)).collect()) == once
    assert cases.case_metadata(log.union(log)).collect() == cases.case_metadata(log).collect()


def test_attempt_without_text_touches_nothing(spark):
    rows = FAIL_THEN_OK[:2] + [("c", "email", 9, "delivered", None, None), ("d", "sms", 1, "delivered", None, None)]
    found = cases.case_channels(outcomes(spark, rows)).collect()
    assert [(r["case_pk"], r["channel"], r["updated_ms"]) for r in found] == [("c", "email", 2000)]


def test_lookup_of_absent_rows(spark):
    log = outcomes(spark, FAIL_THEN_OK)
    keys = spark.createDataFrame([("c", "__metadata__"), ("c", "sms"), ("x", "email")], "case_pk string, row string")
    found = cases.case_lookup(keys, cases.case_metadata(log), cases.case_channels(log)).collect()
    assert {(r["case_pk"], r["row"]): r["state"] for r in found} == {
        ("c", "__metadata__"): "P2", ("c", "sms"): "delivered", ("x", "email"): None}


def test_retry_audit(spark):
    rows = [("c", "email", 1, "delivered", "t", None), ("c", "email", 2, "delivered", "t", None)]
    row = cases.retry_audit(outcomes(spark, rows)).first()
    assert row[1:] == (True, True, True, 1)


def test_first_ack_in_time_counts(spark):
    alerts = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0)], "case_pk string, ms long").select(
        "case_pk", F.col("ms").alias("notified_ms"))
    acks = spark.createDataFrame(
        [("a", 900_000), ("a", 5_000), ("b", 900_001), ("c", -1)], "case_pk string, ack_ms long")
    found = {r["case_pk"]: (r["ack_ms"], r["escalated"]) for r in workflow.ack_escalation(alerts, acks).collect()}
    assert found == {"a": (5_000, False), "b": (None, True), "c": (None, True)}


def test_execution_statuses(spark):
    rows = [("ok", 0, False, None, 900_000), ("bad", 0, True, None, 900_000), ("stop", 0, False, 5, 900_000),
            ("slow", 0, False, None, 5_400_000), ("new", 3_500_000, False, None, 900_000)]
    runs = spark.createDataFrame(rows, "name string, start_ms long, invalid_input boolean, aborted_ms long, wait_ms long")
    found = {r["name"]: (r["status"], r["stop_ms"]) for r in workflow.execution_status(runs, 3_600_000).collect()}
    assert found == {"ok": ("SUCCEEDED", 900_000), "bad": ("FAILED", 0), "stop": ("ABORTED", 5),
                     "slow": ("TIMED_OUT", 3_600_000), "new": ("RUNNING", None)}


def test_fallback_payload_leaves_nulls_out(spark):
    frame = spark.sql("""SELECT 'sensor-007' AS sensorId, 't' AS timestamp, 'voltage' AS readingType,
      108D AS value, 'V' AS unit, cast(NULL AS string) AS gridZone, true AS exceeded, 'd' AS details,
      114D AS broken_min, cast(NULL AS double) AS broken_max, true AS escalated""")
    body = json.loads(payloads.fallback_payload(frame).first()["payload"])
    assert body == {"severity": "P1", "sensorId": "sensor-007", "timestamp": "t", "readingType": "voltage",
                    "value": 108.0, "unit": "V", "threshold": {"min": 114.0}, "details": "d", "escalated": True}


def test_subjects_are_cut(spark):
    frame = spark.createDataFrame([("P0", "sensor-" + "x" * 200, "voltage")], "severity string, sensorId string, readingType string")
    row = payloads.subjects(frame).first()
    assert row["notify_subject"].startswith("[P0] Grid sensor breach: sensor-x")
    assert all(len(row[c]) == 100 for c in ("notify_subject", "escalation_subject", "channel_subject"))


def test_narrative_audit(spark):
    rows = [(True, True, "e" * 20, "s" * 160), (True, False, "e" * 19, None), (True, True, "e" * 1201, "s" * 9),
            (True, True, "e" * 20, None), (False, False, None, "s" * 10)]
    frame = spark.createDataFrame(rows, "email boolean, sms boolean, email_text string, sms_text string")
    found = [r["errors"] for r in narratives.audit_narratives(frame).collect()]
    assert found == [[], ["email_length"], ["email_length", "sms_length"], ["sms_selection"], ["sms_selection"]]


def test_token_precedence(spark):
    rows = [
        ('{"usage_metadata":{"input_tokens":5,"output_tokens":7,"total_tokens":99}}', 99),
        ('{"usage_metadata":{"input_tokens":5,"output_tokens":7}}', 12),
        ('{"usage_metadata":{"output_tokens":7},"response_metadata":{"usage":{"total_tokens":1}}}', 7),
        ('{"response_metadata":{"usage":{"input_tokens":3}}}', 3),
        ('{"usage_metadata":{},"response_metadata":{"usage":{"total_tokens":4}}}', 4),
        ('{"content":"x"}', 0), ("broken", 0),
    ]
    frame = spark.createDataFrame(rows, "response string, expected long")
    assert all(r[0] == r[1] for r in frame.select(metrics.token_count(F.col("response")), "expected").collect())


def test_dead_letter_envelopes(spark):
    rows = [
        ('{"requestContext":{"condition":"Retry","approximateInvokeCount":6},"responseContext":{"functionError":"Unhandled"},'
         '"KinesisBatchInfo":{"startSequenceNumber":"1","endSequenceNumber":"9","batchSize":3}}',
         ("Unhandled", "1..9", 3, 6)),
        ('{"requestContext":{"condition":"Retry"},"KinesisBatchInfo":{"startSequenceNumber":"1"}}',
         ("Retry", "1..undefined", 1, 0)),
        ("{}", ("unknown", "unknown", 1, 0)), ("{bro", ("unknown", "unknown", 1, 0)),
    ]
    frame = spark.createDataFrame([(str(i), b) for i, (b, _) in enumerate(rows)], "message_id string, body string")
    found = [r[:4] for r in deadletter.inspect(frame).select("reason", "sequence_range", "batch_size", "invoke_count").collect()]
    assert found == [want for _, want in rows]
