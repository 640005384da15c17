"""Streams in several steps give the batch result, also after a restart."""

from datetime import date

from pyspark.sql import functions as F

from amperline.operators import workflow
from amperline.plans.ingest import ingest
from amperline.plans.alerting import classified_breaches
from amperline.sources import samples, stores, telemetry
from amperline.streaming import acks, cases, jobs
from amperline.streaming import ingest as streaming

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["sensorId", "timestamp", "readingType", "value"]


def raw_files(spark, path, parts):
    """Raw records in arrival order, cut into files of increasing age."""
    raw = samples.raw_telemetry(spark, FOLDER)
    rows = raw.select(
        "shard_id", "sequence_number", F.lit(None).cast("string").alias("partition_key"), "topic",
        F.timestamp_millis("arrival_ms").alias("arrival_ts"), "payload", "arrival_ms")
    low, high = rows.agg(F.min("arrival_ms"), F.max("arrival_ms")).first()
    step = (high - low) // parts + 1
    for i in range(parts):
        piece = rows.where(F.col("arrival_ms").between(low + i * step, low + (i + 1) * step - 1)).drop("arrival_ms")
        piece.coalesce(1).write.mode("append").parquet(path)
        yield i


def stream(spark, path):
    return telemetry.read_stream(spark, path, files_per_trigger=1).withColumn("arrival_ms", F.unix_millis("arrival_ts"))


def kept(spark, path):
    return sorted(spark.read.parquet(path).select(*COLUMNS).collect())


def test_ingest_in_steps_with_restarts(spark, folder):
    jobs.use_rocksdb(spark)
    target = streaming.IngestTarget(f"{folder}/out")
    for i in raw_files(spark, f"{folder}/in", 4):
        if i % 2:
            # Two files per run; every run starts from the checkpoint.
            streaming.run_ingest(stream(spark, f"{folder}/in"), target)
    run = ingest(samples.raw_telemetry(spark, FOLDER))
    want = sorted(run.kept.select(*COLUMNS).collect())
    assert kept(spark, target.readings) == want
    streaming.run_ingest(stream(spark, f"{folder}/in"), target)
    assert kept(spark, target.readings) == want
    assert spark.read.parquet(target.quarantine).count() == run.rejected.count()
    counts = spark.read.parquet(target.counts).agg(F.sum("kept"), F.sum("quarantined"), F.sum("duplicates"), F.sum("redelivered"), F.sum("records")).first()
    redelivered = run.valid.count() - run.writes.count()
    assert counts == (len(want), run.rejected.count(), run.writes.count() - len(want), redelivered, run.checked.count())
    assert spark.read.parquet(target.counts).where("kept IS NULL OR records IS NULL").isEmpty()


def test_replayed_batch_changes_nothing(spark, folder):
    target = streaming.IngestTarget(f"{folder}/out")
    checked = ingest(samples.raw_telemetry(spark, FOLDER)).checked
    store = streaming.store_batch(target)
    store(checked, 0)
    once = kept(spark, target.readings)
    store(checked, 0)
    assert kept(spark, target.readings) == once
    # The same records under a later batch are duplicates of stored ones.
    store(checked, 1)
    assert kept(spark, target.readings) == once


def test_compaction_keeps_rows(spark, folder):
    target = streaming.IngestTarget(f"{folder}/out")
    streaming.store_batch(target)(ingest(samples.raw_telemetry(spark, FOLDER)).checked, 0)
    before = kept(spark, target.readings)
    assert not streaming.compact_days(spark, target, date(2024, 1, 6))  # one batch may still be replayed
    streaming.store_batch(target)(ingest(samples.raw_telemetry(spark, FOLDER)).checked, 1)
    assert not streaming.compact_days(spark, target, date(2024, 1, 6))  # one partition a day needs none
    assert kept(spark, target.readings) == before


def test_one_file_is_parsed_by_many_tasks_and_told_from_copies_once(spark, folder):
    """A source of one row group: no task parses more than its share, and ledger and readings come from one stored result."""
    from amperline.plans import catalog

    target = streaming.IngestTarget(f"{folder}/out")
    streaming.run_ingest(catalog._parsed_stream(spark, FOLDER), target)
    parsed = [r["count"] for r in spark.read.parquet(target.staging).groupBy(F.input_file_name()).count().collect()]
    assert len(parsed) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(parsed) < 2 * sum(parsed) / len(parsed)
    run = ingest(samples.raw_telemetry(spark, FOLDER))
    fresh = spark.read.parquet(target.fresh)
    assert fresh.count() == run.writes.count() == target.ledger_table.all_rows(spark).count()
    assert "payload" not in fresh.columns and kept(spark, target.readings) == kept_of(run.kept)


RAW = ("shard_id", "sequence_number", "topic", "payload", "arrival_ms")


def archived(spark, target):
    schema = "shard_id string, sequence_number string, topic string, payload string, arrival_ms bigint, attempts int"
    return spark.read.schema(schema).json(target.raw_archive)


def in_order(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=str)


def test_one_job_archives_and_counts_what_it_ingests(spark, folder):
    """Over batches and a restart: every raw record in the archive, other topics too, and the metrics of the batch forms."""
    from amperline.operators import metrics
    from amperline.streaming import metrics as stream_metrics

    target = streaming.IngestTarget(f"{folder}/out")
    for i in raw_files(spark, f"{folder}/in", 4):
        if i % 2:
            streaming.run_ingest(stream(spark, f"{folder}/in"), target)
    raw = samples.raw_telemetry(spark, FOLDER)
    run = ingest(raw)
    assert run.checked.count() < raw.count()
    assert in_order(archived(spark, target), *RAW) == in_order(raw, *RAW)
    days = archived(spark, target).groupBy("year", "month", "day").agg(F.count("*").alias("records"), F.sum(F.char_length("payload")).alias("payload_chars"))
    days = days.select(F.format_string("%04d", "year"), F.format_string("%02d", "month"), F.format_string("%02d", "day"), "records", "payload_chars")
    assert in_order(days, "*") == in_order(stores.archive_daily_counts(raw), "*")

    seen = stream_metrics.processed_counts(spark, target.processed)
    assert in_order(seen, "minute_ms", "readingType", "events") == in_order(metrics.events_by_type(samples.processing_log(run.kept)), "minute_ms", "readingType", "events")
    columns = ("minute_ms", "validation_errors", "partial_batch_failures", "duplicate_writes")
    want = in_order(metrics.failure_counters(run.checked, run.writes), *columns)
    assert in_order(stream_metrics.failure_counts(spark, target.failures), *columns) == want and any(r[3] for r in want)
    latency = stream_metrics.processing_latency(spark, target.processed)
    assert latency.columns == metrics.latency_percentiles(samples.processing_log(run.kept)).columns
    assert latency.where("0 < p50 AND p50 <= p95 AND p95 <= p99").count() == latency.count() == seen.count()


def test_the_query_runs_every_step(spark, folder, monkeypatch):
    from amperline.plans import catalog

    monkeypatch.setattr(catalog, "shared_folder", lambda spark, purpose: f"{folder}/{purpose}")
    rows, target = catalog.QUERIES["stream_ingest"](spark, FOLDER), streaming.IngestTarget(f"{folder}/ingest")
    raw = samples.raw_telemetry(spark, FOLDER)
    assert in_order(archived(spark, target), *RAW) == in_order(raw, *RAW)
    assert spark.read.parquet(target.processed).agg(F.sum("events")).first()[0] == rows.count()
    assert spark.read.parquet(target.failures).agg(F.sum("validation_errors")).first()[0] == spark.read.parquet(target.quarantine).count()


def test_archive_and_metrics_of_odd_records_and_replays(spark, folder):
    from amperline.streaming import metrics as stream_metrics

    def text(value, kind="voltage"):
        return f'{{"sensorId":"sensor-1","timestamp":"2024-01-01T00:00:0{value}Z","readingType":"{kind}","value":{value},"unit":"V"}}'

    now, topic = 1_704_067_200_000 + 26 * 3_600_000, "sensors/sensor-1/telemetry"
    recent = now - 600_000
    rows = [
        ("a", "1", topic, text(1), recent, 1),
        ("a", "1", topic, text(1), recent + 60_000, 2),  # redelivered
        ("a", "2", topic, text(1), recent + 60_000, 1),  # a duplicate write
        ("b", "1", topic, text(2, "current"), recent, 1),
        ("b", "2", topic, "{", recent, 1),
        ("b", "3", topic, None, recent + 60_000, 1),
        ("b", "4", topic, text(3), recent, 6),  # tried too often
        ("b", "5", topic, "{", now - 25 * 3_600_000, 1),  # too old
        ("b", "6", "sensors/sensor-1/status", "on", recent, 1),
        (None, None, None, text(4), recent, 1),
    ]
    raw = spark.createDataFrame(rows, "shard_id string, sequence_number string, topic string, payload string, arrival_ms bigint, attempts int")
    target = streaming.IngestTarget(f"{folder}/out", 2)
    store = streaming.store_batch(target, now)

    def found():
        counters = stream_metrics.failure_counts(spark, target.failures)
        return (
            in_order(archived(spark, target), *RAW, "attempts"), in_order(stream_metrics.processed_counts(spark, target.processed), "*"),
            in_order(counters, "*"), [tuple(r) for r in spark.read.parquet(target.counts).orderBy("batch_id").drop("batch_id").collect()],
        )

    store(streaming.checked_stream(raw), 0)
    once = found()
    assert once[0] == sorted(rows, key=str)
    assert once[1] == [(recent, "current", 1), (recent, "voltage", 1)]
    assert once[2] == [(recent, 1, 1, 0), (recent + 60_000, 1, 1, 1)]
    assert once[3] == [(8, 4, 1, 1, 2)]
    store(streaming.checked_stream(raw), 0)
    assert found() == once
    # New sequence numbers for stored keys: archived again, and counted as duplicate writes of their minutes.
    again = raw.where("attempts = 1 AND topic = 'sensors/sensor-1/telemetry'").withColumn("sequence_number", F.concat("sequence_number", F.lit("-2")))
    store(streaming.checked_stream(again), 1)
    both = found()
    assert len(both[0]) == len(rows) + 6 and both[1] == once[1]
    assert both[2] == [(recent, 2, 2, 2), (recent + 60_000, 2, 2, 2)]


def test_archive_holds_all_records(spark, folder):
    target = streaming.IngestTarget(f"{folder}/out")
    for _ in raw_files(spark, f"{folder}/in", 2):
        pass
    streaming.run_archive(stream(spark, f"{folder}/in"), target)
    assert spark.read.json(target.archive).count() == samples.raw_telemetry(spark, FOLDER).count()


def test_archive_batch_form(spark, folder):
    raw = samples.raw_telemetry(spark, FOLDER).withColumn("arrival_ts", F.timestamp_millis("arrival_ms"))
    bad = ingest(raw).rejected.select("payload", "arrival_ts", F.lit("validation").alias("error_type"))
    stores.write_archive(raw.select("payload", "arrival_ts"), folder, bad)
    assert spark.read.json(f"{folder}/raw").count() == raw.count()
    assert spark.read.json(f"{folder}/errors").where("error_type = 'validation'").count() == bad.count()


def test_both_ack_forms_agree(spark, folder):
    jobs.use_rocksdb(spark)
    found = classified_breaches(samples.readings(spark, FOLDER))
    samples_acks = samples.acks(found)
    alerts = found.select("case_pk", F.unix_millis("event_ts").alias("at_ms"))
    # A second, later acknowledgement for each case.
    given = samples_acks.select("case_pk", F.col("ack_ms").alias("at_ms"))
    given = given.union(given.withColumn("at_ms", F.col("at_ms") + 1000))
    for name, frame in (("alerts", alerts), ("acks", given)):
        frame.write.parquet(f"{folder}/{name}")
    timed = found.withColumn("notified_ms", F.unix_millis("event_ts"))
    want = sorted((r["case_pk"], r["ack_ms"], r["escalated"]) for r in workflow.ack_escalation(timed, samples_acks).collect())

    def source(name):
        return spark.readStream.schema(acks.MARKS).parquet(f"{folder}/{name}")

    for name, build in (("join", acks.ack_join), ("timer", acks.ack_timer)):
        beat = acks.heartbeat_stream(spark, f"{folder}/beat-{name}", "2100-01-01T00:00:00Z")
        rows = build(source("alerts"), source("acks"), beat)
        out = f"{folder}/{name}"
        jobs.run_to_end(rows.writeStream.format("parquet").option("path", f"{out}/rows").outputMode("append"), f"{out}/check")
        result = acks.first_acks(spark.read.schema(acks.OUTCOMES).parquet(f"{out}/rows"))
        assert sorted((r["case_pk"], r["ack_ms"], r["escalated"]) for r in result.collect()) == want, name


def test_ledger_outlives_the_stream():
    from amperline.operators.dedup import LEDGER_HOURS, MAX_AGE_HOURS, STREAM_RETENTION_HOURS

    assert LEDGER_HOURS > STREAM_RETENTION_HOURS >= MAX_AGE_HOURS


def test_late_shard_loses_nothing(spark, folder):
    """A record whose arrival lies far behind those already seen is kept, and a copy of it is not."""
    target = streaming.IngestTarget(f"{folder}/out")
    raw = samples.raw_telemetry(spark, FOLDER)
    cut = raw.agg(F.percentile_approx("arrival_ms", 0.5)).first()[0]
    store = streaming.store_batch(target)
    for i, part in enumerate((f"arrival_ms >= {cut}", f"arrival_ms < {cut}", f"arrival_ms < {cut}")):
        store(streaming.checked_stream(raw.where(part)), i)
    assert kept(spark, target.readings) == kept_of(ingest(raw).kept)
    last = spark.read.parquet(target.counts).where("batch_id = 2").first()
    assert last.kept == 0 and last.redelivered + last.quarantined == last.records > 0


def kept_of(frame):
    return sorted(frame.select(*COLUMNS).collect())


def test_counts_add_up_over_batches(spark, folder):
    from amperline.streaming import metrics

    rows = samples.readings(spark, FOLDER).select(F.col("event_ts").alias("arrival_ts"), "readingType")
    for i in (1, 0, 2):  # minutes come back in later batches
        jobs.write_batch(metrics.events_per_minute(rows.where(F.crc32(F.col("arrival_ts").cast("string").cast("binary")) % 3 == i)), f"{folder}/counts", i)
    want = sorted(metrics.events_per_minute(rows).collect())
    assert sorted(metrics.current_counts(spark, folder).select("minute_ms", "readingType", "events").collect()) == want


class Handle:
    """Stands for the state of one case."""

    def __init__(self):
        self.timers = set()

    class State:
        def __init__(self):
            self.rows = []

        def exists(self):
            return bool(self.rows)

        def get(self):
            return self.rows[0] if self.one else iter(self.rows)

        def update(self, row):
            self.rows = [row]

        def put(self, rows):
            self.rows = list(rows)

        def appendValue(self, row):
            self.rows.append(row)

        def clear(self):
            self.rows = []

    def getValueState(self, name, schema):
        state = self.State()
        state.one = True
        return state

    def getListState(self, name, schema):
        state = self.State()
        state.one = False
        return state

    def registerTimer(self, at):
        self.timers.add(at)


def wait_for(batches, until=10**12):
    """Outcomes of one case whose marks come in the given batches; timers fire at the end."""
    import pandas as pd

    timer, handle, out = acks.AckTimer(), Handle(), []
    timer.init(handle)
    for batch in batches:
        out += timer.handleInputRows(("c",), iter([pd.DataFrame(batch, columns=["kind", "at_ms"])]), None)
    while handle.timers and min(handle.timers) <= until:
        at = min(handle.timers)
        handle.timers.remove(at)
        out += timer.handleExpiredTimer(("c",), None, type("T", (), {"getExpiryTimeInMs": lambda self, at=at: at})())
    clear = not any(s.exists() for s in (timer.alert, timer.acks, timer.closed))
    return [(int(o.notified_ms[0]), None if o.escalated[0] else int(o.ack_ms[0])) for o in out], clear, timer, handle


def test_timer_does_not_depend_on_batches():
    alert, early, good, late = ("alert", 100), ("ack", 90), ("ack", 110), ("ack", 100 + acks.WAIT_MS + 1)
    for batches in ([[early, good, alert]], [[early], [good], [alert]], [[alert], [early, good]], [[good], [alert, early]]):
        assert wait_for(batches)[:2] == ([(100, 110)], True)
    assert wait_for([[early], [alert], [late]])[:2] == ([(100, None)], True)
    assert wait_for([[good]])[:2] == ([], True)
    # A redelivered alert after its wait does not wait again.
    found, _, timer, handle = wait_for([[alert]], until=100 + acks.WAIT_MS)
    import pandas as pd

    assert found == [(100, None)] and list(timer.handleInputRows(("c",), iter([pd.DataFrame([alert], columns=["kind", "at_ms"])]), None)) == []
    assert not timer.alert.exists()


class Run:
    """A timer class over batches of marks, as a stream hands them on: rows by key, then the timers that are due."""

    def __init__(self, make, key_of):
        self.make, self.key_of, self.keys, self.calls = make, key_of, {}, 0

    def _of(self, key):
        if key not in self.keys:
            timer, handle = self.make(), Handle()
            timer.init(handle)
            self.keys[key] = timer, handle
            for state in vars(timer).values():
                for name in ("exists", "get", "update", "put", "appendValue", "clear"):
                    if isinstance(state, Handle.State):
                        setattr(state, name, lambda *a, f=getattr(state, name): self._count(f, *a))
        return self.keys[key]

    def _count(self, call, *args):
        self.calls += 1
        return call(*args)

    def batch(self, marks, watermark):
        import pandas as pd

        out, values = [], type("V", (), {"getCurrentWatermarkInMs": lambda self: watermark})()
        for key in {self.key_of(case) for _, case, _ in marks}:
            rows = [m for m in marks if self.key_of(m[1]) == key]
            frames = (pd.DataFrame(rows[i : i + 7], columns=["kind", "case_pk", "at_ms"]) for i in range(0, len(rows), 7))
            assert not list(self._of(key)[0].handleInputRows((key,), frames, values))
        for key, (timer, handle) in self.keys.items():
            while handle.timers and min(handle.timers) < watermark:
                at = min(handle.timers)
                for found in timer.handleExpiredTimer((key,), values, type("T", (), {"getExpiryTimeInMs": lambda self, at=at: at})()):
                    out += [(r.case_pk, int(r.notified_ms), None if r.escalated else int(r.ack_ms)) for r in found.itertuples()]
                handle.timers.remove(at)
        return sorted(out, key=str)

    def empty(self):
        return not any(s.rows for timer, _ in self.keys.values() for s in vars(timer).values() if isinstance(s, Handle.State))


def test_buckets_agree_with_a_timer_per_case():
    """Late and early acknowledgements, alerts that come again before and after their wait, cases without a key: batch by batch the same."""
    import random

    wait, closed = acks.WAIT_MS, acks.AckTimer.closed_ms
    for seed in range(20):
        rnd, now, escalated = random.Random(seed), 0, 0
        single, many = Run(acks.AckTimer, lambda case: case), Run(acks.BucketAckTimer, lambda case: 0 if case is None else int(case[1:]) % 3)
        for step in range(60):
            marks = []
            for _ in range(rnd.randrange(12)):
                case = None if rnd.random() < 0.05 else f"c{rnd.randrange(20)}"
                marks.append((rnd.choice(("alert", "ack", "ack")), case, now + rnd.randrange(1, 3 * wait)))
            now += rnd.choice((0, wait // 3, wait, closed))
            want = single.batch(marks, now)
            assert many.batch(marks, now) == want, (seed, step)
            escalated += len(want)
        assert single.batch([], now + 2 * closed + 10 * wait) == many.batch([], now + 2 * closed + 10 * wait)
        assert escalated > 20 and single.empty() and many.empty()


def test_state_calls_do_not_grow_with_the_cases():
    marks = [(kind, f"c{i}", 1000 + i) for i in range(5_000) for kind in ("alert", "ack")] + [("alert", acks.HEARTBEAT, 10**15), ("ack", "c0", float("nan"))]
    run = Run(acks.BucketAckTimer, lambda case: 0)
    assert run.batch(marks, 0) == []
    assert len(run.batch([], 10**12)) == 5_000 and run.empty()
    assert run.calls <= 20


OUTCOME = "case_pk string, channel string, kind string, skip_reason string, case_id string, external_url string, error string, attempt_no int, attempt_ms long, severity string"


def _case_outcomes(spark):
    rows = []
    for i in range(60):
        for attempt in (1, 2) if i % 3 else (1,):
            at = 1_000_000 * attempt + i
            rows.append((f"c{i}", "email", "delivered" if i % 4 or attempt == 2 else "failed", None, f"id{i}", f"u{attempt}" if i % 5 else None, None if i % 4 else f"e{attempt}", attempt, at, f"P{attempt}"))
            if i % 2:
                skipped = attempt == 2
                rows.append((f"c{i}", "sms", "skipped" if skipped else "delivered", "retry_already_delivered" if skipped else None, None if skipped else f"s{i}", None, None, attempt, at, f"P{attempt}"))
            else:
                rows.append((f"c{i}", "sms", "skipped", "narrative_missing", None, None, None, attempt, at, f"P{attempt}"))
    return spark.createDataFrame(rows, OUTCOME)


def test_case_rows_from_batches_and_replays(spark, tmp_path):
    """Batches in any order, with rows that come again, a replay of the last batch and a rerun of a broken one."""
    outcomes = _case_outcomes(spark)
    answers = spark.createDataFrame([(f"c{i}", 3_000_000 + i + d) for i in range(0, 60, 7) for d in (0, 5)] + [("nobody", 1)], "case_pk string, ack_ms long")
    log = cases.case_log(outcomes, answers)
    part = F.expr("pmod(xxhash64(case_pk, channel, attempt_no, ack_ms), 5)")
    root = str(tmp_path / "cases")
    store = cases.store_cases(root, buckets=4)
    for batch_id, k in enumerate((3, 0, 4, 1, 2)):
        store(log.where(part == k), batch_id)
        if batch_id in (1, 4):
            store(log.where(part == k), batch_id)  # a replay
    store(log.where("case_pk = 'c1'"), 5)  # touches one bucket, and brings nothing new
    stored = spark.read.parquet(f"{root}/rows").select("bucket", "slot", "batch_id").distinct().collect()
    assert len(stored) <= 8 and len({r.bucket for r in stored if r.batch_id == 5}) == 1

    from amperline.operators import cases as folds

    meta = folds.case_metadata(outcomes, answers).selectExpr("case_pk", "'__metadata__' AS row", "severity AS state", "CAST(NULL AS STRING) AS case_id", "CAST(NULL AS STRING) AS external_url", "CAST(NULL AS STRING) AS error", "created_ms", "updated_ms", "resolved_ms")
    sent = folds.case_channels(outcomes).selectExpr("case_pk", "channel AS row", "status AS state", "case_id", "external_url", "error", "created_ms", "updated_ms", "CAST(NULL AS BIGINT) AS resolved_ms")
    key = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    want = key(meta.union(sent))
    assert key(cases.current_cases(spark, root)) == want and len(want) > 100


def test_case_rows_of_a_broken_batch(spark, tmp_path):
    """A first try that leaves only some of its buckets behind: the rerun gives what one clean run gives."""
    log = cases.case_log(_case_outcomes(spark), spark.createDataFrame([], "case_pk string, ack_ms long"))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    for root in (one, two):
        cases.store_cases(root, buckets=4)(log.where("attempt_no = 1"), 0)
    second = log.where("attempt_no = 2")
    cases.store_cases(two, buckets=4)(second.where("pmod(xxhash64(case_pk), 4) < 2"), 1)
    for root in (one, two):
        cases.store_cases(root, buckets=4)(second, 1)
    key = lambda root: sorted(map(str, cases.current_cases(spark, root).collect()))
    assert key(one) == key(two)


def test_no_case_rows(spark, tmp_path):
    assert cases.current_cases(spark, str(tmp_path / "none")).count() == 0
