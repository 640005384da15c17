"""Day tables: what a batch lists, replays, compaction that breaks off, removal of days."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from amperline.sources.tables import DayTable
from amperline.streaming import ingest as streaming
from amperline.plans.ingest import ingest
from amperline.sources import samples

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["sensorId", "timestamp", "readingType", "value"]
DAY_MS = 86_400_000
# The first eight days of the sample.
UNTIL_MS = 1_704_067_200_000 + 8 * DAY_MS


def sequences(spark, batch, per_day, size=20):
    """Some records of a batch, ``per_day`` batches to a day; half of them also came with the batch before."""
    rows = spark.range(batch * size - size // 2, batch * size + size).withColumn("of", F.greatest(F.expr(f"id DIV {size}"), F.lit(0)))
    at = F.expr(f"of * {DAY_MS} DIV {per_day}").alias("arrival_ms")
    return rows.where("id >= 0").select(F.expr("string(id % 3)").alias("shard_id"), F.col("id").cast("string").alias("sequence_number"), at, F.lit("p").alias("payload"))


def test_listing_does_not_grow_with_the_batches(spark, folder):
    """After 200 batches, 20 to a day, a batch lists the files of the days its copies can come from, and none of the history."""
    table = DayTable(f"{folder}/ledger", streaming.LEDGER, "arrival_day", ("shard_id", "sequence_number"), 1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    listed = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()

    def run(first, last):
        for batch in range(first, last):
            before = listed.getCount()
            fresh = streaming.new_sequences(sequences(spark, batch, 20), table, batch)
            streaming.write_ledger(fresh, table, batch)
            found[batch] = listed.getCount() - before
            if batch % 20 == 19:
                table.fold(spark, batch - 1, 5)

    found = {}
    run(0, 24)
    # The batches in between, stored in one go.
    rows = spark.range(24 * 20, 180 * 20).select(F.expr("string(id % 3)").alias("shard_id"), F.col("id").cast("string").alias("sequence_number"), F.expr("id DIV 20").alias("batch_id"))
    rows = rows.withColumn("arrival_ms", F.expr(f"batch_id * {DAY_MS} DIV 20")).withColumn("arrival_day", F.to_date(F.timestamp_millis("arrival_ms")))
    table._write(rows.select(*table._fields, "arrival_day", "batch_id"), table.name)
    table.fold(spark, 179, 5)
    run(180, 200)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert table.all_rows(spark).select("shard_id", "sequence_number").distinct().count() == table.all_rows(spark).count() == 200 * 20
    assert max(len(b) for b in table.partitions(spark).values()) <= 25
    early, late = ([found[b] for b in part] for part in (range(24), range(180, 200)))
    # Three days at most, each of them folded or of at most 20 batches.
    assert max(late) <= 3 * 20 and max(early) <= 3 * 20, (early, late)


def test_stored_side_is_not_shuffled(spark, folder):
    table = DayTable(f"{folder}/ledger", streaming.LEDGER, "arrival_day", ("shard_id", "sequence_number"), 4)
    streaming.write_ledger(sequences(spark, 3, 1), table, 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = streaming.new_sequences(sequences(spark, 4, 1), table, 4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The second child of the join, down to the scan of the ledger, holds no exchange.
    stored = plan.split("LeftAnti")[1].split("\n   +- ")[-1]
    assert "Bucketed: true" in stored and "Exchange" not in stored


def test_bucket_number_stays_with_the_files(spark, folder):
    keys = ("shard_id", "sequence_number")
    streaming.write_ledger(sequences(spark, 1, 1), DayTable(f"{folder}/l", streaming.LEDGER, "arrival_day", keys, 3), 1)
    table = DayTable(f"{folder}/l", streaming.LEDGER, "arrival_day", keys, 7)
    spark.sql(f"DROP TABLE {table.name}")  # as a new session
    assert streaming.new_sequences(sequences(spark, 1, 1), table, 2).count() == 0


def batches(spark, parts):
    rows = ingest(samples.raw_telemetry(spark, FOLDER)).checked.where(F.col("arrival_ms") < UNTIL_MS)
    return [rows.where(F.crc32(F.col("sequence_number").cast("binary")) % parts == i) for i in range(parts)]


def counting(table, spark):
    return sorted(tuple(r) for r in table.rows(spark).select(*COLUMNS).collect())


def keys_of(rows):
    return sorted(r[:3] for r in rows)


def test_ingest_across_compactions(spark, folder, monkeypatch):
    """A compaction that breaks off, a new session, a replay and more batches: each natural key is stored once."""
    target = streaming.IngestTarget(f"{folder}/out", 3)
    store, parts, table = streaming.store_batch(target), batches(spark, 4), streaming.IngestTarget(f"{folder}/out").readings_table
    for i in range(3):
        store(parts[i], i)
    before, day = counting(table, spark), date(2024, 1, 4)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(DayTable, "_forget", broken)
        with pytest.raises(RuntimeError, match="lost"):
            streaming.compact_days(spark, target, day)
    assert len(table._superseded(spark)) == 1 and counting(table, spark) == before
    for t in (target.readings_table, target.keys_table, target.ledger_table):
        spark.sql(f"DROP TABLE {t.name}")
    assert counting(table, spark) == before
    done = streaming.compact_days(spark, target, day)
    assert done and max(done) < day and counting(table, spark) == before
    store(parts[2], 2)  # a replay of the last batch, which the compaction must not have covered
    assert counting(table, spark) == before
    store(parts[3], 3)
    store(parts[0], 4)
    after = counting(table, spark)
    assert keys_of(after) == keys_of(tuple(r) for r in ingest(samples.raw_telemetry(spark, FOLDER).where(F.col("arrival_ms") < UNTIL_MS)).kept.select(*COLUMNS).collect())
    assert set(before) <= set(after)
    assert streaming.compact_days(spark, target, date(2030, 1, 1)) and counting(table, spark) == after
    assert table.sweep(spark) > 0 and table.sweep(spark) == 0
    assert sorted(tuple(r) for r in spark.read.parquet(target.readings).select(*COLUMNS).collect()) == after


def test_expired_days_are_removed_with_their_keys(spark, folder):
    target = streaming.IngestTarget(f"{folder}/out", 2)
    for i, part in enumerate(batches(spark, 2)):
        streaming.store_batch(target)(part, i)
    rows = spark.read.parquet(target.readings).select("event_date", "ttl").collect()
    gone = streaming.remove_expired(spark, target, date(2024, 2, 4))
    midnight = 1_707_004_800
    last = {d: max(r.ttl for r in rows if r.event_date == d) for d in {r.event_date for r in rows}}
    assert gone == sorted(d for d, ttl in last.items() if d < date(2024, 1, 5) and ttl <= midnight) and gone
    left = spark.read.parquet(target.readings)
    assert left.count() == sum(r.event_date not in gone for r in rows)
    assert not {r.event_date for r in spark.read.parquet(f"{folder}/out/keys").select("event_date").distinct().collect()} & set(gone)


def test_clock_is_asked_for_each_batch_and_kept_for_a_replay(spark, folder):
    target = streaming.IngestTarget(f"{folder}/out", 2)
    late = 1_800_000_000_000
    times = iter([0, late])
    store = streaming.store_batch(target, lambda: next(times))
    first, second = batches(spark, 2)
    store(first, 0)
    store(second, 1)
    store(second, 1)  # asks for no third time
    aged = spark.read.parquet(target.quarantine).where(F.array_contains("errors", "aged"))
    assert {r.batch_id for r in aged.select("batch_id").distinct().collect()} == {1} and aged.count() == second.count()
