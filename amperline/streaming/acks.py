"""The acknowledgement wait on streams: as an interval join, and with timers.

A missing acknowledgement shows only once event time has moved past the wait.
On a live stream later alerts move it; a stream that ends, or is quiet, needs a
heartbeat row on both sides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from amperline.operators.dedup import LEDGER_HOURS
from amperline.operators.workflow import WAIT_MS

HEARTBEAT = "heartbeat"
MARKS = "case_pk string, at_ms bigint"
OUTCOMES = "case_pk string, notified_ms bigint, ack_ms bigint, escalated boolean"
# Cases are dealt into so many buckets of timers; a checkpoint keeps to its number.
BUCKETS = 1024


def beat(spark: SparkSession, folder: str, at: str | None = None) -> None:
    """Add a row that tells how far time has come: now, or ``at`` for input that has an end.

    A live stream beats again and again with the current time; a far date would make all later rows late.
    """
    at_ms = F.unix_millis(F.current_timestamp() if at is None else F.lit(at).cast("timestamp"))
    spark.range(1).select(F.lit(HEARTBEAT).alias("case_pk"), at_ms.alias("at_ms")).write.mode("append").parquet(folder)


def heartbeat_stream(spark: SparkSession, folder: str, at: str | None = None) -> DataFrame:
    """The stream of heartbeats in a folder, begun with one."""
    beat(spark, folder, at)
    return spark.readStream.schema(MARKS).parquet(folder)


def ack_join(
    alerts: DataFrame, acks: DataFrame, heartbeat: DataFrame, wait_ms: int = WAIT_MS
) -> DataFrame:
    """Stream-stream left join of alerts (``case_pk, at_ms``) and acknowledgements.

    Both sides are bounded by a watermark, so an alert leaves the state when
    its wait is over.  The heartbeat's own row is part of the result and is
    removed by ``first_acks``: a filter here would be pushed below the
    watermarks, which then would not see it.
    """
    def timed(df: DataFrame, key: str, at: str) -> DataFrame:
        return df.unionByName(heartbeat).select(
            F.col("case_pk").alias(key), F.timestamp_millis("at_ms").alias(at)
        ).withWatermark(at, "10 minutes")

    left = timed(alerts, "case_pk", "notified_ts")
    right = timed(acks, "acked_pk", "ack_ts")
    wait = F.expr(f"interval {wait_ms // 1000} seconds")
    joined = left.join(
        right,
        (F.col("case_pk") == F.col("acked_pk"))
        & (F.col("ack_ts") >= F.col("notified_ts"))
        & (F.col("ack_ts") <= F.col("notified_ts") + wait),
        "left",
    )
    return joined.select(
        "case_pk",
        F.unix_millis("notified_ts").alias("notified_ms"),
        F.unix_millis("ack_ts").alias("ack_ms"),
        F.col("ack_ts").isNull().alias("escalated"),
    )


def first_acks(outcomes: DataFrame) -> DataFrame:
    """Fold of the join's rows: an alert that was acknowledged twice has two of them."""
    return outcomes.where(F.col("case_pk") != HEARTBEAT).groupBy("case_pk", "notified_ms").agg(
        F.min("ack_ms").alias("ack_ms"), F.min("escalated").alias("escalated")
    )


class AckTimer(StatefulProcessor):
    """Per case: the alert, its acknowledgements, and a mark once the wait is over.

    Acknowledgements may come before their alert: all are kept and the first one within the wait counts, whatever
    the batches were.  State goes by timers: the wait's own, that of acknowledgements without an alert, and that of
    the closed mark, which keeps a redelivered alert from waiting again.
    """

    wait_ms = WAIT_MS
    closed_ms = LEDGER_HOURS * 3_600_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.alert = handle.getValueState("alert", "at_ms long")
        self.acks = handle.getListState("acks", "at_ms long")
        self.closed = handle.getValueState("closed", "at_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        (case_pk,) = key
        if case_pk != HEARTBEAT and not self.closed.exists():
            frame = pd.concat(rows, ignore_index=True)
            notified = frame.loc[frame["kind"] == "alert", "at_ms"]
            acked = sorted({int(t) for t in frame.loc[frame["kind"] == "ack", "at_ms"]})
            if len(notified) and not self.alert.exists():
                start = int(notified.min())
                self.alert.update((start,))
                self.handle.registerTimer(start + self.wait_ms)
            known = {int(t[0]) for t in self.acks.get()} if self.acks.exists() else set()
            for at in acked:
                if at not in known:
                    self.acks.appendValue((at,))
                    if not self.alert.exists():
                        self.handle.registerTimer(at + self.wait_ms)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.closed.exists():
            if now >= int(self.closed.get()[0]) + self.closed_ms:
                self.closed.clear()
            return
        acks = [int(t[0]) for t in self.acks.get()] if self.acks.exists() else []
        if not self.alert.exists():
            left = [(t,) for t in acks if t + self.wait_ms > now]
            self.acks.put(left) if left else self.acks.clear()
            return
        start = int(self.alert.get()[0])
        if now < start + self.wait_ms:
            return
        ack = min((t for t in acks if start <= t <= start + self.wait_ms), default=None)
        self.alert.clear()
        self.acks.clear()
        self.closed.update((now,))
        self.handle.registerTimer(now + self.closed_ms)
        yield pd.DataFrame(
            {
                "case_pk": [key[0]],
                "notified_ms": [start],
                "ack_ms": pd.array([ack], dtype="Int64"),
                "escalated": [ack is None],
            }
        )

    def close(self) -> None:
        pass


class BucketAckTimer(StatefulProcessor):
    """``AckTimer`` for a bucket of cases: one call and one read of state serve all its cases, not one each.

    Marks are appended as they come, one state entry per batch.  A timer at the bucket's earliest due time goes through
    them and writes back what still waits.  An alert is the first one of its case in the list; marks behind a closed
    mark are redelivered ones.
    """

    wait_ms = AckTimer.wait_ms
    closed_ms = AckTimer.closed_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.marks = handle.getListState("marks", "kind array<string>, case_pk array<string>, at_ms array<bigint>")
        self.due = handle.getValueState("due", "at_ms bigint")

    def _wake(self, at: int) -> None:
        if not self.due.exists() or at < int(self.due.get()[0]):
            self.due.update((at,))
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        alerts, acks = {}, set()
        for frame in rows:
            frame = frame[frame["at_ms"].notna() & (frame["case_pk"] != HEARTBEAT)]
            for kind, case, at in zip(frame["kind"], frame["case_pk"], frame["at_ms"].astype("int64").tolist()):
                if kind == "ack":
                    acks.add((case, at))
                else:
                    alerts[case] = min(at, alerts.get(case, at))
        marks = [("alert", *mark) for mark in alerts.items()] + [("ack", *mark) for mark in acks]
        if marks:
            self.marks.appendValue(tuple(map(list, zip(*marks))))
            self._wake(min(at for _, _, at in marks) + self.wait_ms)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.due.exists() or expiredTimerInfo.getExpiryTimeInMs() < int(self.due.get()[0]):
            return  # all that was due then has been seen to
        now = timerValues.getCurrentWatermarkInMs()
        closed, alerts, acks = {}, {}, defaultdict(set)
        for entry in self.marks.get():
            for kind, case, at in zip(*entry):
                if kind == "closed":
                    closed[case] = at
                elif case in closed:
                    continue
                elif kind == "alert":
                    alerts.setdefault(case, at)
                else:
                    acks[case].add(at)
        closed = {case: at for case, at in closed.items() if at + self.closed_ms > now}
        over = {case: at for case, at in alerts.items() if at + self.wait_ms <= now}
        found = [(case, at, min((t for t in acks.pop(case, ()) if at <= t <= at + self.wait_ms), default=None)) for case, at in over.items()]
        closed |= {case: at + self.wait_ms for case, at in over.items() if at + self.wait_ms + self.closed_ms > now}
        left = [("closed", *mark) for mark in closed.items()] + [("alert", *mark) for mark in alerts.items() if mark[0] not in over]
        left += [("ack", case, at) for case, times in acks.items() for at in times if case in alerts or at + self.wait_ms > now]
        self.due.clear()
        self.marks.clear()
        if left:
            self.marks.appendValue(tuple(map(list, zip(*left))))
            # Acknowledgements of a waiting alert go with it.
            self._wake(min(at + (self.closed_ms if kind == "closed" else self.wait_ms) for kind, case, at in left if kind != "ack" or case not in alerts))
        if found:
            cases, starts, first = zip(*found)
            yield pd.DataFrame(
                {
                    "case_pk": cases,
                    "notified_ms": starts,
                    "ack_ms": pd.array(first, dtype="Int64"),
                    "escalated": [at is None for at in first],
                }
            )

    def close(self) -> None:
        pass


def ack_timer(alerts: DataFrame, acks: DataFrame, heartbeat: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The same outcome from event-time timers, for long waits.

    Rows are spread by buckets of case keys; with ``buckets=0`` every case has a key and timers of its own, which costs
    milliseconds a case.  The interval join is the usual form; this one is for waits too long to keep joined rows in
    state.
    """
    rows = (
        alerts.withColumn("kind", F.lit("alert"))
        .unionByName(acks.withColumn("kind", F.lit("ack")))
        .unionByName(heartbeat.withColumn("kind", F.lit("alert")))
        .withColumn("at_ts", F.timestamp_millis("at_ms"))
        .withWatermark("at_ts", "10 minutes")
    )
    if buckets:
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("case_pk"), F.lit(buckets)))
    return rows.groupBy("bucket" if buckets else "case_pk").transformWithStateInPandas(
        statefulProcessor=BucketAckTimer() if buckets else AckTimer(),
        outputStructType=OUTCOMES,
        outputMode="append",
        timeMode="EventTime",
    )
