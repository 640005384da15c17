"""Tables of a job in the session's catalogue: partitions by day and micro-batch are known without listing folders.

The files lie under a folder that outlives the session.  A session without a persistent catalogue lists that folder once,
when it opens the table; after that a batch reads what the catalogue names for its days, however long the history is.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"


@dataclass(frozen=True)
class DayTable:
    """Rows by ``day`` (a date column) and ``batch_id``; with ``keys`` also by buckets of them, sorted within.

    Every batch writes partitions of its own, so a replay overwrites them and nothing else.  A compaction puts a day's rows
    of the batches up to m into one partition, ``batch_id = -1 - m``; from the moment that partition stands, the day's partitions it
    was made from don't count any more, whether or not they have been removed yet.  So a compaction that breaks off
    neither loses nor doubles a row.
    """

    path: str
    columns: str
    day: str
    keys: tuple[str, ...] = ()
    buckets: int | None = None

    @property
    def name(self) -> str:
        return f"day_table_{hashlib.md5(self.path.encode()).hexdigest()}"

    @property
    def _fields(self) -> list[str]:
        return [c.split()[0] for c in self.columns.split(",")]

    def open(self, spark: SparkSession) -> str:
        """The table's name, after creating it in this session and finding the stored partitions where that has not been done."""
        if not spark.catalog.tableExists(self.name):
            bucketed, place = "", self.path.replace("'", "\\'")
            if self.keys:
                listed = ", ".join(self.keys)
                bucketed = f"CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {self._bucket_count(spark)} BUCKETS"
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name} ({self.columns}, {self.day} date, {BATCH} bigint) USING parquet"
                f" OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({self.day}, {BATCH}) {bucketed} LOCATION '{place}'"
            )
            # Nothing is written, but the folder is there from now on.
            none = spark.createDataFrame([], f"{self.columns}, {self.day} date, {BATCH} bigint")
            none.write.mode("append").partitionBy(self.day, BATCH).parquet(self.path)
            spark.sql(f"MSCK REPAIR TABLE {self.name}")
        return self.name

    def _bucket_count(self, spark: SparkSession) -> int:
        """The number of buckets the files were written with; for a new table ``buckets``, or as many as a shuffle has partitions."""
        wanted = self.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        place = f"{self.path}-buckets"
        # ``ignore`` keeps the number of an earlier job.
        spark.range(1).select(F.lit(wanted).alias("n")).write.mode("ignore").parquet(place)
        return spark.read.schema("n int").parquet(place).first().n

    def all_rows(self, spark: SparkSession) -> DataFrame:
        """Everything stored, for tables of keys: there a key that stands twice does no harm."""
        return spark.table(self.open(spark))

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows that count."""
        name = self.open(spark)
        # Another session of this job may have written since this one looked.
        spark.catalog.refreshTable(name)
        found = spark.table(name)
        for (day, _), old in self._superseded(spark).items():
            found = found.where(~((F.col(self.day) == F.lit(day)) & F.col(BATCH).isin(old)))
        return found

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Store one batch; ``rows`` hold the table's columns and its day."""
        spark = rows.sparkSession
        self._write(rows.select(*self._fields, self.day, F.lit(batch_id).cast("bigint").alias(BATCH)), self.open(spark))

    def _write(self, rows: DataFrame, name: str) -> None:
        if self.keys:
            # One task writes one bucket, so a partition has at most one file for each.
            count = int(rows.sparkSession.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first().data_type)
            dealt = rows.repartition(count, *self.keys)
        else:
            dealt = rows.hint("rebalance", self.day)
        dealt.write.mode("overwrite").insertInto(name)

    def partitions(self, spark: SparkSession) -> dict[dt.date, list[int]]:
        """Batches of each day, as the catalogue knows them."""
        found = defaultdict(list)
        for row in spark.sql(f"SHOW PARTITIONS {self.open(spark)}").collect():
            day, batch = (part.split("=")[1] for part in row.partition.split("/"))
            found[dt.date.fromisoformat(day)].append(int(batch))
        return found

    def _superseded(self, spark: SparkSession) -> dict[tuple[dt.date, int], list[int]]:
        """For each compacted day and its newest compaction, the batches that no longer count."""
        found = {}
        for day, batches in self.partitions(spark).items():
            newest = min(batches)
            old = [b for b in batches if newest < b <= -1 - newest]
            if old:
                found[day, newest] = sorted(old)
        return found

    def compact(self, spark: SparkSession, day: dt.date, up_to: int, sort: Sequence[str] = ()) -> bool:
        """Put the day's rows of the batches up to ``up_to`` into one partition of the same table.

        These batches must be finished: none of them is replayed any more.  Later batches of the day go on as they do.
        Returns whether there was anything to put together.
        """
        own = [b for b in self.partitions(spark).get(day, []) if b <= up_to]
        if len(own) < 2:
            return False
        name = self.open(spark)
        rows = self.rows(spark).where((F.col(self.day) == F.lit(day)) & (F.col(BATCH) <= up_to))
        rows = rows.select(*self._fields, self.day, F.lit(-1 - up_to).cast("bigint").alias(BATCH))
        if self.keys:
            rows = rows.dropDuplicates([*self.keys])
        if sort and not self.keys:
            # The rebalance comes first, so that files are sorted within.
            rows.hint("rebalance", self.day).sortWithinPartitions(*sort).write.mode("overwrite").insertInto(name)
        else:
            self._write(rows, name)
        self._forget(spark, day, self._superseded(spark).get((day, -1 - up_to), []))
        return True

    def fold(self, spark: SparkSession, up_to: int, loose: int) -> None:
        """Compact the days that have more than ``loose`` partitions, so that a day of many batches stays short."""
        for day, batches in self.partitions(spark).items():
            if len([b for b in batches if b <= up_to]) > loose:
                self.compact(spark, day, up_to)

    def _forget(self, spark: SparkSession, day: dt.date, batches: Sequence[int]) -> None:
        """Take partitions out of the catalogue; their files stay until ``sweep``."""
        if batches:
            listed = ", ".join(f"PARTITION ({self.day} = DATE'{day}', {BATCH} = {b})" for b in batches)
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {listed}")

    def _remove(self, spark: SparkSession, day: dt.date, batches: Sequence[int]) -> None:
        none = spark.createDataFrame([], self.columns)
        for b in batches:
            spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({self.day} = DATE'{day}', {BATCH} = {b}) SELECT * FROM {{none}}", none=none)
        self._forget(spark, day, batches)

    def sweep(self, spark: SparkSession) -> int:
        """Remove the files of partitions that no longer count; returns their number.  For the time between runs."""
        spark.sql(f"MSCK REPAIR TABLE {self.open(spark)}")
        found = self._superseded(spark)
        for (day, _), old in found.items():
            self._remove(spark, day, old)
        return sum(map(len, found.values()))

    def remove_days(self, spark: SparkSession, days: Sequence[dt.date]) -> None:
        """Remove whole days, files included."""
        spark.sql(f"MSCK REPAIR TABLE {self.open(spark)}")
        stored = self.partitions(spark)
        for day in days:
            self._remove(spark, day, stored.get(day, []))
