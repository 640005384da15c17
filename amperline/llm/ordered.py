"""Places of rows in a total order, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from amperline.llm.store import written


def numbered(df: DataFrame, order: Sequence[str], within: str | None = None) -> DataFrame:
    """Add ``n``, the row's place from 0 in ascending ``order`` (nulls first), and ``total``, the number of rows; both within each value of ``within``.

    ``order`` starts with ``within``, and its last column tells rows apart.  Ranges of the order are dealt out and stored
    with the number of their part, so that a group of any size lies in many parts; only the parts' row counts are summed up.
    """
    keys = [within] if within else []
    parts = written(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ordered")
    counts = parts.groupBy(*keys, "part").agg(F.count("*").alias("rows"))
    group = Window.partitionBy(*keys)
    before = counts.select(
        *[F.col(k).alias("its_group") for k in keys],
        F.col("part").alias("its_part"),
        (F.sum("rows").over(group.orderBy("part")) - F.col("rows")).alias("before"),
        F.sum("rows").over(group).alias("total"),
    )
    local = parts.withColumn("n", F.row_number().over(Window.partitionBy(*keys, "part").orderBy(*order)) - 1)
    same = F.col("part") == F.col("its_part")
    if within:
        same &= F.col(within).eqNullSafe(F.col("its_group"))
    return local.join(before, same).withColumn("n", F.col("n") + F.col("before")).drop("part", "its_part", "its_group", "before")
