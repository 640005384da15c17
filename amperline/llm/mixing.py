"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

The words of the corpus are shared out to its sources by weight.  A source is clamped at ``MAX_EPOCHS`` times its own words,
and what it can't use goes to the others by weight, until no share is above its limit.  A source's target is then spent on
whole repetitions of all its documents and, for the rest, on one more repetition of a part of them: in an order drawn
from the seed, documents are taken until the rest is used up, the last one with its first words only.

Defined results: a null or empty text has no words and takes none; null is a source like any other, last in order;
repeated rows are documents of their own (which of equal rows is taken does not show); an empty table gives no rows; columns
other than doc_id, source and text play no part unless they are named in ``carry``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from amperline.llm.ordered import numbered
from amperline.llm.store import written

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
CYCLE = (1, 2, 3)
SEED = 20240601
# Hex digits of a draw that name its bucket: a source's running sum has at most 16 ** 4 steps.
BUCKET_DIGITS = 4
# ``monotonically_increasing_id`` numbers rows within partitions; above these bits stands the partition.
PLACE_BITS = 33


def sized(docs: DataFrame, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, source, size``, the document's draw, and a number that tells equal rows apart; stored."""
    named = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit("")))
    rows = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(named.cast("binary")).alias("draw"),
        F.monotonically_increasing_id().alias("tie"),
        *carry,
    )
    return written(rows, "sized")


def cycled_weights(sources: DataFrame, cycle: Sequence[int] = CYCLE) -> DataFrame:
    """``source, weight``: the weights of ``cycle`` in turn, to the sources by code point, null last."""
    placed = numbered(sources.select(F.col("source").isNull().alias("absent"), "source"), ("absent", "source"))
    turn = F.element_at(F.array(*map(F.lit, cycle)), (F.col("n") % len(cycle) + 1).cast("int"))
    return placed.select("source", turn.cast("long").alias("weight"))


def _exact(column: str):
    return F.col(column).cast("decimal(19,0)")


def filled(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of ``sources(source, source_size, weight)`` by capped water-filling.

    Each round clamps the sources whose share of the free words is above their limit; their words and weights leave the
    pool.  Only the pool's two totals come to the driver.  Comparisons are exact, on integers.
    """
    capped = sources.withColumn("cap", F.col("source_size") * max_epochs)
    words, weight = capped.agg(F.sum("source_size"), F.sum("weight")).first()
    words, weight = words or 0, weight or 0

    def above(pool_words: int, pool_weight: int):
        return _exact("cap") * F.lit(pool_weight).cast("decimal(19,0)") < _exact("weight") * F.lit(pool_words).cast("decimal(19,0)")

    free = (words, weight)
    while True:
        used, gone = capped.where(above(*free)).agg(F.sum("cap"), F.sum("weight")).first()
        pool = (words - (used or 0), weight - (gone or 0))
        if pool == free:
            break
        free = pool
    share = (_exact("weight") * F.lit(free[0]).cast("decimal(19,0)")).cast("double") / F.lit(float(max(free[1], 1)))
    target = F.when(above(*free), F.col("cap").cast("double")).otherwise(share)
    return capped.withColumn("target", target).drop("cap")


def _crossed(rows: DataFrame, step: str) -> DataFrame:
    """Per source, the value of ``step`` at which the running sum of sizes reaches ``rest``, and what is left of the rest there."""
    sums = rows.groupBy("source_no", "rest", step).agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source_no").orderBy(step)) - F.col("words")
    reached = sums.withColumn("left", F.col("rest") - before).where("left > 0 AND left <= words")
    return reached.select("source_no", step, F.col("left").alias("rest"))


def _last_taken(rows: DataFrame) -> DataFrame:
    """Per source, draw and tie of the last row of the part that is taken once more, and how many of its words.

    The search narrows down: bucket of draws, draw, then among equal rows their partition and their number.
    """
    buckets = _crossed(rows, "bucket")
    near = written(rows.drop("rest").join(buckets, ["source_no", "bucket"]), "boundary")
    for step in ("draw", "block", "tie"):
        found = _crossed(near, step)
        near = near.drop("rest").join(found, ["source_no", step])
    return written(near.select("source_no", F.col("draw").alias("last_draw"), F.col("tie").alias("last_tie"), F.col("rest").alias("last_words")), "last")


def mixed(
    docs: DataFrame,
    weights: DataFrame | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per document ``doc_id, source, size, source_size, weight, target, whole, extra, taken``.

    ``whole`` counts full repetitions, ``extra`` the words of the fractional one.  ``weights`` holds ``source, weight``
    (whole numbers, one row each; a source without one weighs 0); by default the weights 1, 2, 3 in turn.
    """
    rows = sized(docs, seed, carry)
    sizes = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    given = (cycled_weights(sizes) if weights is None else weights).select(F.col("source").alias("its_source"), "weight")
    weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("its_source")), "left").drop("its_source")
    weighed = written(weighed.withColumns({"weight": F.coalesce("weight", F.lit(0)).cast("long"), "source_no": F.monotonically_increasing_id()}), "weights")
    words = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("floor(target) DIV source_size")).otherwise(F.lit(0)).cast("long")
    plan = filled(weighed, max_epochs).withColumn("whole", whole).withColumn("rest", words - F.col("whole") * F.col("source_size"))
    plan = written(plan, "targets")
    keyed = plan.withColumnRenamed("source", "its_source")
    own = rows.join(keyed, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    part = own.where("rest > 0 AND size > 0").select(
        "source_no", "rest", "size", "draw", "tie",
        F.substring("draw", 1, BUCKET_DIGITS).alias("bucket"),
        F.shiftright("tie", PLACE_BITS).alias("block"),
    )
    ends = plan.select("source", "source_no").join(_last_taken(part), "source_no", "left")
    full = plan.join(ends.drop("source"), "source_no").withColumnRenamed("source", "its_source")
    out = rows.join(full, F.col("source").eqNullSafe(F.col("its_source")))
    extra = (
        F.when(F.col("last_draw").isNull() | (F.col("draw") > F.col("last_draw")), F.lit(0))
        .when((F.col("draw") < F.col("last_draw")) | (F.col("tie") < F.col("last_tie")), F.col("size"))
        .when(F.col("tie") == F.col("last_tie"), F.col("last_words"))
        .otherwise(F.lit(0))
        .cast("long")
    )
    out = out.withColumn("extra", extra).withColumn("taken", F.col("whole") * F.col("size") + F.col("extra"))
    return out.select("doc_id", "source", "size", "source_size", "weight", "target", "whole", "extra", "taken", *carry)


def repeated(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: ``doc_id, source, epoch, text``, one row per repetition; a cut one holds its first words, joined by spaces."""
    plan = mixed(docs, carry=("text",), **how).where("taken > 0")
    times = F.sequence(F.lit(1).cast("long"), F.col("whole") + (F.col("extra") > 0).cast("long"))
    each = plan.withColumn("epoch", F.explode(times))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})")), 1, F.col("extra").cast("int")), " ")
    partial = (F.col("epoch") > F.col("whole")) & (F.col("extra") < F.col("size"))
    return each.select("doc_id", "source", "epoch", F.when(partial, cut).otherwise(F.col("text")).alias("text"))
