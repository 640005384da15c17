"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are the byte n-grams (``SIZES``) of the text, lower-cased A-Z, hashed to ``1 << BITS`` cells; words and their endings
are built from few syllables in many languages, so parts of words tell more than words.  A token's weight is the log-odds
ratio of toxic against other labelled texts with an informative Dirichlet prior (the token's share in all labelled texts,
worth ``PRIOR`` tokens); tokens whose ratio is below ``MIN_Z`` standard errors weigh nothing.  A token counts once in a text.

Each byte scores the largest weight of the tokens that begin at it, less ``DRIFT``.  One linear scan finds all maximal
scoring segments of a text.  The best chance segment of n bytes has an extreme-value law: about ``K n exp(-scale s)``
segments reach s.  ``K`` and ``scale`` come from the tail of texts labelled clean, the expected number of chance segments
turns into a score from 0 to 1, and 0.5 lies where labelled texts are told apart best.

State is bounded by the cells and by score bins, never by texts or vocabulary.  Null texts are empty and score 0, as does a
text without any toxic token; so does everything if one of the labels is missing.  Several labels of a document: the
largest counts.  Repeated rows score alike; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.bytetext import LOWER, chunks, flat, mix, powers, prefix
from amperline.llm.store import written

SIZES = (5, 6, 8, 10)
BITS = 20
PRIOR = 1000.0
MIN_Z = 4.0
DRIFT = 1.0
CELLS = 1 << BITS
PART = 1024


def _cells(data: np.ndarray) -> list[np.ndarray]:
    """For each n-gram size the cell of the token that begins at each byte."""
    sums = prefix(LOWER[data])
    down = powers(len(data), "down")
    found = []
    for n in SIZES:
        hashes = (sums[n:] - sums[:-n]) * down[: max(len(data) - n + 1, 0)] if len(data) >= n else np.zeros(0, np.uint64)
        found.append((mix(hashes + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32))
    return found


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each token, by label; one dense table per task, cut into parts."""
    counts = np.zeros((CELLS, 2), np.int32)
    for batch in chunks(batches):
        data, offsets = flat(batch.column(0))
        labels = batch.column(1).to_pylist()
        cells = _cells(data)
        for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            for n, own in zip(SIZES, cells, strict=True):
                if b - a >= n:
                    counts[np.unique(own[a : b - n + 1]), labels[row]] += 1
    used = np.flatnonzero(counts.reshape(-1, 2 * PART).any(axis=1))
    parts = counts.reshape(-1, 2 * PART)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([parts[i].astype("<i4").tobytes() for i in used], pa.binary())], ["part", "counts"])


def _add(table: pa.Table) -> pa.Table:
    total = np.zeros(2 * PART, np.int64)
    for raw in table.column("counts").to_pylist():
        total += np.frombuffer(raw, "<i4")
    return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def weights(train: DataFrame) -> np.ndarray:
    """Log-odds of each cell from ``train(text, label)``; gathers one table of the cells' size."""
    # As many tables as tasks can run at once, however many partitions there are.
    few = train.coalesce(train.sparkSession.sparkContext.defaultParallelism)
    rows = few.mapInArrow(_count, "part int, counts binary").groupBy("part").applyInArrow(_add, "part int, counts binary").collect()
    counts = np.zeros((CELLS // PART, 2 * PART))
    for row in rows:
        counts[row.part] = np.frombuffer(row.counts, "<i8")
    clean, toxic = counts.reshape(-1, 2).T
    if not clean.any() or not toxic.any():
        return np.zeros(CELLS, np.float32)
    every = clean + toxic + 0.01
    prior = PRIOR * every / every.sum()
    odds = lambda n: np.log((n + prior) / (n.sum() + PRIOR - n - prior))
    ratio = odds(toxic) - odds(clean)
    error = np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    return np.where(ratio > MIN_Z * error, ratio, 0).astype(np.float32)


def segments(positions: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last + 1, score) of a sequence in which ``positions`` score
    ``scores - drift`` and all others ``-drift``; linear in the number of positions.
    """
    # Each candidate: its ends, the running totals before and after it, and the nearest candidate that starts lower.
    done: list[tuple[int, int, float]] = []
    stack: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for position, score in zip(positions, scores, strict=True):
        total -= drift * (position - at)
        left, first, right = total, position, total + score - drift
        total, at = right, position + 1
        if right <= left:
            continue
        below = len(stack) - 1
        while True:
            while below >= 0 and stack[below][2] >= left:
                below = stack[below][4]
            if below < 0 or stack[below][3] >= right:
                break
            first, left, lower = stack[below][0], stack[below][2], stack[below][4]
            del stack[below:]
            below = lower
        if below < 0:
            # Nothing before can be joined to this candidate or to a later one.
            done += [(a, b, high - low) for a, b, low, high, _ in stack]
            stack.clear()
        stack.append((first, position + 1, left, right, below))
    return done + [(a, b, high - low) for a, b, low, high, _ in stack]


def _scan(batches: Iterable[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:  # noqa: ANN001 - a broadcast value
    weight = table.value
    for batch in chunks(batches):
        data, offsets = flat(batch.column(1))
        best = np.zeros(len(data), np.float32)
        for n, cells in zip(SIZES, _cells(data), strict=True):
            found = weight[cells]
            for k in range(1, n):  # not across texts
                found[offsets[1:-1][(offsets[1:-1] >= k) & (offsets[1:-1] - k < len(found))] - k] = 0
            np.maximum(best[: len(found)], found, out=best[: len(found)])
        hits = np.flatnonzero(best)
        bounds = np.searchsorted(hits, offsets).tolist()
        values = best[hits].tolist()
        tops, all_segments = [], []
        for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            found = segments((hits[a:b] - offsets[row]).tolist(), values[a:b]) if b > a else []
            tops.append(max((s for _, _, s in found), default=0.0))
            all_segments.append([{"first": x, "last": y, "score": s} for x, y, s in found])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(tops, pa.float64()), pa.array(all_segments, kind)], ["doc_id", "n_bytes", "best", "segments"]
        )


def _law(train: DataFrame) -> tuple[float, float]:
    """``scale`` and ``K`` of the chance segments, from the tail of clean texts (best, n_bytes)."""
    clean = train.where("label = 0")
    cut = clean.where("best > 0").agg(F.percentile_approx("best", 0.5)).first()[0]
    if cut is None:
        return 1.0, 1.0
    row = clean.agg(
        F.sum(F.when(F.col("best") > cut, F.col("best") - cut)).alias("excess"), F.sum(F.when(F.col("best") > cut, 1)).alias("n"), F.sum("n_bytes").alias("bytes")
    ).first()
    if not row.n or not row.excess or not row.bytes:
        return 1.0, 1.0
    scale = row.n / row.excess
    return scale, row.n * math.exp(min(scale * cut, 600.0)) / row.bytes


def _cut(train: DataFrame, chance: F.Column) -> float:
    """Where the log of the expected chance segments tells labelled texts apart best, from counts in bins."""
    bins = train.where("best > 0").groupBy(F.floor(F.greatest(F.lit(-700.0), F.least(F.lit(100.0), chance)) * 4).alias("bin")).agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    total = train.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).first()
    if not total.toxic or not total.clean:
        return -5.0
    best, at, toxic, clean = -1.0, -5.0, 0, 0
    rows = sorted(bins.collect())
    for i, (bin_, t, c) in enumerate(rows):
        toxic, clean = toxic + t, clean + c
        gain = toxic / total.toxic - clean / total.clean
        if gain > best:
            # Halfway to the next bin that has texts.
            best, at = gain, (bin_ + 1 + (rows[i + 1][0] if i + 1 < len(rows) else bin_ + 1)) / 8
    return at


def scored(docs: DataFrame, labels: DataFrame, held_out: F.Column, column: str = "toxic") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, best, segments.

    ``held_out`` is an expression over ``doc_id``; such rows are not learnt from.  ``segments`` are the significant passages:
    fewer than 0.01 such are expected by chance in a text of this length.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out)
    known = known.groupBy("doc_id").agg(F.max(F.col(column)).cast("int").alias("label"))
    rows = docs.select("doc_id", "text")
    # The labels grow with the corpus: the same join at every size.
    table = rows.sparkSession.sparkContext.broadcast(weights(rows.join(known.hint("merge"), "doc_id").select("text", "label")))
    schema = "doc_id long, n_bytes long, best double, segments array<struct<first: long, last: long, score: double>>"
    found = written(rows.mapInArrow(partial(_scan, table=table), schema), "toxic-segments")
    train = found.select("doc_id", "n_bytes", "best").join(known, "doc_id")
    scale, chance = _law(train)
    log_chance = lambda s: math.log(chance) + F.log(F.greatest("n_bytes", F.lit(1))) - scale * s
    cut = _cut(train, log_chance(F.col("best")))
    score = F.when(F.col("best") > 0, 1 / (1 + F.exp(F.greatest(F.lit(-600.0), F.least(F.lit(600.0), log_chance(F.col("best")) - cut))))).otherwise(0.0)
    return (
        found.withColumn("score", score)
        .withColumn("segments", F.filter("segments", lambda s: log_chance(s.score) < math.log(0.01)))
        .select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "best", "segments")
    )
