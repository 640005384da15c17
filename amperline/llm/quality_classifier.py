"""Supervised subword embeddings: a linear classifier over averaged n-gram vectors.

A document's features are its words, its byte trigrams (which hold characters and their surroundings in any script) and, as
word n-grams with the words themselves left out, whether a word equals the one 1 to ``BACK`` before it.  All are hashed
to ``CELLS`` learned vectors of ``WIDTH`` numbers; a document is the mean of its features' vectors, and a softmax layer gives its
class.  Vectors and layer are trained together by stochastic gradient descent in numpy.

Training uses at most ``SAMPLE`` labelled documents, those with the smallest hashes of their ids; their features are
counted in tasks, and only (cell, count) pairs reach the driver.  Scoring covers all documents: vectors and layer are
folded into one number per cell, so a document's score is a sum over its whole text.

Null texts are empty; an empty text gets the share of label 1.  With one class or none among the labels, so do all.
Several labels of a document: the largest counts.  Repeated rows score alike; columns other than ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.bytetext import WHITE, chunks, flat, mix, prefix, range_hashes, spans

BITS = 16
CELLS = 1 << BITS
WIDTH = 8
BACK = 4
SAMPLE = 4000
EPOCHS = 12
RATE = 0.5
BATCH = 16
#: The step of the vectors, as a multiple of that of the layer: a feature has a small share of a document.
GAIN = 4.0


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Kinds of features: the cells, and the index of each text's first one (one more than there are texts)."""
    starts, ends = spans(~WHITE[data], offsets)
    words = range_hashes(prefix(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    bounds = np.searchsorted(starts, offsets)
    yield (words >> np.uint64(64 - BITS)).astype(np.int32), bounds
    for back in range(1, BACK + 1):
        same = np.zeros(len(words), bool)
        same[back:] = words[back:] == words[:-back] if back < len(words) else False
        for k in range(back):  # not across texts
            first = bounds[:-1] + k
            same[first[first < bounds[1:]]] = False
        marks = mix(np.array([2 * back, 2 * back + 1], np.uint64)) >> np.uint64(64 - BITS)
        yield marks.astype(np.int32)[same.astype(np.int8)], bounds
    wide = data.astype(np.uint64)
    grams = wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16) if len(wide) > 2 else np.zeros(0, np.uint64)
    inside = np.ones(len(grams), bool)
    for k in (1, 2):
        cut = offsets[1:-1] - k
        inside[cut[(cut >= 0) & (cut < len(grams))]] = False
    places = np.flatnonzero(inside)
    yield (mix(grams[places] + np.uint64(1 << 32)) >> np.uint64(64 - BITS)).astype(np.int32), np.searchsorted(places, offsets)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        kinds = list(_features(*flat(batch.column(0))))
        cells, counts = [], []
        for row in range(batch.num_rows):
            own = np.concatenate([c[b[row] : b[row + 1]] for c, b in kinds])
            found, times = np.unique(own, return_counts=True)
            cells.append(found.astype(np.int32))
            counts.append(times.astype(np.int32))
        lists = [pa.array(x, pa.list_(pa.int32())) for x in (cells, counts)]
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *lists], ["label", "at", "cells", "counts"])


def train(cells: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, seed: int = 10) -> tuple[np.ndarray, float]:
    """One number per cell, whose mean over a document's features plus the second result is the log-odds of label 1."""
    share = min(max(float(labels.mean()) if len(labels) else 0.5, 1e-3), 1 - 1e-3)
    if len(set(labels.tolist())) < 2:
        return np.zeros(CELLS, np.float32), float(np.log(share / (1 - share)))
    random = np.random.Generator(np.random.PCG64(seed))
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (CELLS, WIDTH))
    layer = random.uniform(-1 / WIDTH, 1 / WIDTH, (WIDTH, 2))
    bias = np.log([1 - share, share])
    usable = [i for i in range(len(labels)) if len(cells[i])]
    shares = {i: counts[i] / counts[i].sum() for i in usable}
    steps, done = EPOCHS * -(-len(usable) // BATCH), 0
    for _ in range(EPOCHS):
        order = random.permutation(usable)
        for first in range(0, len(order), BATCH):
            rate = RATE * (1 - done / steps)
            done += 1
            chosen = order[first : first + BATCH]
            ids = np.concatenate([cells[i] for i in chosen])
            weight = np.concatenate([shares[i] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(cells[i]) for i in chosen])
            begin = np.flatnonzero(np.diff(row, prepend=-1))
            means = np.add.reduceat(vectors[ids] * weight[:, None], begin)
            logits = means @ layer + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(chosen)), labels[chosen]] -= 1
            to_means = chance @ layer.T
            layer -= rate * (means.T @ chance) / len(chosen)
            bias -= rate * chance.mean(axis=0)
            # Each document moves the vectors of its features by their shares; summed over a batch.
            np.add.at(vectors, ids, -rate * GAIN * to_means[row] * weight[:, None])
    folded = vectors @ (layer[:, 1] - layer[:, 0])
    return folded.astype(np.float32), float(bias[1] - bias[0])


def _score(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:  # noqa: ANN001 - a broadcast value
    folded, bias = model.value
    for batch in chunks(batches):
        total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for cells, bounds in _features(*flat(batch.column(1))):
            sums = np.concatenate([[0.0], np.cumsum(folded[cells], dtype=np.float64)])
            total += sums[bounds[1:]] - sums[bounds[:-1]]
            count += np.diff(bounds)
        odds = total / np.maximum(count, 1) + bias
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(odds, -700, 700))))], ["doc_id", "score"])


def scored(docs: DataFrame, labels: DataFrame, held_out: F.Column, column: str = "quality") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.  ``held_out`` is an expression over ``doc_id``; such rows are not learnt from."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out)
    known = known.groupBy("doc_id").agg(F.max(F.col(column)).cast("int").alias("label"))
    # One of repeated rows, and only labels that have a document, so that the bound holds for rows and is used by documents.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    chosen = known.join(texts.select("doc_id", "text_hash").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text_hash").limit(SAMPLE)
    rows = texts.join(chosen, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]).select("text", "label", F.xxhash64("doc_id", "text").alias("at"))
    sample = rows.mapInArrow(_counted, "label int, at long, cells array<int>, counts array<int>").toArrow().combine_chunks()
    sample = sample.sort_by("at")
    lists = [[x.values.to_numpy() for x in sample.column(c)] for c in ("cells", "counts")]
    model = spark.sparkContext.broadcast(train(*lists, sample.column("label").to_numpy().astype(np.int64)))
    found = docs.select("doc_id", "text").mapInArrow(partial(_score, model=model), "doc_id long, score double")
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
