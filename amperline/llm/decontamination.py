"""Find training documents that hold benchmark items, also edited or paraphrased ones.

Items are cut into blocks of at most ``BLOCK`` words.  Seeds are runs of ``SEED`` words, and every one of a block is used, frequent
or not: which of them an edited copy keeps can't be told from the corpus.  Passages of documents around seeds are joined
with the blocks that have these seeds.  A passage must have so many of the block's words that the score can be reached at
all; if it has, it is aligned with the block by Smith-Waterman over words (``MATCH``, ``MISMATCH``, ``GAP``).  A block leaked
if the alignment reaches ``SHARE`` of the score of a full copy.  So every such alignment that holds a common seed is found.

Tasks know the benchmark's seeds by a bitmap of fixed size: it only keeps most other seeds out of the joins, and a benchmark
that fills it costs time, not results.

Words are runs of ASCII letters, digits and non-ASCII bytes, lower-cased A-Z.  Null texts have none; an item of fewer than
``SEED`` words can't be told from chance and matches nothing.  Repeated rows and items give one result row for each
(doc_id, item_id).  Columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.bytetext import chunks, flat, prefix, range_hashes, spans
from amperline.llm.shingles import shingle_hashes
from amperline.llm.store import written

SEED = 3
BLOCK = 64
STEP = 48
PASSAGE = 256
MATCH, MISMATCH, GAP = 2, -1, -2
SHARE = 0.45
# An alignment that reaches the share has at most 35 passage words in gaps, so it lies within so many words of any of its seeds.
AROUND = BLOCK + 36
BITMAP_BITS = 23

WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[np.r_[48:58, 65:91, 97:123, 128:256]] = True


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the index of each text's first word (one more than there are texts)."""
    data, offsets = flat(texts)
    starts, ends = spans(WORD_BYTES[data], offsets)
    words = range_hashes(prefix(data, lower=True), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return words, np.searchsorted(starts, offsets)


def _seeds(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds by the index of their first word, and which of them lie within a text."""
    if len(words) < SEED:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    seeds = shingle_hashes(words, SEED)
    inside = np.ones(len(seeds), bool)
    for k in range(1, SEED):
        cut = bounds[1:-1] - k
        inside[cut[(cut >= 0) & (cut < len(seeds))]] = False
    return seeds, inside


def _cell(seeds: np.ndarray) -> np.ndarray:
    return (seeds >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, bounds = _words(batch.column(1))
        signed = words.view(np.int64)
        rows: list[tuple] = []
        for item, a, b in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            for first in range(0, max(1, b - a - BLOCK + STEP), STEP):
                first = max(0, min(first, b - a - BLOCK))
                part = words[a + first : min(a + first + BLOCK, b)]
                if len(part) >= SEED:
                    seeds = shingle_hashes(part, SEED).view(np.int64)
                    rows.append((item, first, signed[a + first : a + first + len(part)], seeds))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.list_(pa.int64())) for i in (2, 3))],
            ["item_id", "block", "item_words", "seeds"],
        )


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """The bitmap of a column ``seed``, put together from at most 2 ** (BITMAP_BITS - 6) sums of bits."""
    cell = F.shiftrightunsigned("seed", 64 - BITMAP_BITS)
    bit = F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")
    words = seeds.select(cell.alias("cell")).groupBy(F.expr("CAST(cell DIV 64 AS INT)").alias("at")).agg(F.bit_or(bit).alias("bits")).toPandas()
    filled = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    filled[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return np.unpackbits(filled.view(np.uint8), bitorder="little").astype(bool)


def _passages(batches: Iterable[pa.RecordBatch], bitmap) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    """Stretches of text around seeds: seeds less than AROUND apart share one, up to PASSAGE words from first to last."""
    known = bitmap.value
    names = ["doc_id", "text_hash", "passage", "words", "seeds"]
    for batch in chunks(batches):
        words, bounds = _words(batch.column(2))
        seeds, inside = _seeds(words, bounds)
        hits = np.flatnonzero(inside & known[_cell(seeds)])
        if not len(hits):
            continue
        row = np.searchsorted(bounds, hits, "right") - 1
        rows, first = [], 0
        for i in range(1, len(hits) + 1):
            if i == len(hits) or row[i] != row[first] or hits[i] - hits[i - 1] >= AROUND or hits[i] - hits[first] >= PASSAGE:
                a, b = max(bounds[row[first]], hits[first] - AROUND), min(bounds[row[first] + 1], hits[i - 1] + SEED + AROUND)
                rows.append((row[first], hits[first] - bounds[row[first]], words[a:b].view(np.int64), seeds[hits[first:i]].view(np.int64)))
                first = i
        take = pa.array([r[0] for r in rows])
        lists = [pa.array([r[i] for r in rows], pa.list_(pa.int64())) for i in (2, 3)]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array([int(r[1]) for r in rows], pa.int64()), *lists], names)


def align(passages: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Best local alignment score of each item row with its passage row; cells below zero hold no word."""
    count, width = passages.shape
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    before = np.zeros((count, width + 1), np.int32)
    best = np.zeros(count, np.int32)
    for k in range(items.shape[1]):
        word = items[:, k : k + 1]
        same = (passages == word) & (word != 0)
        now = np.zeros_like(before)
        np.maximum(before[:, :-1] + np.where(same, MATCH, MISMATCH), before[:, 1:] + GAP, out=now[:, 1:])
        np.maximum(now, 0, out=now)
        # A gap along the passage costs by its length, so a running maximum finds its best start.
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        best = np.maximum(best, now.max(axis=1))
        before = now
    return best


def _padded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    ends = lists.offsets.to_numpy()
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), int(sizes.max(initial=1))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.values.to_numpy()[ends[0] : ends[-1]]
    return out, sizes


def _score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for first in range(0, whole.num_rows, 256):
            batch = whole.slice(first, 256)
            items, sizes = _padded(batch.column(4))
            # Only words that the passage has can match, so fewer than the share of the block's words can't reach it.
            present = [int(np.isin(i[:n], w.values.to_numpy()).sum()) for i, n, w in zip(items, sizes, batch.column(3), strict=True)]
            able = np.array(present) / sizes >= SHARE
            if not able.any():
                continue
            batch, items, sizes = batch.filter(pa.array(able)), items[able], sizes[able]
            words, _ = _padded(batch.column(3))
            share = align(words, items) / (MATCH * sizes)
            part = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(share)], ["text_hash", "item_id", "passage", "similarity"])
            yield part.filter(pa.array(share >= SHARE))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, passage) of each item found in each document: its best block and passage.

    ``passage`` is the index of the first seed word of the passage in the document.
    """
    spark = docs.sparkSession
    blocks = written(
        benchmark.select("item_id", "text").mapInArrow(_blocks, "item_id long, block long, item_words array<long>, seeds array<long>"), "benchmark-blocks"
    )
    seeds = blocks.select("item_id", "block", F.posexplode("seeds").alias("at", "seed"))
    known = spark.sparkContext.broadcast(_bitmap(seeds))
    chosen = written(seeds.select("item_id", "block", "seed").distinct(), "benchmark-seeds")
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    passages = written(
        hashed.mapInArrow(partial(_passages, bitmap=known), "doc_id long, text_hash long, passage long, words array<long>, seeds array<long>"), "seed-passages"
    )
    # Copies of a text are aligned once.
    key = ["text_hash", "passage"]
    texts = written(passages.groupBy(*key).agg(F.first("words").alias("words"), F.first("seeds").alias("seeds")), "seed-texts")
    met = texts.select(*key, F.explode("seeds").alias("seed")).join(chosen, "seed").select(*key, "item_id", "block").distinct()
    pairs = met.join(texts.select(*key, "words"), key).join(blocks.select("item_id", "block", "item_words"), ["item_id", "block"])
    scored = pairs.select("text_hash", "item_id", "passage", "words", "item_words").mapInArrow(_score, "text_hash long, item_id long, passage long, similarity double")
    best = scored.groupBy("text_hash", "item_id").agg(F.max(F.struct("similarity", F.expr("-passage AS p"))).alias("b"))
    holders = passages.select("doc_id", "text_hash").distinct()
    return holders.join(best, "text_hash").select("doc_id", "text_hash", "item_id", F.expr("b.similarity AS similarity"), F.expr("-b.p AS passage"))


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without benchmark items, with their columns."""
    found = leaks(docs, benchmark).select("doc_id", "text_hash").distinct().alias("l")
    return docs.alias("d").join(found, F.expr("d.doc_id <=> l.doc_id AND xxhash64(d.text) = l.text_hash"), "left_anti")
