"""Word shingles of whole texts as sets of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from amperline.llm.bytetext import WHITE, chunks, flat, mix, prefix, range_hashes, spans

SHINGLE_WORDS = 5
_PLACES = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, given the words' hashes."""
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * _PLACES[k]
    return mix(total + np.uint64(size))


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, lower-cased A-Z; a shorter text is one shingle, one without words has none."""
    data, offsets = flat(texts)
    starts, ends = spans(~WHITE[data], offsets)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * (len(offsets) - 1)
    words = range_hashes(prefix(data, lower=True), starts, ends)
    every = shingle_hashes(words, size) if len(words) >= size else np.zeros(0, np.uint64)
    bounds = np.searchsorted(starts, offsets).tolist()
    found = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            found.append(np.unique(every[a : b - size + 1]))
        else:
            found.append(shingle_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return found


def sets_of(batches: Iterable[pa.RecordBatch], size: int = SHINGLE_WORDS) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in chunks(batches):
        yield batch, shingle_sets(batch.column(batch.schema.get_field_index("text")), size)


def set_names(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit name of each set; equal for equal sets."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    names = np.zeros(len(sets), np.uint64)
    full = sizes > 0
    if full.any():
        flat_sets = np.concatenate(sets)
        first = (np.cumsum(sizes) - sizes)[full]
        names[full] = mix(np.add.reduceat(mix(flat_sets), first) + mix(np.bitwise_xor.reduceat(flat_sets, first)) + sizes[full].astype(np.uint64))
    return names
