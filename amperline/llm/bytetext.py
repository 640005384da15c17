"""Whole texts as byte arrays: words, hashes and chunks for the numpy code inside tasks.

Texts of an Arrow batch are laid end to end in one ``uint8`` array.  Words are maximal runs of bytes
other than ASCII white space (0x09-0x0D, 0x20); as those bytes never occur inside a multi-byte UTF-8
sequence, this equals the words ``[^\\x20\\x09-\\x0D]+`` of the decoded text.  A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CODES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_CODES_LOWER = _CODES[LOWER]
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

CHUNK_BYTES = 1 << 21


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and the offset of each text (one more than there are texts)."""
    array = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    if buffers[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks at the first and the last bytes of the maximal runs of ``inside`` that don't cross an offset."""
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(inside))]
    begin[cuts] = inside[cuts]
    end[cuts - 1] = inside[cuts - 1]
    return begin, end


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` that don't cross an offset."""
    begin, end = edges(inside, offsets)
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def powers(size: int, kind: str = "up") -> np.ndarray:
    """Powers 0 .. size of the hash's base, or of its inverse modulo 2**64."""
    if len(_powers[kind]) <= size:
        steps = np.full(max(size + 1, 1 << 16), _BASE if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind]


def prefix(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Running polynomial hash: entry i covers the bytes before i."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_CODES_LOWER if lower else _CODES)[data] * powers(len(data))[: len(data)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, equal for equal bytes at any place."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums), "down")[starts])


def mix(values: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (a bijection)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of all ranges start .. start + length - 1, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    steps = np.ones(total, np.int64)
    full = np.flatnonzero(lengths)
    first = np.cumsum(lengths[full]) - lengths[full]
    begins = starts[full].astype(np.int64)
    steps[first] = begins
    steps[first[1:]] -= begins[:-1] + lengths[full][:-1] - 1
    return np.cumsum(steps)
