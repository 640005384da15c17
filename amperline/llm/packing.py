"""Pack documents into training sequences by minimum bin slack.

Each document becomes token ids plus an end id.  A document longer than a window fills whole windows of its own; the
rest of it is an item.  Items are packed by minimum bin slack: for one window after the other, a subset-sum dynamic
programme over the lengths that remain finds the multiset whose sum comes closest to the window.  The programme's
sets of reachable sums are bitsets (Python integers), one per length, and walking back through them gives how
often each length is used.  A multiset is taken as often as the remaining counts allow, so the number of programmes
follows the number of distinct multisets and not of windows.

Packing needs no shuffle: a task packs its rows in blocks of about ``BLOCK_TOKENS`` ids, with thousands of items to
choose from.  A window that stays clearly short (usually only the last ones of a block) is cut at powers of two,
which need no padding.  Memory per task is bounded by a block, besides the longest document.

Null texts are empty: such a document is its end id.  Repeated rows are packed once each.  Sequence ids are unique in
one run; a recomputed task packs the same rows in the same way.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from amperline.llm.tokens import END_ID, BatchTokenizer, tokenizer_path

WINDOW = 2048
BLOCK_TOKENS = 4_000_000
#: A window that lacks at most this part of itself is padded; a worse one is cut at powers of two.
SPARE = 64
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def best_multiset(lengths: list[int], counts: dict[int, int], window: int) -> dict[int, int]:
    """The longest remaining length and the multiset of others that together come closest to ``window``: length -> times.

    ``lengths`` go from the longest to the shortest.  The longest is set first, as in the published heuristic, so that
    hard items don't stay to the end.  Binary splitting of a count keeps the bitset steps logarithmic in it.
    """
    longest, room = lengths[0], window - lengths[0]
    reach, steps = 1, []
    for length in lengths[bisect_left(lengths, -room, key=lambda x: -x) :]:
        most = min(counts[length] - (length == longest), room // length)
        part = 1
        while most > 0:
            times = min(part, most)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & ((2 << room) - 1)
            most -= times
            part *= 2
        if reach >> room & 1:
            break
    rest = reach.bit_length() - 1
    used = {longest: 1}
    for length, times, before in reversed(steps):
        if not before >> rest & 1:
            used[length] = used.get(length, 0) + times
            rest -= length * times
    return used


def minimum_slack(lengths: Iterable[int], window: int = WINDOW) -> list[list[int]]:
    """Bins of item numbers, each chosen with the least slack among the items that remain."""
    stacks: dict[int, list[int]] = defaultdict(list)
    for item, length in enumerate(lengths):
        stacks[length].append(item)
    bins: list[list[int]] = []
    order = sorted(stacks, reverse=True)
    counts = {length: len(stack) for length, stack in stacks.items()}
    while order:
        used = best_multiset(order, counts, window)
        for _ in range(min(counts[length] // times for length, times in used.items())):
            bins.append([stacks[length].pop() for length, times in used.items() for _ in range(times)])
            for length, times in used.items():
                counts[length] -= times
        order = [length for length in order if counts[length]]
    return bins


def _pieces(sizes: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of the documents of a block; sequences count from 0."""
    pieces, items, sequence = [], [], 0
    for document, size in enumerate(sizes.tolist()):
        for start in range(0, size - size % window, window):
            pieces.append((document, start, window, sequence, 0))
            sequence += 1
        if size % window:
            items.append((document, size - size % window, size % window))
    for chosen in minimum_slack([length for _, _, length in items], window):
        left = sum(items[i][2] for i in chosen)
        target = left if window - left <= window // SPARE else 1 << (left.bit_length() - 1)
        offset = 0
        for document, start, length in (items[i] for i in chosen):
            while length:
                take = min(length, target - offset)
                pieces.append((document, start, take, sequence, offset))
                start, length, offset, left = start + take, length - take, offset + take, left - take
                if offset == target:
                    sequence, offset = sequence + 1, 0
                    target = 1 << (left.bit_length() - 1) if left else 0
    return pieces


def _pack_block(doc_ids: list, rows: list[np.ndarray], first: int, window: int) -> tuple[pa.RecordBatch, int]:
    sizes = np.array([len(ids) for ids in rows], np.int64)
    columns: list[list] = [[] for _ in range(7)]
    last = -1
    for document, start, length, sequence, offset in _pieces(sizes, window):
        ids = rows[document][start : start + length]
        values = (doc_ids[document], start, length, zlib.crc32(ids.astype("<u4").tobytes()), len(rows[document]), first + sequence, offset)
        for column, value in zip(columns, values, strict=True):
            column.append(value)
        last = sequence
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names), last + 1


def _pack(batches: Iterable[pa.RecordBatch], path: str, window: int) -> Iterator[pa.RecordBatch]:
    tokenizer = BatchTokenizer(path)
    sequence = TaskContext.get().partitionId() << 40
    doc_ids, rows, held = [], [], 0
    for batch, ids, offsets in tokenizer.tokenized(batches):
        doc_ids += batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            rows.append(np.append(ids[a:b], np.uint16(END_ID)))
            held += b - a + 1
        if held >= BLOCK_TOKENS:
            packed, n = _pack_block(doc_ids, rows, sequence, window)
            yield packed
            sequence, doc_ids, rows, held = sequence + n, [], [], 0
    if rows:
        yield _pack_block(doc_ids, rows, sequence, window)[0]


def packed(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence."""
    return docs.select("doc_id", "text").mapInArrow(partial(_pack, path=path or tokenizer_path(), window=window), SCHEMA)
