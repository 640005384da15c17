"""Remove repeated passages: each byte covered by a ``LENGTH``-byte string that also starts earlier in the corpus.

Suffix arrays find the repeats, but one suffix array of a corpus can't be spread over tasks.  So the text is cut down to
what can repeat, and brought together so that equal strings meet.

1. Every ``LENGTH``-byte string has an anchor: of its ``ANCHOR``-byte substrings the one with the smallest hash.  Equal
   strings have equal anchors at the same distance from their start.  Strings of near distances also share the bytes
   around the anchor that each of them must hold: with distances ``low`` to ``high``, the ``low`` bytes before the anchor and
   as many after it as the string at distance ``high`` holds.  A *run* is a maximal series of neighbouring strings with one
   anchor and distances in one half of all possible ones; those bytes are its *key*.  Strings that are equal lie in runs of
   equal keys, so runs whose key occurs once in the corpus go.
2. Runs with the same text become one *context* with its earliest place, by a minimum that is combined before the shuffle: a
   passage in a third of all documents is one row per task.  Later copies of a run are removed as a whole.
3. The contexts of a key form a block.  Its suffix order (``suffix_order``, linear grouping construction) brings equal
   strings next to each other; all but the earliest are removed.
4. Contexts of a key that has more than ``BLOCK`` of them are halved again, by distance, and steps 2 and 3 are done on the
   halves with their longer keys.  A half gives one row for each of its contexts at most, what has become equal collapses, and
   after six halvings a key is a whole string; no block is larger than ``BLOCK``, and no string is listed for itself before.

Texts are UTF-8 bytes; null texts are empty.  Rows are in order of doc_id, null after all others, and places in a text; rows
with the same doc_id and text are one place and keep the same bytes, and different texts under one doc_id are
told apart by their 64-bit hash (``mark``), in the order after the place.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.bytetext import CHUNK_BYTES, chunks, flat, mix, powers, prefix, range_hashes, ranges, spans
from amperline.llm.store import written
from amperline.llm.suffix_order import suffix_order

LENGTH = 100
ANCHOR = 32
BLOCK = 128
FAR = LENGTH - ANCHOR
HALF = (FAR + 1) // 2  # distances of the anchor are 0 .. HALF - 1 or HALF .. FAR

# A place is packed as start and number of strings (7 bits).  Places are in order of doc_id, place and mark.
_LAST_ID = (1 << 63) - 1


def _anchor_hashes(sums: np.ndarray) -> np.ndarray:
    """Hashes of all ``ANCHOR``-byte strings, from running hashes."""
    return mix((sums[ANCHOR:] - sums[:-ANCHOR]) * powers(len(sums), "down")[: max(len(sums) - ANCHOR, 0)])


def _runs_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Starts, numbers of strings, keys, text hashes and first distances to the anchor of all runs."""
    low = np.uint64((1 << 28) - 1)
    width = FAR + 1
    for first in range(0, max(len(data) - LENGTH + 1, 0), CHUNK_BYTES):
        part = data[first : first + CHUNK_BYTES + LENGTH - 1]
        count = len(part) - LENGTH + 1
        sums = prefix(part)
        hashes = _anchor_hashes(sums)
        # The position in the low bits makes the leftmost of equal hashes the smallest.
        keyed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        padded = np.concatenate([keyed, np.full(-len(keyed) % width, ~np.uint64(0))]).reshape(-1, width)
        left = np.minimum.accumulate(padded, axis=1).ravel()
        right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        anchors = (np.minimum(right[:count], left[width - 1 : width - 1 + count]) & low).astype(np.int64)
        inside = np.ones(count, bool)
        for edge in offsets[(offsets > first) & (offsets < first + len(part))] - first:
            inside[max(0, edge - LENGTH + 1) : edge] = False
        far = anchors - np.arange(count) >= HALF
        starts, ends = spans(inside, np.flatnonzero((np.diff(anchors) != 0) | (far[1:] != far[:-1])) + 1)
        anchor, is_far = anchors[starts], far[starts]
        keys = range_hashes(sums, np.where(is_far, anchor - HALF, anchor), np.where(is_far, anchor + ANCHOR, anchor + LENGTH - HALF + 1))
        yield starts + first, ends - starts, keys, range_hashes(sums, starts, ends + LENGTH - 1), anchor - starts


def _runs(batches: Iterable[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        data, offsets = flat(batch.column(2))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        marks = batch.column(1).to_numpy(zero_copy_only=False)
        for starts, sizes, keys, texts, at in _runs_of(data, offsets):
            key = pa.array(keys.view(np.int64))
            if not whole:
                yield pa.RecordBatch.from_arrays([key], ["key"])
                continue
            row = np.searchsorted(offsets, starts, "right") - 1
            place = (starts - offsets[row]) << 7 | sizes
            yield pa.RecordBatch.from_arrays([key, *(pa.array(x) for x in (texts.view(np.int64), ids[row], place, marks[row], at))], ["key", "context", "id", "place", "mark", "at"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(_LAST_ID)).alias("id"), F.xxhash64("text").alias("mark"), "text")


def _cut_contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each asked context."""
    for batch in chunks(batches):
        data, offsets = flat(batch.column(2))
        asked = batch.column(3)
        row = np.repeat(np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy()))
        flat_asked = asked.flatten()
        place = flat_asked.field("place").to_numpy()
        starts = offsets[row] + (place >> 7)
        ends = starts + (place & 127) + LENGTH - 1
        raw = data.tobytes()
        texts = pa.array([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())
        ids, marks = (batch.column(k).take(pa.array(row)) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([*(flat_asked.field(k) for k in ("key", "n", "at", "place")), ids, marks, texts], ["key", "n", "at", "place", "id", "mark", "bytes"])


Context = tuple[int, int, int, int, int, int, bytes]  # low, high, at, id, place, mark, bytes


def _can_repeat(contexts: Iterable[Context]) -> list[Context]:
    """Contexts of one key that may share a string: a half of their distances has bytes in common with another one."""
    cores = []
    for low, high, at, _, place, _, raw in contexts:
        middle = (low + high) // 2
        # Distances go down from ``at``, one for each string.
        cores.append([(a, raw[at - a : at - b + LENGTH]) for a, b in ((low, middle), (middle + 1, high)) if a <= at and b > at - (place & 127)])
    seen = Counter(c for own in cores for c in own)
    return [c for c, own in zip(contexts, cores, strict=True) if any(seen[x] > 1 for x in own)]


def _block(contexts: list[Context]) -> Iterator[tuple[int, int, int]]:
    """Strings of the contexts that start earlier in the block: (id, place, mark)."""
    text: list[int] = []
    owner: list[int] = []
    bounds = []
    for k, (*_, place, _, raw) in enumerate(contexts):
        bounds.append(len(text))
        text += [b + 2 for b in raw]
        text.append(1)
        owner += [k] * (place & 127) + [-1] * (len(raw) + 1 - (place & 127))
    text.append(0)
    owner.append(-1)
    later: dict[int, list[int]] = {}
    alike: list[tuple[int, int, int, int, int]] = []
    before = b""

    def close() -> None:
        first = min(alike)
        for *_, k, offset in alike:
            if (k, offset) != first[3:]:
                later.setdefault(k, []).append(offset)

    for start in suffix_order(text):
        k = owner[start]
        if k < 0:
            continue
        *_, doc, place, mark, raw = contexts[k]
        offset = start - bounds[k]
        string = raw[offset : offset + LENGTH]
        if string != before:
            if alike:
                close()
            before, alike = string, []
        alike.append((doc, (place >> 7) + offset, mark, k, offset))
    if alike:
        close()
    for k, offsets in later.items():
        offsets.sort()
        *_, doc, place, mark, _ = contexts[k]
        run = offsets[0]
        for here, following in zip(offsets, [*offsets[1:], None], strict=True):
            if following != here + 1:
                yield doc, (place & ~127) + (run << 7) + here - run + 1, mark
                run = following


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come sorted by key."""
    key, contexts, rows = None, {}, []

    def solved() -> Iterator[tuple[int, int, int]]:
        whole = _can_repeat(contexts.values())
        return _block(whole) if len(whole) > 1 else iter(())

    def pack() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["id", "place", "mark"])

    for batch in batches:
        for own, *context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                rows += solved()
                key, contexts = own, {}
            contexts[tuple(context[3:6])] = tuple(context)  # repeated rows give a place twice
        if len(rows) > 50_000:
            yield pack()
            rows = []
    rows += solved()
    if rows:
        yield pack()


PLACE = ["id", "place", "mark"]


def _halves(contexts: DataFrame) -> DataFrame:
    """The strings of each context in two parts, by their distances, with the keys of these parts."""
    middle = "CAST((low + high) DIV 2 AS INT)"
    sides = f"inline(array(named_struct('from', low, 'to', {middle}), named_struct('from', {middle} + 1, 'to', high)))"
    parts = contexts.selectExpr("key", "at", *PLACE, "bytes", sides)
    parts = parts.selectExpr("*", "greatest(0, at - to) AS skip", "least((place & 127) - 1, at - `from`) AS last").where("skip <= last")
    parts = parts.selectExpr("*", f"substring(bytes, skip + 1, CAST(last - skip AS INT) + {LENGTH}) AS text", f"substring(bytes, at - `from` + 1, {LENGTH} - to + `from`) AS core")
    return parts.selectExpr(
        "xxhash64(key, `from`, core) AS key", "xxhash64(text) AS context", "at - skip AS at", "`from` AS low", "to AS high",
        "id", "(shiftright(place, 7) + skip) * 128 + last - skip + 1 AS place", "mark", "text AS bytes",
    )


def _firsts(parts: DataFrame, *more: str) -> DataFrame:
    """The earliest place of each text of a key."""
    return written(parts.groupBy("key", "context").agg(F.min(F.struct(*PLACE, *more)).alias("first")).select("key", "first.*"), "repeat-firsts")


def _several(firsts: DataFrame) -> DataFrame:
    return firsts.groupBy("key").agg(F.count("*").cast("int").alias("n")).where("n > 1")


def repeats(docs: DataFrame) -> DataFrame:
    """(id, mark, part): a place, the number of halvings it comes from (3 bits) and its kind (2 bits).

    Kind 0 are runs or parts of them that occur elsewhere, 1 those that are the first of their text, 2 repeats.  A part may be
    the whole of its run and repeat a part of a longer one, so kinds 0 and 1 belong together within one halving only.
    """
    keyed = _keyed(docs)
    shared = keyed.mapInArrow(partial(_runs, whole=False), "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    # Stored, so that both sides of the join come from plain shuffles and Spark can split hot keys.
    shared = written(shared, "repeat-keys")
    runs = keyed.mapInArrow(partial(_runs, whole=True), "key long, context long, id long, place long, mark long, at long")
    found = written(runs.join(shared, "key"), "repeat-runs")
    firsts = _firsts(found, "at")
    asked = firsts.join(written(_several(firsts), "repeat-keys"), "key").groupBy("id", "mark")
    asked = asked.agg(F.collect_list(F.struct("key", "n", F.col("at").cast("int").alias("at"), "place")).alias("asked"))
    contexts = keyed.join(asked, PLACE[::2]).select("id", "mark", "text", "asked").mapInArrow(_cut_contexts, "key long, n int, at int, place long, id long, mark long, bytes binary")
    far = f"at >= {HALF}"
    contexts = written(contexts.selectExpr("*", f"IF({far}, {HALF}, 0) AS low", f"IF({far}, {FAR}, {HALF - 1}) AS high"), "repeat-contexts")

    kinds, blocks = [(found, 0), (firsts, 1)], [contexts.where(f"n <= {BLOCK}")]
    while not (crowded := contexts.where(f"n > {BLOCK}")).isEmpty():
        halves = written(_halves(crowded), "repeat-halves")
        firsts = _firsts(halves, "at", "low", "high", "bytes")
        contexts = written(firsts.join(written(_several(firsts), "repeat-keys"), "key"), "repeat-contexts")
        kinds += [(halves, len(blocks) * 4), (firsts, len(blocks) * 4 + 1)]
        blocks.append(contexts.where(f"n <= {BLOCK}"))
    columns = ["key", "low", "high", "at", *PLACE, "bytes"]
    block = reduce(DataFrame.union, [b.select(columns) for b in blocks]).repartition("key").sortWithinPartitions("key")
    kinds.append((written(block.mapInArrow(_blocks, "id long, place long, mark long"), "repeat-blocks"), 2))
    return reduce(DataFrame.union, [k.select("id", "mark", F.expr(f"shiftleft(place, 5) | {code}").alias("part")) for k, code in kinds])


def _covered(size: int, parts: np.ndarray) -> np.ndarray:
    """Which bytes of a text are removed."""
    kind, run = parts & 3, parts >> 2
    gone = np.concatenate([np.setdiff1d(run[kind == 0], run[kind == 1]), run[kind == 2]]) >> 3
    steps = np.zeros(size + 1, np.int64)
    starts = gone >> 7
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + (gone & 127) + LENGTH - 1, size), -1)
    return np.cumsum(steps[:-1]) > 0


def _removed(batches: Iterable[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        data, offsets = flat(batch.column(batch.schema.get_field_index("text")))
        lists = batch.column(batch.schema.get_field_index("parts"))
        out: list[tuple] = []
        for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            raw, gone, n_spans = data[a:b], 0, 0
            if lists[row].is_valid:
                cover = _covered(b - a, lists[row].values.to_numpy())
                gone, n_spans = int(cover.sum()), len(spans(cover, np.zeros(1, np.int64))[0])
                raw = raw[~cover]
            out.append((b - a, gone, n_spans, raw.tobytes()))
        counts = [pa.array([o[i] for o in out], pa.int64()) for i in range(3)]
        if texts:
            # Cuts may fall inside a character: what is left of it can't be decoded and goes too.
            texts_before = batch.column(batch.schema.get_field_index("text"))
            kept = pa.array([o[3].decode("utf-8", "ignore") if o[1] else texts_before[i].as_py() for i, o in enumerate(out)], pa.string())
        else:
            kept = pa.array([hashlib.sha256(o[3]).hexdigest() for o in out], pa.string())
        first = "rest" if texts else "doc_id"
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(first)), *counts, kept], [first, "n_bytes", "n_removed", "n_spans", "kept"])


def _with_parts(docs: DataFrame) -> DataFrame:
    parts = repeats(docs).groupBy("id", "mark").agg(F.collect_list("part").alias("parts"))
    on = F.expr(f"coalesce(d.doc_id, {_LAST_ID}) = p.id AND xxhash64(d.text) = p.mark")
    return docs.alias("d").join(parts.alias("p"), on, "left").select("d.*", "p.parts")


def removal(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept string"
    return _with_parts(docs.select("doc_id", "text")).mapInArrow(partial(_removed, texts=False), schema).withColumnRenamed("kept", "kept_sha256")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of the texts; documents of which only white space is left go."""
    # The other columns travel as one struct, so that their names can't clash.
    rest = F.struct(*(F.col(c) for c in docs.columns if c != "text")).alias("rest")
    plain = docs.select("doc_id", "text", rest)
    kind = plain.schema["rest"].dataType.simpleString()
    cut = _with_parts(plain).mapInArrow(partial(_removed, texts=True), f"rest {kind}, n_bytes long, n_removed long, n_spans long, kept string")
    left = cut.where(r"n_removed = 0 OR kept RLIKE '[^\\x20\\x09-\\x0D]'")
    return left.select(*(F.col("kept").alias("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns))
