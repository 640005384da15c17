"""Near-duplicate documents by MinHash with tensored banding.

A document is the set of its 5-word shingles.  Plain banding computes ``tables * k`` minima for its table keys.  Here two
small collections of ``HALVES`` half-keys, each of ``ROWS`` minima, are computed, and every pair of a half-key of the
first and one of the second collection is a table key: ``HALVES ** 2`` tables from ``2 * HALVES * ROWS`` minima, close to
the square root of the plain number.  For a similarity of 0.75 a pair meets in some table with probability
``(1 - (1 - 0.75 ** ROWS) ** HALVES) ** 2``, which is above 0.9999 here and nearer to 1 for more similar texts.

Copies collapse first: documents with equal sets are one node.  A half-key that only one node has can't meet anything, so
most nodes of a clean corpus never get a table key.  In each bucket of ``HALVES`` of the
tables all nodes are compared with its smallest node and not with one another.  Buckets of any table that still hold several
components then compare those nodes with the smallest one of another component, and with the components at both ends.  What is
still mixed after that is searched in squares of at most about ``SQUARE`` by ``SQUARE`` nodes and ``CELLS`` shingles a side.  There
bitmaps name the nodes that can have a similar one in another component, an exact prefix filter on their sets finds the
pairs to compare, and a square gives out the links that join two components: fewer rows than it reads.  All links
are confirmed on the full sets.  So two similar nodes that meet in any table are in one component.

Null and empty texts have no shingles and are linked with nothing.  Rows that repeat a doc_id with the same text share
its fate; different texts under one doc_id are told apart by their sets.  A null doc_id never names a component
that has another one.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.bytetext import mix, ranges
from amperline.llm.components import components
from amperline.llm.shingles import set_names, sets_of
from amperline.llm.store import written

HALVES = 12
ROWS = 2
PERCENT = 75
SQUARE = 4096
CELLS = 4_000_000
SKETCH_BITS = 1024

_SEEDS = np.random.Generator(np.random.PCG64(8)).integers(1, 1 << 63, 2 * HALVES * ROWS, dtype=np.uint64) | np.uint64(1)
_SHIFTS = np.random.Generator(np.random.PCG64(9)).integers(1, 1 << 63, 2 * HALVES * ROWS, dtype=np.uint64)


def half_keys(sets: list[np.ndarray]) -> np.ndarray:
    """For each non-empty set its half-keys: the first ``HALVES`` are of the first collection."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    first = np.cumsum(sizes) - sizes
    keys = np.zeros((len(sets), 2 * HALVES), np.uint64)
    for half in range(2 * HALVES):
        for row in range(ROWS):
            k = half * ROWS + row
            keys[:, half] = mix(keys[:, half] + np.minimum.reduceat(flat * _SEEDS[k] ^ _SHIFTS[k], first) + np.uint64(k))
    return keys


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, sets in sets_of(batches):
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        full = [s for s in sets if len(s)]
        keys = half_keys(full) if full else np.zeros((0, 2 * HALVES), np.uint64)
        offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, 2 * HALVES, 0))]).astype(np.int32)
        halves = pa.ListArray.from_arrays(pa.array(offsets), _signed(keys.ravel()))
        get = lambda name: batch.column(batch.schema.get_field_index(name))
        yield pa.RecordBatch.from_arrays(
            [get("doc_id"), get("text_hash"), pa.array(sizes), _signed(set_names(sets)), halves], ["doc_id", "text_hash", "n_shingles", "node", "halves"]
        )


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: size and name of its set, and its half-keys."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _sign, "doc_id long, text_hash long, n_shingles long, node long, halves array<long>"
    )


def table_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, diagonal): the table keys of each node whose two half-keys both occur elsewhere.

    The ``HALVES`` diagonal tables are those of the i-th half-keys of both collections.
    """
    halves = nodes.select("node", F.posexplode("halves").alias("slot", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    found = halves.join(shared, "half").groupBy("node").agg(F.collect_list(F.struct("slot", "half")).alias("h"))
    first = F.filter("h", lambda x: x.slot < HALVES)
    second = F.filter("h", lambda x: x.slot >= HALVES)
    return (
        found.select("node", F.explode(first).alias("one"), second.alias("h"))
        .select("node", "one", F.explode("h").alias("two"))
        .select(F.xxhash64("one.half", "two.half").alias("key"), "node", (F.col("two.slot") - F.col("one.slot") == HALVES).alias("diagonal"))
    )


def _both(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, sets in sets_of(batches):
        values = np.concatenate([*sets, np.zeros(0, np.uint64)])
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, sets), np.int64, len(sets)))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([_signed(set_names(sets)), pa.ListArray.from_arrays(pa.array(offsets), _signed(values))], ["node", "shingles"])


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted (node, doc, text_hash), read again from the texts."""
    key = [F.coalesce("doc_id", F.lit(-1)).alias("k1"), F.xxhash64("text").alias("k2")]
    asked = wanted.select(F.coalesce("doc", F.lit(-1)).alias("k1"), F.col("text_hash").alias("k2"))
    # Repeated rows go in the stage of the join, whose keys they share.
    chosen = docs.select("text", *key).join(asked, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("text")
    return chosen.mapInArrow(_both, "node long, shingles array<long>")


def _confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = batch.column(2), batch.column(3)
        a, b = one.offsets.to_numpy(), two.offsets.to_numpy()
        # In unsigned order the sets are sorted.
        x, y = one.values.to_numpy().view(np.uint64), two.values.to_numpy().view(np.uint64)
        linked = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            s, t = x[a[i] : a[i + 1]], y[b[i] : b[i + 1]]
            if len(s) > len(t):
                s, t = t, s
            at = np.searchsorted(t, s)
            common = int((t[np.minimum(at, len(t) - 1)] == s).sum()) if len(t) else 0
            linked[i] = common > 0 and 100 * common >= PERCENT * (len(s) + len(t) - common)
        yield batch.filter(pa.array(linked)).select([0, 1])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar.  A node with very many partners is split by the join's skew handling."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("two"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(_confirm, "a long, b long")


def _similar_sizes(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    size = lambda node, name: nodes.select(F.col("node").alias(node), F.col("n_shingles").alias(name))
    return pairs.join(size("a", "x"), "a").join(size("b", "y"), "b").where(f"100 * least(x, y) >= {PERCENT} * greatest(x, y)").select("a", "b")


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bitmap of each set."""
    for batch in batches:
        lists = batch.column(1)
        ends = lists.offsets.to_numpy()
        cells = (mix(lists.values.to_numpy().view(np.uint64)[ends[0] : ends[-1]]) % np.uint64(SKETCH_BITS)).astype(np.int64)
        for first in range(0, batch.num_rows, SQUARE):
            part = batch.slice(first, SQUARE)
            sizes = np.diff(ends[first : first + part.num_rows + 1])
            bits = np.zeros((part.num_rows, SKETCH_BITS), bool)
            bits[np.repeat(np.arange(part.num_rows), sizes), cells[ends[first] - ends[0] : ends[first + part.num_rows] - ends[0]]] = True
            packed = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes.astype(np.int64)), pa.array([p.tobytes() for p in packed], pa.binary())], ["node", "size", "sketch"])


def _squares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each square; they come sorted by (key, low, high), those of one side before those of the other."""
    waiting: list[pa.RecordBatch] = []
    name: tuple | None = None
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if a == b:
                continue
            if tuple(keys[a]) != name:
                if waiting:
                    yield pa.Table.from_batches(waiting).combine_chunks()
                waiting, name = [], tuple(keys[a])
            waiting.append(batch.slice(a, b - a))
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _partners(rows: pa.Table) -> list[int]:
    """For each node of the first side the place from which on its partners stand."""
    low, high, side = (rows.column(k).to_numpy() for k in range(1, 4))
    count = int((side == low).sum())
    return list(range(1, count + 1)) if low[0] == high[0] else [count] * count


def _able(i: int, first: int, labels: np.ndarray, sizes: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """The nodes from ``first`` on that are of another component than node ``i``, if sizes and bitmaps allow a link."""
    j = first + np.flatnonzero(labels[first:] != labels[i])
    j = j[100 * np.minimum(sizes[j], sizes[i]) >= PERCENT * np.maximum(sizes[j], sizes[i])]
    # A cell that only one set has holds a shingle that the other lacks.
    common = np.minimum(
        sizes[i] - np.bitwise_count(sketches[i] & ~sketches[j]).sum(axis=1, dtype=np.int64), sizes[j] - np.bitwise_count(sketches[j] & ~sketches[i]).sum(axis=1, dtype=np.int64)
    )
    return j[100 * common >= PERCENT * (sizes[i] + sizes[j] - common)]


def _hopeful(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each square that have a partner with which sizes and bitmaps allow a link."""
    for rows in _squares(batches):
        labels, sizes = (rows.column(k).to_numpy() for k in (5, 6))
        sketches = np.frombuffer(b"".join(rows.column(7).to_pylist()), np.uint64).reshape(len(labels), -1)
        hopeful = np.zeros(len(labels), bool)
        for i, first in enumerate(_partners(rows)):
            j = _able(i, first, labels, sizes, sketches)
            hopeful[j] = True
            hopeful[i] |= len(j) > 0
        yield from rows.filter(pa.array(hopeful)).select([0, 4, 5, 6]).to_batches()


def _joining(rows: pa.Table) -> tuple[list[int], list[int]]:
    """Confirmed links of a square that join two components, at most one less than its nodes.

    In an order of shingles from rare to frequent, two similar sets share one of the first ``|s| - ceil(0.75 |s|) + 1`` of
    each; only partners found in this way are compared, on their full sets.
    """
    nodes, comp = rows.column(4).to_numpy(), rows.column(5).to_numpy().copy()
    lists = rows.column(7).combine_chunks()
    ends = lists.offsets.to_numpy()
    start, sizes = (ends[:-1] - ends[0]).astype(np.int64), np.diff(ends).astype(np.int64)
    _, codes, counts = np.unique(lists.values.to_numpy()[ends[0] : ends[-1]], return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    owner = np.repeat(np.arange(len(nodes)), sizes)
    codes = rank[codes]
    codes = codes[np.lexsort((codes, owner))]
    counts = np.sort(counts)
    head = sizes - -(-PERCENT * sizes // 100) + 1
    rare = np.flatnonzero((np.arange(len(codes)) - start[owner] < head[owner]) & (counts[codes] > 1))
    own = np.searchsorted(owner[rare], np.arange(len(nodes) + 1))
    by_code = rare[np.argsort(codes[rare], kind="stable")]
    holders, first = owner[by_code], np.searchsorted(codes[by_code], np.arange(len(counts) + 1))
    mark = np.zeros(len(counts), bool)
    one, two = [], []
    for i, partner in enumerate(_partners(rows)):
        mine = codes[rare[own[i] : own[i + 1]]]
        found = np.unique(holders[ranges(first[mine], first[mine + 1] - first[mine])])
        found = found[(found >= partner) & (comp[found] != comp[i])]
        found = found[100 * np.minimum(sizes[found], sizes[i]) >= PERCENT * np.maximum(sizes[found], sizes[i])]
        if not len(found):
            continue
        mark[codes[start[i] : start[i] + sizes[i]]] = True
        # Partners in groups of bounded total size; those that a link has joined meanwhile go.
        groups = np.cumsum(sizes[found]) // CELLS
        for group in np.split(found, np.flatnonzero(np.diff(groups)) + 1):
            j = group[comp[group] != comp[i]]
            if not len(j):
                continue
            common = np.add.reduceat(mark[codes[ranges(start[j], sizes[j])]], np.cumsum(sizes[j]) - sizes[j], dtype=np.int64)
            for k in j[100 * common >= PERCENT * (sizes[i] + sizes[j] - common)].tolist():
                if comp[k] != comp[i]:
                    comp[comp == comp[k]] = comp[i]
                    one.append(nodes[i])
                    two.append(nodes[k])
        mark[codes[start[i] : start[i] + sizes[i]]] = False
    return one, two


def _across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _squares(batches):
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _joining(rows)], ["a", "b"])


def _in_squares(members: DataFrame, sides: DataFrame) -> DataFrame:
    """Each member of a bucket once for each side of it; ``sides`` names the number ``n`` of sides of each bucket."""
    sided = members.join(sides, "key").withColumn("side", F.pmod(F.xxhash64("node"), "n"))
    spread = sided.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return spread.select("key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node", "label")


def _sorted_squares(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "side")


def links_across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components that share a bucket of ``members`` (key, node, label), enough of them to join what is similar.

    Tables whose buckets hold the same nodes count once.  A first pass over bitmaps leaves the nodes that can have a partner,
    so that only these bring their sets.
    """
    mixed = members.groupBy("key").agg(
        F.min("label").alias("first"), F.max("label").alias("last"), F.count("*").alias("n"), F.sum(F.col("node").cast("decimal(20,0)")).alias("total"), F.bit_xor(F.xxhash64("node")).alias("name")
    )
    mixed = mixed.where("first < last AND n > 2").groupBy("n", "total", "name").agg(F.min("key").alias("key"))
    sides = mixed.select("key", F.expr(f"(n + {SQUARE - 1}) DIV {SQUARE}").alias("n"))
    sketches = written(sets.mapInArrow(_sketches, "node long, size long, sketch binary"), "near-sketches")
    spread = _in_squares(members, sides).join(sketches, "node").select("key", "low", "high", "side", "node", "label", "size", "sketch")
    hopeful = _sorted_squares(spread).mapInArrow(_hopeful, "key long, node long, label long, size long")
    hopeful = written(hopeful.distinct(), "near-hopeful")
    sides = hopeful.groupBy("key").agg(F.expr(f"greatest((count(*) + {SQUARE - 1}) DIV {SQUARE}, (sum(size) + {CELLS - 1}) DIV {CELLS})").alias("n"))
    spread = _in_squares(hopeful, sides).join(sets, "node").select("key", "low", "high", "side", "node", "label", F.size("shingles").cast("long").alias("size"), "shingles")
    return written(_sorted_squares(spread).mapInArrow(_across, "a long, b long").distinct(), "near-links")


def grouped(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_shingles, component_id, kept."""
    rows = written(signatures(docs), "near-signatures")
    nodes = written(
        rows.where("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("least_id"), F.min(F.struct(F.col("doc_id").alias("doc"), "text_hash")).alias("at"), F.first("n_shingles").alias("n_shingles"), F.first("halves").alias("halves")),
        "near-nodes",
    )
    keys = table_keys(nodes)
    ends = keys.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = written(keys.join(ends, "key"), "near-buckets")
    stars = met.where("diagonal").select(F.col("low").alias("a"), F.col("node").alias("b")).where("a < b").distinct()
    stars = written(_similar_sizes(stars, nodes), "near-pairs")
    busy = met.select("node").distinct().join(nodes, "node").select("at.doc", "at.text_hash")
    sets = written(full_sets(docs, busy), "near-sets")
    links = written(confirmed(stars, sets), "near-links")
    labels = components(links)

    # Buckets that still hold several components: compare their smallest node, and the components at both ends, with the rest.
    labelled = met.select("key", "node", "low").join(labels, "node", "left").select("key", "node", "low", F.coalesce("label", "node").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.max(F.when(F.col("node") == F.col("low"), F.col("label"))).alias("its"))
    across = labelled.join(mixed.where("first < last"), "key")
    pair = lambda other, label: F.when(F.col("label") != F.col(label), F.struct(F.least("node", other).alias("a"), F.greatest("node", other).alias("b")))
    more = across.select(F.explode(F.array(pair("low", "its"), pair("first", "first"), pair("last", "last"))).alias("p")).where("p IS NOT NULL")
    more = more.select("p.*").distinct().join(stars, ["a", "b"], "left_anti")
    more = written(_similar_sizes(more, nodes), "near-pairs")
    found = written(confirmed(more, sets), "near-links")
    if not found.isEmpty():
        links = links.union(found)
        labels = components(links)

    # What is still mixed: links between the components that are left.
    labelled = met.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    found = links_across(labelled, sets)
    if not found.isEmpty():
        labels = components(links.union(found))

    named = nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "least_id")
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    groups = named.join(least, "label").select("node", "component_id")
    return (
        rows.drop("halves")
        .join(groups, "node", "left")
        .select("doc_id", "text_hash", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.expr("doc_id <=> component_id"))
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each group, with its columns."""
    gone = grouped(docs).where("NOT kept").select("doc_id", "text_hash").distinct().alias("g")
    return docs.alias("d").join(gone, F.expr("d.doc_id <=> g.doc_id AND xxhash64(d.text) = g.text_hash"), "left_anti")
