import random

import numpy as np
import pyarrow as pa

from amperline.llm import near_dedup
from amperline.llm.components import components
from tests.llm import small


def test_components_against_all_pairs(spark):
    for seed in (1, 5):
        docs = small.corpus(seed)
        rows = near_dedup.grouped(small.frame(spark, docs)).collect()
        want = small.components(docs)
        sizes = sorted((str(i), len(small.shingles(t)), str(want[i, t])) for i, t in docs)
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == sizes
        assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_keep_first(spark):
    docs = small.corpus(6)
    df = small.frame(spark, docs)
    kept = near_dedup.keep_first(df)
    want = small.components(docs)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in docs if want[i, t] == i)


def test_empty_table(spark):
    df = small.frame(spark, [(1, "a")]).limit(0)
    assert near_dedup.grouped(df).count() == 0
    assert near_dedup.keep_first(df).count() == 0


def test_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    found = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_crowded_buckets_against_all_pairs(spark, monkeypatch):
    """Hundreds of members around one template, nearly all at 0.65 to 0.80 to one another, in squares of a few nodes, too."""
    rnd = random.Random(4)
    template = [f"w{i}" for i in range(240)]

    def member(i):
        own = list(template)
        for k in rnd.sample(range(0, 240, 5), 5):
            own[k] = f"x{i}y{k}"
        return " ".join(own)

    docs = [(i, member(i)) for i in range(360)]
    want = small.components(docs)
    assert len(set(want.values())) > 20
    for square in (near_dedup.SQUARE, 50):
        monkeypatch.setattr(near_dedup, "SQUARE", square)
        rows = near_dedup.grouped(small.frame(spark, docs)).collect()
        assert {r.doc_id: r.component_id for r in rows} == {i: c for (i, _), c in want.items()}


def test_bitmaps_keep_every_similar_pair():
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 1 << 63, rnd.integers(1, 2500), dtype=np.uint64)) for _ in range(60)]
    sets += [np.unique(np.concatenate([s[: len(s) - len(s) // k], rnd.integers(0, 1 << 63, len(s) // 12, dtype=np.uint64)])) for s in sets for k in (6, 9)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets))), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "shingles"])
    (found,) = near_dedup._sketches([batch])
    nodes = found.column(0).to_numpy()
    bits = np.frombuffer(b"".join(found.column(2).to_pylist()), np.uint64).reshape(len(nodes), -1)
    kept = {(i, j) for i in range(len(nodes)) for j in near_dedup._able(i, i + 1, nodes, found.column(1).to_numpy(), bits).tolist()}
    similar = set()
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                similar.add((i, j))
    assert len(similar) > 50 and similar <= kept and len(kept) < len(sets) ** 2 // 4


def test_joining_links_against_all_pairs(monkeypatch):
    """One row of squares at a time: the links join what all pairs join, and are fewer than the nodes."""
    rnd = np.random.default_rng(7)
    base = [rnd.integers(0, 1 << 62, 120) for _ in range(12)]
    sets = [np.unique(np.where(rnd.random(120) < rnd.choice([0.02, 0.1, 0.2]), rnd.integers(0, 1 << 62, 120), base[k % 12])) for k in range(200)]
    sets += [np.unique(rnd.integers(0, 1 << 62, n)) for n in (1, 1, 2, 5000)] + [sets[3][:1], sets[3][:1]]
    count = len(sets)

    def joined(links):
        comp = list(range(count))
        for a, b in links:
            comp = [comp[a] if c == comp[b] else c for c in comp]
        return comp

    def similar(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)

    def rows(low, high, sides, nodes):
        lists = pa.array([sets[n] for n in nodes], pa.list_(pa.int64()))
        column = lambda v: pa.array([v] * len(nodes), pa.int64())
        names = ["key", "low", "high", "side", "node", "label", "size", "shingles"]
        size = pa.array([len(sets[n]) for n in nodes], pa.int64())
        return pa.RecordBatch.from_arrays([column(1), column(low), column(high), pa.array(sides), pa.array(nodes), pa.array(nodes), size, lists], names)

    for cells in (near_dedup.CELLS, 300):
        monkeypatch.setattr(near_dedup, "CELLS", cells)
        for first in (range(count), range(count // 2)):
            first = list(first)
            second = [n for n in range(count) if n not in set(first)]
            square = rows(0, int(bool(second)), [0] * len(first) + [1] * len(second), first + second)
            (found,) = near_dedup._across([square.slice(0, 70), square.slice(70)])
            links = list(zip(*(c.to_pylist() for c in found.columns), strict=True))
            assert len(links) < count and all(similar(a, b) for a, b in links)
            want = [(i, j) for i in first for j in second or first if i != j and similar(i, j)]
            assert len(want) > 200
            a, b = joined(links), joined(want)
            assert len(set(a)) == len(set(b)) == len(set(zip(a, b, strict=True)))
