"""Mixing against plain water-filling with fractions, and its sample against a walk through the draws."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

from amperline.llm import mixing
from tests.llm.small import corpus, frame, words

ORDER = lambda s: (s is None, s or "")


def targets(sizes, weights, cap=3):
    """Clamp, hand the excess on by weight, again until nothing is above its limit."""
    share = {s: Fraction(sum(sizes.values()) * weights[s], sum(weights.values()) or 1) for s in sizes}
    while True:
        over = {s for s in sizes if share[s] > cap * sizes[s]}
        if not over:
            return share
        excess = sum(share[s] - cap * sizes[s] for s in over)
        full = over | {s for s in sizes if share[s] == cap * sizes[s]}
        rest = sum(weights[s] for s in sizes if s not in full)
        share = {s: Fraction(cap * sizes[s]) if s in full else share[s] + excess * Fraction(weights[s], rest) for s in sizes}


def walk(docs, goal):
    """Counter of (doc_id, source, size, taken)."""
    by_source = defaultdict(list)
    for i, t, s in docs:
        draw = hashlib.md5(f"{mixing.SEED}:{'-' if i is None else i}:{t or ''}".encode()).hexdigest()
        by_source[s].append((draw, i, len(words(t))))
    out = Counter()
    for s, rows in by_source.items():
        total, left = sum(r[2] for r in rows), int(goal[s])
        whole = left // total if total else 0
        left -= whole * total
        for _, i, size in sorted(rows, key=lambda r: r[0]):
            part = min(left, size)
            left -= part
            out[i, s, size, whole * size + part] += 1
    return out


def rows_of(df):
    return Counter((r.doc_id, r.source, r.size, r.taken) for r in df.collect())


def check(spark, docs, weights=None):
    df = spark.createDataFrame([(*d, 1, 2, "w") for d in docs], "doc_id long, text string, source string, size long, tie int, weight string").repartition(4)
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len(words(t))
    turn = weights or {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(sizes, key=ORDER))}
    goal = targets(sizes, turn)
    given = spark.createDataFrame(list(turn.items()), "source string, weight long") if weights else None
    got = mixing.mixed(df, given).collect()
    assert all(r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) <= 1e-9 * max(1, r.target) for r in got)
    assert Counter((r.doc_id, r.source, r.size, r.taken) for r in got) == walk(docs, goal)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
    assert all(0 <= goal[s] - taken[s] < 1 for s in sizes)


def test_against_plain_python(spark):
    rnd = random.Random(9)
    docs = [(i, t, rnd.choice(["big"] * 6 + ["a", "b", "ü", None, "tiny"])) for i, t in corpus(6, 150)]
    docs += [(5000, "one two three", "smallest"), (5001, None, "empty"), (5002, "", "empty"), (5003, "x " * 20_000, "\U0001f600")]
    check(spark, docs)
    check(spark, docs, {s: {"big": 1, "tiny": 500}.get(s, 7) for _, _, s in docs})


def test_repeated_rows_are_taken_to_the_word(spark):
    """A third of all rows, and all of a source, is one row again and again; the cut lies within its copies."""
    check(spark, [(1, "just one row", "a")] * 90 + [(None, "b", "b")] * 100 + [(i, f"other text {i}", "c") for i in range(70)])


def test_reruns_agree_on_other_partitions(spark):
    df = frame(spark, corpus(7, 60))
    assert rows_of(mixing.mixed(df)) == rows_of(mixing.mixed(df.repartition(1)))
    assert rows_of(mixing.mixed(df)) != rows_of(mixing.mixed(df, seed=5))


def test_repetitions_hold_the_planned_words(spark):
    df = frame(spark, list({i: (i, t) for i, t in corpus(8, 60) if i is not None}.values()))
    plan = {r.doc_id: r.taken for r in mixing.mixed(df).collect()}
    texts = {r.doc_id: r.text for r in df.collect()}
    got = defaultdict(list)
    for r in mixing.repeated(df).collect():
        own, full = words(r.text), words(texts[r.doc_id])
        assert own == full[: len(own)]
        got[r.doc_id].append(own)
    assert {i: sum(map(len, t)) for i, t in got.items()} == {i: n for i, n in plan.items() if n}


def test_empty_table_and_texts(spark):
    df = frame(spark, [(1, "a")])
    assert mixing.mixed(df.limit(0)).count() == 0
    rows = mixing.mixed(frame(spark, [(1, None), (2, " ")])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_no_python_in_the_plan(spark):
    plan = mixing.mixed(frame(spark, corpus(4, 10)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
