"""The manifest against plain Python, and its climb on hot trees."""

import hashlib
import random
import zlib

from amperline.llm import manifest
from tests.llm.small import corpus


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    out = ""
    for k, v in enumerate(row):
        v = None if v is None else str(v)
        if lower and k == 4 and v is not None:
            v = "".join(c.lower() if "A" <= c <= "Z" else c for c in v)
        out += "-" if v is None else f"{len(v.encode())}:{v}"
    return sha(out)


def proofs(level):
    """Root of a list of digests, and each one's runs of siblings: [(left, right), ...]."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, path in enumerate(paths):
            run, p = at[k] // 8 * 8, at[k]
            path.append((level[run:p], level[p + 1 : run + 8]))
            at[k] = p // 8
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], paths


def audited(rows):
    """rows of (doc_id, source, lang, n_chars, text) -> sorted result tuples."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = [sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs]
    done = [proofs([leaf(r) for r in tree]) for tree in trees]
    root, tops = proofs([d[0] for d in done]) if done else ("", [])
    out = []
    for tree, (subroot, paths), top in zip(trees, done, tops, strict=True):
        for row, path in zip(tree, paths, strict=True):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            own = fold = leaf(row, hit)
            for left, right in path + top:
                fold = sha("".join([*left, fold, *right]))
            proof = sha("".join("".join(a + b) for a, b in path + top))
            out.append((str(row[0]), leaf(row), subroot, root, proof, fold, fold == root))
            assert hit or own == leaf(row)
    return sorted(out)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, id long, n int, tree string, digest string, parent string"


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, 2, "t", "d", "p") for r in rows], SCHEMA).repartition(3)
    got = manifest.audited(frame)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((str(r.doc_id), *r[1:]) for r in got.collect()) == audited(rows)


def test_against_plain_python(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["a", None, "ü"]), rnd.choice(["de", None, "en", "", "ß"]), rnd.choice([None, len(t or "")]), rnd.choice([t, (t or "").title()])) for i, t in corpus(5, 150)]
    rows += [rows[3], rows[3], (4000, "a", "lone", 1, "A lone leaf"), (4001, None, "퟿", None, None)]
    check(spark, rows)


def test_sizes_around_whole_runs(spark):
    for sizes in ([1], [9], [65, 8, 1], [1] * 9):
        rows = [(100 * k + i, "s", f"l{k}", 3, f"Text {i}") for k, n in enumerate(sizes) for i in range(n)]
        check(spark, rows)


def test_hot_nodes_are_copied(spark, monkeypatch):
    """With three runs to a copy, nodes with many runs below them are met in several copies; results stay."""
    monkeypatch.setattr(manifest, "RUNS_PER_COPY", 3)
    check(spark, [(i, "s", "en" if i % 50 else None, i, f"T{i}") for i in range(700)])


def test_long_text_and_null_rows(spark):
    check(spark, [(3, None, None, None, "Ab é " * 400_000), (6, None, None, None, None), (None, None, None, None, None), (None, None, None, None, None)])


def test_empty_table(spark):
    assert manifest.audited(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nodes_name_their_parents(spark):
    rows = [(i, "s", "en" if i % 3 else "de", i, f"T{i}", "x", 1, 2, "t", "d", "p") for i in range(200)]
    nodes, runs = manifest.built(spark.createDataFrame(rows, SCHEMA))
    got = {r.id: r for r in nodes.collect()}
    assert sum(r.parent is None for r in got.values()) == 1 and all(r.parent in got for r in got.values() if r.parent)
    for r in got.values():
        if r.parent:
            assert bytes(got[r.parent].children)[32 * r.place : 32 * r.place + 32] == bytes(r.digest)
    assert sum(len(r.members) for r in runs.collect()) == 200
