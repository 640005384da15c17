import random

import numpy as np

from amperline.llm import decontamination as d
from tests.llm.small import frame


def plain_score(passage, item):
    rows = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, w in enumerate(item, 1):
        for j, p in enumerate(passage, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (d.MATCH if w == p else d.MISMATCH), rows[i - 1][j] + d.GAP, rows[i][j - 1] + d.GAP)
    return max(map(max, rows))


def test_alignment_against_the_full_table():
    rnd = random.Random(1)
    for _ in range(20):
        passages = np.array([[rnd.randint(1, 6) for _ in range(30)] for _ in range(8)])
        items = np.array([[rnd.randint(1, 6) for _ in range(12)] for _ in range(8)])
        assert d.align(passages, items).tolist() == [plain_score(p, i) for p, i in zip(passages.tolist(), items.tolist(), strict=True)]


def test_copies_and_edited_copies_are_found(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(800)]
    common = ["the", "of", "and", "in"]
    text = lambda n: [rnd.choice(common) if rnd.random() < 0.4 else rnd.choice(words) for _ in range(n)]
    items = [(i, text(rnd.randint(15, 60))) for i in range(20)] + [(20, text(300)), (21, ["the", "of"]), (22, [])]
    docs, want = [], set()
    for i in range(150):
        own = text(rnd.randint(30, 300))
        if i % 3 == 0:
            k, item = items[i // 3 % 21]
            copy = list(item if k != 20 else item[40:200])
            if i % 2:
                for _ in range(len(copy) // 8):
                    copy[rnd.randrange(len(copy))] = rnd.choice(words)
                del copy[len(copy) // 2]
            own[10:10] = [w.upper() + "," if i % 4 == 0 else w for w in copy]
            want.add((i, k))
        docs.append((i, " ".join(own)))
    docs += [docs[0], (900, docs[3][1]), (901, None), (902, ""), (None, docs[6][1])]
    want |= {(900, k) for i, k in want if i == 3} | {(None, k) for i, k in want if i == 6}
    benchmark = spark.createDataFrame([(i, " ".join(t), 1) for i, t in items] + [(23, None, 1), (0, " ".join(items[0][1]), 1)], "item_id long, text string, block int")
    rows = d.leaks(frame(spark, docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
    assert all(d.SHARE <= r.similarity <= 1 for r in rows)
    df = frame(spark, docs)
    kept = d.drop_leaked(df, benchmark)
    assert kept.columns == df.columns
    leaked = {i for i, _ in want}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in leaked)


def test_a_leak_in_most_documents_keeps_its_seeds(spark):
    item = " ".join(f"word{i}" for i in range(30))
    docs = [(i, f"start {i} {item} end") for i in range(300)] + [(1000, "word1 word2 nothing else")]
    rows = d.leaks(frame(spark, docs), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(300))


def test_empty_tables(spark):
    docs, items = frame(spark, [(1, "a b c d")]), spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert d.leaks(docs.limit(0), items).count() == 0
    assert d.leaks(docs, items.limit(0)).count() == 0
    assert d.drop_leaked(docs, items.limit(0)).count() == 1


def plain_similarity(document, item):
    """The best share of a block's score among blocks that have a seed in common with the document."""
    seeds = lambda words: {tuple(words[i : i + d.SEED]) for i in range(len(words) - d.SEED + 1)}
    firsts = {max(0, min(f, len(item) - d.BLOCK)) for f in range(0, max(1, len(item) - d.BLOCK + d.STEP), d.STEP)}
    blocks = [item[f : f + d.BLOCK] for f in firsts]
    return max((plain_score(document, b) / (d.MATCH * len(b)) for b in blocks if seeds(b) & seeds(document)), default=0)


def test_heavily_edited_copies_against_all_alignments(spark):
    """Replaced and inserted words, spaced evenly or at random, with and without an exact copy in the corpus."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(3000)]
    text = lambda n: [rnd.choice(words) for _ in range(n)]
    items = {i: text(rnd.choice([20, 40, 64, 110])) for i in range(24)}
    docs = []
    for i, item in items.items():
        spaced = [w if k % 4 != i % 4 else rnd.choice(words) for k, w in enumerate(item)]
        copies = [spaced, [w if rnd.random() < 0.7 else rnd.choice(words) for w in item], [w if rnd.random() < 0.85 else rnd.choice(words) for w in item]]
        copies.append([x for k, w in enumerate(item) for x in ([rnd.choice(words), w] if k > 3 and k % 2 == 0 else [w])])
        if i % 2:
            copies.append(item)
        docs += [(100 * i + k, text(30) + copy + text(30)) for k, copy in enumerate(copies)]
    want = {(n, i): plain_similarity(t, item) for n, t in docs for i, item in items.items() if len(set(t) & set(item)) > 5}
    want = {k: v for k, v in want.items() if v >= d.SHARE}
    assert len(want) > 80
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    rows = d.leaks(frame(spark, [(n, " ".join(t)) for n, t in docs]), benchmark).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in rows} == want
