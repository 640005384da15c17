import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from amperline.llm import suffix_dedup
from amperline.llm.suffix_order import suffix_order
from tests.llm import small


@given(st.lists(st.integers(1, 4), max_size=60))
@settings(max_examples=300, deadline=None)
def test_suffix_order(values):
    text = [*values, 0]
    assert suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("seed", [1, 7])
def test_removal_against_a_set_of_strings(spark, seed):
    docs = small.corpus(seed)
    want = small.removal(docs)
    rows = suffix_dedup.removal(small.frame(spark, docs)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == sorted((str(i), *want[i, t][:4]) for i, t in docs)


def test_one_anchor_in_many_contexts(spark):
    """A passage between ever other words: its edges fill several blocks of one anchor."""
    core = " ".join(f"word{i}" for i in range(30))
    docs = [(i, f"{'xyz'[i % 3] * 60}{i % 7} {core} {'uvw'[i % 3] * 60}{i}") for i in range(150)]
    want = small.removal(docs)
    rows = suffix_dedup.removal(small.frame(spark, docs)).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans) for r in rows) == sorted((i, *want[i, t][1:3]) for i, t in docs)


def test_crowded_keys_are_halved_to_single_strings(spark):
    """More than a block of different contexts agree in 99 bytes around an anchor: only halving down to strings tells them apart."""
    rnd = random.Random(5)
    line = "".join(rnd.choice("abcdefghij ") for _ in range(99))
    docs = [(i, chr(200 + i) + line + chr(900 + i // 3) + "-" * (i % 5)) for i in range(400)]
    docs += [(1000 + i, chr(200 + i % 7) * 40 + line[:90] + chr(1200 + i)) for i in range(300)]
    want = small.removal(docs)
    rows = suffix_dedup.removal(small.frame(spark, docs)).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == sorted((i, *want[i, t][1:4]) for i, t in docs)
    assert sum(r.n_removed > 0 for r in rows) > 400


def test_a_text_over_a_chunk(spark, monkeypatch):
    """Runs at the edges of chunks, of windows of the text and of texts."""
    from amperline.llm import bytetext

    for size in (257, 1000, 4099):
        monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", size)
        for seed in (1, 2):
            rnd = random.Random(seed)
            text = "".join(rnd.choice("abc é") for _ in range(3000))
            data = bytetext.flat(pa.array([text[:700], text, "", text[500:900], "x"]))
            got = sorted((int(s), int(n), int(a)) for starts, sizes, *_, at in suffix_dedup._runs_of(*data) for s, n, a in zip(starts, sizes, at, strict=True))
            raw, edges = data[0].tobytes(), data[1].tolist()
            strings = [k for a, b in zip(edges, edges[1:], strict=False) for k in range(a, b - 99)]
            assert [k for s, n, _ in got for k in range(s, s + n)] == strings
            anchor = {}
            for s, n, a in got:
                assert (a >= suffix_dedup.HALF) == (a - n + 1 >= suffix_dedup.HALF)
                for k in range(s, s + n):
                    assert anchor.setdefault(raw[k : k + 100], s + a - k) == s + a - k


def test_a_long_text_with_repeats(spark):
    """5 MB of text, in which passages return beyond the edge of a chunk."""
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(5000)]
    text = " ".join(rnd.choice(words) for _ in range(750_000))
    passage = text[1_000_000:1_000_400]
    docs = [(1, text), (2, "<" + passage + ">"), (3, text[suffix_dedup.CHUNK_BYTES - 300 : suffix_dedup.CHUNK_BYTES + 300])]
    rows = {r.doc_id: r for r in suffix_dedup.removal(small.frame(spark, docs)).collect()}
    assert (rows[1].n_removed, rows[2].n_removed, rows[2].n_spans, rows[3].n_removed) == (0, 400, 1, 600)


def test_cut_repeats(spark):
    docs = small.corpus(9)
    df = small.frame(spark, docs)
    cut = suffix_dedup.cut_repeats(df)
    assert cut.columns == df.columns
    want = small.removal(docs)
    kept = [(i, t if not want[i, t][1] else want[i, t][4].decode("utf-8", "ignore")) for i, t in docs]
    kept = [(str(i), str(t)) for (i, t), d in zip(kept, docs, strict=True) if not want[d][1] or small.words(t)]
    assert sorted((str(r.doc_id), str(r.text)) for r in cut.collect()) == sorted(kept)


def test_empty_table(spark):
    df = small.frame(spark, [(1, "a")]).limit(0)
    assert suffix_dedup.removal(df).count() == 0
    assert suffix_dedup.cut_repeats(df).count() == 0


def test_thousands_of_texts_under_null_and_one_id(spark):
    """A text loses the passage it shares with an earlier doc_id, a few chance letters beside it at most, and else nothing."""
    rnd = random.Random(3)
    text = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(n))
    passages = [text(20) for _ in range(8)]
    docs = [(i, p) for i, p in enumerate(passages)]
    for i in range(3000):
        for own in (None, 50):
            docs.append((own, f"{text(2 + i % 7)} {passages[i % 8]} {text(20)}" if i % 2 else text(25)))
    rows = suffix_dedup.cut_repeats(small.frame(spark, docs)).select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    whole, cut = Counter(t for i, t in docs if i in (None, 50) and not any(p in t for p in passages)), Counter(r.text for r in rows)
    assert all(cut[t] == n for t, n in whole.items())
    for _, t in docs[8:]:
        for p in passages:
            if p in t:
                before, after = t.split(p)
                assert any(cut[before[: len(before) - a] + after[b:]] for a in range(8) for b in range(8))
