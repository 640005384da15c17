import pyarrow as pa

from amperline.llm import token_counts as t
from amperline.llm.tokens import tokenizer_path
from tests.llm import small


def test_counts_against_one_word_at_a_time(spark):
    counter = t.TrieCounter(tokenizer_path(t.NAME))
    docs = small.corpus(1) + [(500, "x" * 300 + " y\x00 y \x00"), (501, "日本語 " * 3), (502, "na nat nation national nationals nat")]
    want = sorted(
        (str(i), len(small.words(x)), sum(t.count_alone(t.MARK + w.encode(), counter.pieces, counter.sizes[-1], counter.fallback) for w in small.words(x))) for i, x in docs
    )
    rows = t.token_counts(small.frame(spark, docs)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in rows) == want
    counter.count(pa.array(["a b"]))
    assert counter.count(pa.array([], pa.string()))[0].tolist() == []


def test_best_segmentation_against_all():
    pieces = {b"a": -2.0, b"b": -2.0, b"ab": -3.0, b"ba": -1.0, b"aba": -4.5}

    def every(word):
        if not word:
            return [(0.0, 0)]
        return [(pieces.get(word[:k], -9.0) + s, n + 1) for k in range(1, len(word) + 1) if k == 1 or word[:k] in pieces for s, n in every(word[k:])]

    for word in (b"a", b"abab", b"ababa", b"bxab", b"aabbaab"):
        best = max(s for s, _ in every(word))
        assert t.count_alone(word, pieces, 3, -9.0) == min(n for s, n in every(word) if s > best - 1e-9)


def test_empty_table(spark):
    assert t.token_counts(small.frame(spark, [(1, "a")]).limit(0)).count() == 0
