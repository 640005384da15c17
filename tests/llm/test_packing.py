import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from amperline.llm import packing
from amperline.llm.tokens import BatchTokenizer, tokenizer_path
from tests.llm import small

TEXTS = [
    "a\x0bb", "dog's. don't!'re ≠ <|endoftext|>x <|ENDOFTEXT|> İSTANBUL ΣΣ a.́ x 12ab,3 | a|b", None, "", "  ",
    "—.a—b '. .'s a.'s", "é, É.", "x\x1cy\x85z", "Élève µßª", "x" * 5000, "日本語 مرحبا",
]


def test_ids_equal_those_of_the_tokenizer():
    tokenizer = BatchTokenizer(tokenizer_path())
    texts = TEXTS + [t for _, t in small.corpus(1)]
    for _ in range(2):  # the second time from memory
        ids, offsets = tokenizer.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == tokenizer.tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.integers(1, 30), min_size=1, max_size=9), st.integers(30, 40))
@settings(max_examples=200, deadline=None)
def test_best_multiset_against_all_subsets(lengths, window):
    counts = {x: lengths.count(x) for x in lengths}
    used = packing.best_multiset(sorted(counts, reverse=True), counts, window)
    assert used[max(lengths)] >= 1 and all(0 < n <= counts[x] for x, n in used.items())
    rest = sorted(lengths)[:-1]
    best = max(sum(s) for k in range(len(rest) + 1) for s in combinations(rest, k) if sum(s) <= window - max(lengths))
    assert sum(x * n for x, n in used.items()) == max(lengths) + best


@given(st.lists(st.integers(1, 700), max_size=60))
@settings(max_examples=100, deadline=None)
def test_pieces_cover_each_document_once(sizes):
    held, filled = defaultdict(int), defaultdict(int)
    for document, start, length, sequence, offset in packing._pieces(np.array(sizes, np.int64), 256):
        assert start == held[document] and length > 0 and offset == filled[sequence]
        held[document] += length
        filled[sequence] += length
    assert [held[i] for i in range(len(sizes))] == sizes and max(filled.values(), default=0) <= 256


def test_packed_pieces(spark):
    docs = small.corpus(2)
    tokenizer = BatchTokenizer(tokenizer_path()).tokenizer
    ids = {(i, t): [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in docs}
    rows = packing.packed(small.frame(spark, docs)).collect()
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for (i, t), own in ids.items():
        if sum(d[0] == i for d in docs) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r.start):
                part = np.array(own[r.start : r.start + r.length], "<u4")
                assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part.tobytes()), len(own))
                at += r.length
            assert at == len(own)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    total = sum(r.length for r in rows)
    assert total == sum(len(ids[d]) for d in docs) and padding <= 0.02 * total


def test_empty_table(spark):
    assert packing.packed(small.frame(spark, [(1, "a")]).limit(0)).count() == 0
