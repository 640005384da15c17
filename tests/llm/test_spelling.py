"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from amperline.llm import spelling
from tests.llm.small import corpus, frame


def counts(docs):
    total = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if n >= 3 and len(w) >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def edited(rnd, word, letters):
    k = rnd.randrange(len(word))
    return rnd.choice([word[:k] + word[k + 1 :], word[:k] + rnd.choice(letters) + word[k:], word[:k] + rnd.choice(letters) + word[k + 1 :]])


def texts(seed, letters, size=260):
    """Words, edits of them, edits of edits, with very different counts."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(5, 11))) for _ in range(40)]
    for _ in range(size):
        words.append(edited(rnd, rnd.choice(words), letters))
    bag = [w for w in words if w for _ in range(rnd.choice([1, 2, 3, 4, 9, 20, 45, 100]))]
    rnd.shuffle(bag)
    return [(k, " ".join(bag[i : i + 50]).title() if k % 3 else ", ".join(bag[i : i + 50])) for k, i in enumerate(range(0, len(bag), 50))]


@pytest.mark.parametrize("letters", ["abé", "abcdefghÿÀ"])
@pytest.mark.parametrize("crowd", [2, 32])
def test_against_all_pairs(spark, monkeypatch, letters, crowd):
    """Few letters and a small crowd make every key crowded, down to rests of one code point."""
    monkeypatch.setattr(spelling, "CROWD", crowd)
    docs = texts(len(letters), letters)
    assert len(counts(docs)) > 100
    assert got(spelling.variants(frame(spark, docs))) == expected(counts(docs))


def test_crowded_words_of_one_template(spark):
    """Hundreds of words that share their first half, many pairwise near."""
    rnd = random.Random(3)
    words = {"aaaaaaaa" + "".join(rnd.choice("bc") for _ in range(k)) for k in (4, 5, 6, 7, 8) for _ in range(120)}
    docs = [(k, f"{w} " * rnd.randint(3, 30)) for k, w in enumerate(sorted(words))]
    assert got(spelling.variants(frame(spark, docs))) == expected(counts(docs))


def test_nulls_empty_repeated_and_long(spark):
    docs = corpus(4, 60) + [(None, "Straße straße STRAßE strasse naïve×naïve÷ Ābcdefā abc中defgh" * 3)] * 2
    docs += [(70_000, "longest" + "x" * 5000 + " " + "longest" + "x" * 5001), (70_001, "colour color colours " * 30_000)] * 3
    assert got(spelling.variants(frame(spark, docs))) == expected(counts(docs))


def test_chain_of_forms(spark):
    """Each word doubles the one before: one root, many steps away."""
    word, docs = "aaaaaa", []
    for k in range(11):
        docs.append((k, f"{word} " * (3 * 2**k)))
        word = word[:k % 6] + "b" + word[k % 6 + 1 :] if k < 6 else word + "c"
    result = got(spelling.variants(frame(spark, docs)))
    assert result == expected(counts(docs)) and any(r[2] not in (r[0], r[1]) for r in result)


def test_empty_table(spark):
    assert spelling.variants(frame(spark, [(1, "a")]).limit(0)).count() == 0
