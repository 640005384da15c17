"""Small corpora for the corpus operators, and plain Python versions of what they compute."""

from __future__ import annotations

import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, m string, node long, id long, mark int, kept string, label int"


def corpus(seed: int = 1, size: int = 120) -> list[tuple[int | None, str | None]]:
    """Texts with exact and near copies, shared passages, ties, nulls, empty and long ones."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage = text(40)
    docs: list[tuple[int | None, str | None]] = []
    for i in range(size):
        kind = rnd.random()
        if kind < 0.15 and docs:
            docs.append((i, rnd.choice(docs)[1]))
        elif kind < 0.35 and docs:
            old = (rnd.choice(docs)[1] or "a b").split(" ")
            for _ in range(max(1, len(old) // 40)):
                old[rnd.randrange(len(old))] = rnd.choice(words)
            docs.append((i, " ".join(old)))
        elif kind < 0.5:
            docs.append((i, f"{text(rnd.randint(0, 60))}\n{passage}\n{text(rnd.randint(0, 60))}"))
        else:
            docs.append((i, text(rnd.randint(1, 150))))
    docs += [(size, None), (size + 1, ""), (size + 2, " \n\t"), (size + 3, "Ab ab"), (size + 4, "aB AB"), (size + 5, text(6000)), (None, text(30)), (None, None)]
    docs += [docs[3], docs[3], (7, "another text under a used id " + text(40))]
    return docs


def frame(spark, docs):
    """With columns whose names the operators use inside."""
    rows = [(i, t, ["de", None, "en"][(i or 0) % 3], ["a", "b", None][(i or 0) % 3], 1, "m", 1, 1, 1, "k", 1) for i, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text: str | None) -> frozenset:
    own = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(text)]
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4)) or frozenset([tuple(own)] if own else [])


def components(docs) -> dict:
    """(doc_id, text) -> component by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    least = {}
    for own, (i, _) in zip(label, docs, strict=True):
        if i is not None:
            least[own] = min(least.get(own, i), i)
    return {d: (least.get(own) if sets[k] else d[0]) for k, (own, d) in enumerate(zip(label, docs, strict=True))}


def removal(docs, length: int = 100) -> dict:
    """(doc_id, text) -> (n_bytes, n_removed, n_spans, sha256, kept bytes)."""
    seen, found = set(), {}
    for i, t in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        raw = (t or "").encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                gone[k : k + length] = [True] * length
            else:
                seen.add(raw[k : k + length])
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        found[i, t] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return found
