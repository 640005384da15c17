"""Spelling variants: words that are one edit apart, found by asymmetric q-chunks, and the form each word goes back to.

Of two words that differ by one edit the one that is not longer is cut into two disjoint chunks.  One edit spares one of
them, so the other word holds that chunk as a gram, and at a place shifted by at most one: the first chunk at the same
place, the second one shifted by the difference of the lengths.  The join runs on chunk, place and length; links are
verified by the edit distance.

A join key names all of a word but a stretch, its *rest*.  Where more than ``CROWD`` rows share a key, the same rule goes on
within the rest: it is cut into two chunks, of which one edit spares one.  So crowded keys are divided until they are small,
or their rest is one code point, and then its alphabet bounds them.  No pair of a key is left out.

Defined results: a null text has no words, an empty one neither; a null doc_id is written as the empty string where words are drawn for
damage; repeated rows count again; of near words with the same count the smallest is the form; an empty table gives no
rows; further columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.bytetext import chunks
from amperline.llm.store import written

MIN_LENGTH = 5
MIN_COUNT = 3
DAMAGE_MOD = 97
FORM_FACTOR = 2
CROWD = 32
# A task hands on its counts when it holds so many words.
FLUSH_WORDS = 500_000
# Words are runs of A-Z, a-z and U+00C0 - U+00FF: one byte each in Latin-1.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> Counter[bytes]:
    """Lower-cased words of a text in Latin-1, and how often each occurs."""
    return Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())


def damaged(name: str, own: Counter[bytes]) -> Iterator[tuple[bytes, int]]:
    """The words as they are counted: those the document's name draws have lost one code point."""
    start = crc32(f"{name}:".encode())
    for word, n in own.items():
        h = crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % DAMAGE_MOD == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in totals]), pa.array(list(totals.values()), pa.int64())], ["word", "n"])

    totals: Counter[bytes] = Counter()
    for batch in chunks(batches):
        for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for word, n in damaged(name or "", runs(text or "")):
                if len(word) >= MIN_LENGTH:
                    totals[word] += n
        if len(totals) > FLUSH_WORDS:
            yield out()
            totals.clear()
    yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences; stored."""
    partial = docs.select(F.col("doc_id").cast("string").alias("name"), "text").mapInArrow(_counted, "word string, n long")
    return written(partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT), "vocabulary")


def _divided(rows: DataFrame) -> DataFrame:
    """Cut each rest into two chunks; a new key keeps one of them and leaves the other as the rest."""
    half = "(lo + hi + 1) DIV 2"
    either = F.expr(f"explode(array(struct({half} AS lo, hi AS hi), struct(lo AS lo, {half} AS hi)))")
    new = rows.select("word", "n", "longer", either.alias("at")).select("word", "n", "longer", "at.lo", "at.hi")
    size = F.char_length("word") - F.col("longer")
    before, after = F.expr("substring(word, 1, lo)"), F.expr("substring(word, hi + longer + 1)")
    return new.withColumn("key", F.xxhash64(size, "lo", "hi", before, after))


# Pairs of one key: the chunk side is not longer, and equal lengths are taken once.
_LINKS = """
flatten(transform(filter(members, s -> s.longer = 0),
  s -> transform(filter(members, t -> (t.longer = 1 OR t.word > s.word) AND levenshtein(s.word, t.word, 1) = 1),
                 t -> struct(s.word AS a, s.n AS a_n, t.word AS b, t.n AS b_n))))"""


def links(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: every two words of ``words(word, n)`` that are one edit apart, once."""
    size = F.char_length("word").cast("int")
    sides = F.explode(F.array(F.lit(0), F.lit(1)))
    rows = words.select("word", "n", sides.alias("longer")).select("word", "n", "longer", F.lit(0).alias("lo"), (size - F.col("longer")).alias("hi"))
    found = []
    while True:
        rows = written(_divided(rows.where("hi > lo")), "chunks")
        keys = rows.groupBy("key").agg(F.count("*").alias("rows"), F.min("longer").alias("least"), F.max(F.col("hi") - F.col("lo")).alias("rest"))
        crowded = written(keys.where(f"rows > {CROWD} AND rest > 1").select("key", "least"), "crowded")
        near = rows.join(crowded, "key", "left_anti").groupBy("key").agg(F.collect_list(F.struct("longer", "word", "n")).alias("members"))
        found.append(written(near.where("size(members) > 1").select(F.inline(F.expr(_LINKS))), "links"))
        # A key without a chunk side has no pairs.
        crowded = crowded.where("least = 0")
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()
        rows = rows.join(crowded, "key", "left_semi").drop("key")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: counts at least double from a word to its form, so chains are short and have an end; each round halves them."""
    jumps = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(jumps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        jumps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return jumps


def variants(docs: DataFrame) -> DataFrame:
    """Per word ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of the largest count where that is at least ``FORM_FACTOR`` times the word's own.
    """
    words = vocabulary(docs)
    one = links(words)
    both = one.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    both = both.union(one.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    told = words.join(best, "word", "left").withColumn("is_form", -F.col("best.order") >= FORM_FACTOR * F.col("n"))
    told = written(
        told.select(
            "word",
            F.when(F.col("is_form"), F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("is_form"), -F.col("best.order")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
