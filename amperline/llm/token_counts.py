"""Token counts under a unigram model, with one dynamic programme over the trie of distinct pre-tokens.

A pre-token is a word with the word mark before it; its segmentation is the one with the highest sum of piece scores, and
among equal ones the one with the fewest pieces.  Forward scores depend on the prefix only, so pre-tokens that share a prefix
share its scores.  The trie is the sorted list of distinct pre-tokens with the lengths of their common prefixes:
a node is computed in the first row that has it, all nodes of a depth at once, and copied to the rows below.  The count of
pieces at a pre-token's last node is its token count, kept in a table of the task.

Scores: the vocabulary is in order of frequency, and a piece of rank r gets ``-log(r + 2)`` (Zipf's law).  A byte that no piece
covers is a token of its own with ``FALLBACK`` below the lowest score.

Null texts have no tokens.  Pre-tokens of more than ``LONG`` bytes share little and are solved one by one, in memory that
follows their length.  Repeated rows give repeated rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from amperline.llm.bytetext import WHITE, chunks, flat, prefix, range_hashes, spans
from amperline.llm.tokens import tokenizer_path

MARK = "▁".encode()
NAME = "piece_bpe_32k.model"
FALLBACK = 10.0
LONG = 61
WIDTH = len(MARK) + LONG
MEMORY = 2_000_000
#: Scores are sums of different parts; differences below this are ties.
TIE = 1e-9


def vocabulary(path: str) -> dict[bytes, float]:
    """Piece -> score."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {model.id_to_piece(i).encode(): -float(np.log(rank + 2)) for rank, i in enumerate(plain)}


def count_alone(word: bytes, pieces: dict[bytes, float], longest: int, fallback: float) -> int:
    """Pieces of the best segmentation of one pre-token."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        score, count = best[end - 1][0] + pieces.get(word[end - 1 : end], fallback), best[end - 1][1] + 1
        for size in range(2, min(end, longest) + 1):
            piece = pieces.get(word[end - size : end])
            if piece is not None:
                before, n = best[end - size]
                if before + piece > score + TIE or (before + piece > score - TIE and n + 1 < count):
                    score, count = before + piece, n + 1
        best.append((score, count))
    return best[-1][1]


class TrieCounter:
    def __init__(self, path: str) -> None:
        self.pieces = vocabulary(path)
        self.fallback = min(self.pieces.values()) - FALLBACK
        self.sizes = sorted({len(p) for p in self.pieces})
        joined = np.frombuffer(b"".join(self.pieces), np.uint8)
        ends = np.cumsum([len(p) for p in self.pieces])
        hashes = range_hashes(prefix(joined), ends - [len(p) for p in self.pieces], ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.scores = np.fromiter(self.pieces.values(), np.float64)[order]
        self._empty()

    def _empty(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int32)

    def trie_counts(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Counts of distinct pre-tokens: rows of ``WIDTH`` bytes in any order, and their lengths."""
        order = np.argsort(words.view(f"S{WIDTH}").ravel(), kind="stable")
        words, lengths = words[order], lengths[order]
        rows = len(words)
        differs = words[1:] != words[:-1]
        common = np.where(differs.any(axis=1), differs.argmax(axis=1), WIDTH)
        common = np.concatenate([[-1], np.minimum(common, np.minimum(lengths[1:], lengths[:-1]))])
        sums = prefix(words.ravel())
        score = np.full((rows, WIDTH + 1), 0.0)
        count = np.zeros((rows, WIDTH + 1), np.int32)
        numbers = np.arange(rows)
        for depth in range(1, int(lengths.max()) + 1):
            new = (common < depth) & (lengths >= depth)
            at = numbers[new]
            if not len(at):
                continue
            ends = at * WIDTH + depth
            best = score[at, depth - 1] + self.fallback
            fewest = count[at, depth - 1] + 1
            for size in self.sizes:
                if size > depth:
                    break
                found = range_hashes(sums, ends - size, ends)
                place = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
                known = self.hashes[place] == found
                total = score[at, depth - size] + self.scores[place]
                n = count[at, depth - size] + 1
                better = known & ((total > best + TIE) | ((total > best - TIE) & (n < fewest)))
                best, fewest = np.where(better, total, best), np.where(better, n, fewest)
            score[at, depth], count[at, depth] = best, fewest
            first = np.maximum.accumulate(np.where(new, numbers, 0))
            shared = (common >= depth) & (lengths >= depth)
            score[shared, depth], count[shared, depth] = score[first[shared], depth], count[first[shared], depth]
        out = np.zeros(rows, np.int32)
        out[order] = count[numbers, lengths]
        return out

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        sizes = ends - starts
        counts = np.zeros(len(keys), np.int32)
        short = np.flatnonzero(sizes <= LONG)
        for first in range(0, len(short), 50_000):
            part = short[first : first + 50_000]
            words = np.zeros((len(part), WIDTH), np.uint8)
            words[:, : len(MARK)] = np.frombuffer(MARK, np.uint8)
            for k in range(LONG):
                has = sizes[part] > k
                if not has.any():
                    break
                words[has, len(MARK) + k] = data[starts[part[has]] + k]
            counts[part] = self.trie_counts(words, sizes[part] + len(MARK))
        for i in np.flatnonzero(sizes > LONG):
            word = MARK + data[starts[i] : ends[i]].tobytes()
            counts[i] = count_alone(word, self.pieces, self.sizes[-1], self.fallback)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.counts = np.insert(self.keys, at, keys), np.insert(self.counts, at, counts)

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens and tokens of each text."""
        data, offsets = flat(texts)
        starts, ends = spans(~WHITE[data], offsets)
        if not len(starts):
            return np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
        keys, first, inverse = np.unique(range_hashes(prefix(data), starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > MEMORY:
            self._empty()
        at = np.searchsorted(self.keys, keys)
        new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            self._learn(keys[new], data, starts[first[new]], ends[first[new]])
        tokens = np.concatenate([[0], np.cumsum(self.counts[np.searchsorted(self.keys, keys)][inverse], dtype=np.int64)])
        bounds = np.searchsorted(starts, offsets)
        return np.diff(bounds), tokens[bounds[1:]] - tokens[bounds[:-1]]


def _counted(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counter = TrieCounter(path)
    for batch in chunks(batches):
        words, tokens = counter.count(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.astype(np.int64)), pa.array(tokens)], ["doc_id", "n_words", "n_tokens"])


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_tokens."""
    path = path or tokenizer_path(NAME)
    return docs.select("doc_id", "text").mapInArrow(partial(_counted, path=path), "doc_id long, n_words long, n_tokens long")
