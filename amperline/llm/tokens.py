"""Token ids of whole texts by a public tokenizer, with its work shared between equal words.

The tokenizer drops white space and never joins what white space separates, and it always cuts between an ASCII
letter and most ASCII punctuation.  So a text's ids are those of its atoms, one after the other; an atom is
tokenized when a task first meets it, and its ids are copied afterwards.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from amperline.llm.bytetext import WHITE, chunks, edges, flat, prefix, range_hashes, ranges

END_ID = 1
NAME = "word_bpe_49k.json"
#: Atoms whose ids are kept per task; beyond it, the memory is emptied and filled again.
MEMORY = 1_500_000

# 1: ASCII letters.  2: ASCII punctuation, but not the apostrophe (contractions are tokens) and not the bar (it stands
# in the names of special tokens).
KIND = np.zeros(256, np.uint8)
KIND[np.r_[65:91, 97:123]] = 1
KIND[[ord(c) for c in '!"#$%&()*+,-./:;<=>?@[\\]^_`{}~']] = 2
# The characters by which a byte-level model writes bytes: printable ones as themselves, the others from 256 on.
_PRINTED = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
BYTE_CHARS = dict(zip([b for b in range(256) if b not in _PRINTED], range(256, 512), strict=False))


def tokenizer_path(name: str = NAME) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def atoms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts that the tokenizer treats on their own."""
    inside, kind = ~WHITE[data], KIND[data]
    begin, end = edges(inside, offsets)
    # Neighbours of kinds 1 and 2 belong to one run of the text's other bytes, but to two atoms.
    cut = (kind[:-1] + kind[1:] == 3) & (kind[:-1] > 0) & (kind[1:] > 0)
    begin[1:] |= cut
    end[:-1] |= cut
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


class BatchTokenizer:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._empty()

    def _empty(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16)
        self.offsets = np.zeros(1, np.int64)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        found: list[list[int] | None] = [None] * len(words)
        other = []
        for i, word in enumerate(words):
            # Letters up to U+00FF need lower case only and are one pre-token: the model can take them at once.
            if word.isalpha() and max(word) <= "\u00ff":
                found[i] = [t.id for t in self.model.tokenize(word.lower().encode().decode("latin-1").translate(BYTE_CHARS))]
            else:
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False), strict=True):
            found[i] = e.ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        joined = np.fromiter((i for ids in found for i in ids), np.uint16, int(sizes.sum()))
        first = len(self.offsets) - 1
        self.ids = np.concatenate([self.ids, joined])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.places = np.insert(self.places, at, np.arange(first, first + len(keys)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offset of each text."""
        data, offsets = flat(texts)
        starts, ends = atoms(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
        hashes = range_hashes(prefix(data), starts, ends)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > MEMORY:
            self._empty()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        if new.any():
            raw = data.tobytes()
            words = [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            self._learn(keys[new], words)
        place = self.places[np.searchsorted(self.keys, keys)][inverse]
        sizes = self.offsets[place + 1] - self.offsets[place]
        ids = self.ids[ranges(self.offsets[place], sizes)]
        before = np.concatenate([[0], np.cumsum(sizes)])
        return ids, before[np.searchsorted(starts, offsets)]

    def tokenized(self, batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for batch in chunks(batches, column):
            yield batch, *self.encode(batch.column(batch.schema.get_field_index(column)))
