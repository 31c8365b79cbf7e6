"""Token ids of text columns by the ``tokenizers`` library, once per distinct word.

Most of a corpus is the same words again. A batch is cut at places where the
tokenizer never joins text, each distinct piece is encoded once, and the ids
of a document are the ids of its pieces one after another: the same ids as
encoding the document whole, at a fraction of the time. The encoded pieces
are kept for the next batches and tasks of the worker, up to ``MAX_KEPT``
pieces or ``MAX_BYTES``; when there are more, the store starts anew (ids do not depend on it).
"""

from __future__ import annotations

import itertools
import os
import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from salesmart.llm.words import Words, ragged, spaced_words, words

MAX_KEPT = 1_500_000
MAX_BYTES = 96 << 20
#: Pieces that the tokenizers surely take as one word. They go straight to the library's merge
#: model; all others through the whole tokenizer.
_PLAIN = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class Encoder:
    """Encodes columns with the tokenizer of a file.

    ``spaces``: the tokenizer's pieces take the spaces before a word along;
    otherwise it drops white space.
    """

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already fill the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.cut = spaced_words if spaces else partial(words, marks=True)
        self.lower = not spaces  # the tokenizer without spaces lower-cases
        self.letter = byte_letters()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._clear()

    def _clear(self) -> None:
        self.known = pa.array([], pa.binary())
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.n_ids = self.n = 0

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        out: list = [None] * len(pieces)
        other, tokenize, space = [], self.model.tokenize, self.letter[0x20]
        for i, piece in enumerate(pieces):
            if _PLAIN.fullmatch(piece):
                word = piece.lower() if self.lower else piece
                letters = word.replace(" ", space) if word.isascii() else word.encode().decode("latin-1").translate(self.letter)
                out[i] = [t.id for t in tokenize(letters)]
            else:
                other.append(i)
        if other:
            for i, e in zip(other, self.tokenizer.encode_batch_fast([pieces[i] for i in other], add_special_tokens=False), strict=True):
                out[i] = e.ids
        return out

    def _add(self, new: pa.BinaryArray) -> None:
        """Encodes pieces and appends them to the store."""
        for i in range(0, len(new), 4096):
            ids = self._encode([p.decode("utf-8", "replace") for p in new.slice(i, 4096).to_pylist()])
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum()))
            while self.n_ids + len(flat) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
            while self.n + len(ids) > len(self.starts):
                self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
                self.lengths = np.concatenate((self.lengths, np.zeros_like(self.lengths)))
            self.ids[self.n_ids : self.n_ids + len(flat)] = flat
            self.starts[self.n : self.n + len(ids)] = self.n_ids + np.cumsum(lengths) - lengths
            self.lengths[self.n : self.n + len(ids)] = lengths
            self.n_ids += len(flat)
            self.n += len(ids)
        self.known = pa.concat_arrays([self.known, new])

    def _numbers(self, vocabulary: pa.BinaryArray) -> np.ndarray:
        if self.n > MAX_KEPT or self.known.nbytes + 4 * self.n_ids > MAX_BYTES:
            self._clear()
        found = pc.index_in(vocabulary, value_set=self.known)
        first = self.n
        if found.null_count:
            self._add(vocabulary.filter(found.is_null()))
        numbers = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        numbers[numbers < 0] = np.arange(first, self.n)
        return numbers

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): ``ids[ends[i]:ends[i + 1]]`` are the ids of row i; a null row has none."""
        w: Words = self.cut(column)
        if len(w.codes) == 0:
            return np.empty(0, np.uint32), np.zeros(len(w.rows), np.int64)
        each = self._numbers(w.vocabulary)[w.codes]
        lengths = self.lengths[each]
        ids = self.ids[ragged(self.starts[each], lengths)]
        return ids, np.concatenate(([0], np.cumsum(lengths)))[w.rows]


@lru_cache(maxsize=2)
def encoder(path: str, spaces: bool) -> Encoder:
    """The worker's encoder for a file; it lives as long as the worker."""
    return Encoder(path, spaces)


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file, which is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
