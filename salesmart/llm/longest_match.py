"""Token counts by greedy longest match with a linear-time automaton.

The vocabulary is a trie over bytes. Where a word can't go on in the trie, the
longest pieces of what was read are popped and the walk goes on behind them:
every node holds a failure link, the node reached after the pops, and the
number of pieces popped on the way, both computed once, breadth first. A word
is counted in one pass over its bytes, however often matches fail, and no
piece is ever built.

A word begins with the mark of a word's start (a space in this vocabulary), so
pieces that hold the mark match at the start only. A word that can't be cut into
pieces at all counts as one unknown token.

Each distinct word of a batch is counted once. Nulls and empty texts have no
words and no tokens; repeated rows are counted each; an empty table gives no
rows.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.tokens import byte_letters, tokenizer_path
from salesmart.llm.words import slices, words

_NONE = -1


class LongestMatch:
    """``count(word)``: the pieces of the greedy longest match, ``_NONE`` where there is no match."""

    def __init__(self, pieces: Iterable[bytes], start: bytes = b" "):
        self.go: dict[int, int] = {}  # node * 256 + byte: node
        whole, up = [False], [(0, 0)]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                if key not in self.go:
                    self.go[key] = len(whole)
                    whole.append(False)
                    up.append((node, byte))
                node = self.go[key]
            whole[node] = node > 0
        self.start = start
        self._link(whole, up)

    def _link(self, whole: list[bool], up: list[tuple[int, int]]) -> None:
        n, go = len(whole), self.go
        fail, pops = [_NONE] * n, [0] * n
        below: list[list[int]] = [[] for _ in range(n)]
        for node in range(1, n):
            below[up[node][0]].append(node)
        todo = deque(below[0])
        while todo:
            node = todo.popleft()
            todo.extend(below[node])
            if whole[node]:  # the piece itself is popped, the next begins at the root
                fail[node], pops[node] = 0, 1
                continue
            parent, byte = up[node]
            if parent == 0:
                continue  # one byte that is no piece
            at, popped = fail[parent], pops[parent]
            while at != _NONE and (at << 8 | byte) not in go:
                at, popped = (fail[at], popped + pops[at]) if at else (_NONE, 0)
            if at != _NONE:
                fail[node], pops[node] = go[at << 8 | byte], popped
        self.fail, self.pops = fail, pops

    def count(self, word: bytes) -> int:
        go, fail, pops, node, popped = self.go, self.fail, self.pops, 0, 0
        for byte in self.start + word:
            while (to := go.get(node << 8 | byte)) is None:
                if node == 0 or fail[node] == _NONE:
                    return _NONE
                popped += pops[node]
                node = fail[node]
            node = to
        while node:
            if fail[node] == _NONE:
                return _NONE
            popped += pops[node]
            node = fail[node]
        return popped


@lru_cache(maxsize=2)
def automaton(path: str) -> LongestMatch:
    """The worker's automaton for a byte-level vocabulary file."""
    byte = {letter: b for b, letter in byte_letters().items()}
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    return LongestMatch(bytes(map(byte.__getitem__, piece)) for piece in vocabulary if all(c in byte for c in piece))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) for each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = automaton(path).count
        for batch in slices(batches, "text"):
            w = words(batch.column("text"))
            each = np.fromiter(map(count, w.vocabulary.to_pylist()), np.int64, len(w.vocabulary))[w.codes]
            unknown = each == _NONE
            total, lost = (np.concatenate(([0], np.cumsum(x)))[w.rows] for x in (np.where(unknown, 1, each), unknown))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(w.rows), pa.int64()), pa.array(np.diff(total), pa.int64()), pa.array(np.diff(lost), pa.int64())],
                                             ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their counts of words and greedy pieces."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))
