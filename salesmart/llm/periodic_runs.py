"""Periodic runs of words by an online sparse diagonal DP.

A run is a stretch of words with smallest period q that no neighbour extends
keeping q, of at least ``LEAST`` words and ``TIMES`` periods. On the diagonal
of lag p lie the places i with word[i] == word[i - p]; a stretch of period p and
m words is a match length of m - p there. The DP reads the words in order: the
earlier occurrences of each word lengthen the active diagonals by one, a diagonal
that the next word does not lengthen has ended and emits its run at once.

The DP is sparse: a diagonal that can become a run has at least max(LEAST - p, (TIMES - 1) p)
matches, so a word's earlier occurrence counts only where the k words from it
on match too, with k = ``GRAM`` for p <= GRAM, then 2 GRAM for p <= 2 GRAM, and so on. Of
those only the nearest can have lag p: if k words of smallest period p <= k recurred at a
lag l < p, the stretch would have period gcd(p, l). So each word has at most one
event a level, whatever is repeated how often, and a text of n words takes O(n log n)
steps. The nearest lag also is the smallest period, so no multiple of it is emitted.

Words that recur with the k words behind them are found for a slice of texts at once,
by doubling (the number of 2k words is that of two numbers of k words) among
the places that recur at all; prose without repetition ends after a few steps.

Edges: null and empty texts have no words and no runs; texts of any length are
worked on whole; rows are judged one by one, so ties and repeated rows stay;
a null doc_id gives its row as it is (``perturbed`` leaves its words alone);
extra columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.words import slices, words

LEAST = 24
TIMES = 3
GRAM = 16
Run = tuple[int, int, int]
_OUT = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _doubled(at: np.ndarray, ids: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of the 2k words from each place, of those that occur twice or more; ``ids`` number k words."""
    dense = np.full(n + k, -1, np.int64)
    dense[at] = ids
    second = dense[at + k]
    both = second >= 0
    at, pair = at[both], ids[both] * n + second[both]
    return _repeated(at, pair)


def _repeated(at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = pd.factorize(ids)[0]
    again = np.bincount(codes)[codes] > 1 if len(codes) else np.empty(0, bool)
    return at[again], codes[again]


def _nearest(at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose number occurred before, with the lag to its nearest earlier place."""
    order = np.argsort(ids, kind="stable")
    same = ids[order][1:] == ids[order][:-1]
    here, before = at[order[1:][same]], at[order[:-1][same]]
    sort = np.argsort(here)
    return here[sort], (here - before)[sort]


def _events(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of all earlier occurrences that may lengthen a diagonal, by place, for texts one after another.

    ``codes[rows[t]:rows[t + 1]]`` are the words of text t; grams never reach over a text's end.
    """
    n = len(codes)
    text = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    at, ids = _repeated(np.arange(n), text * (int(codes.max()) + 1 if n else 1) + codes)
    longest = int(np.diff(rows).max()) if len(rows) > 1 else 0
    k, places, lags = 1, [], []
    while k < GRAM and len(at):
        at, ids = _doubled(at, ids, k, n)
        k *= 2
    while len(at) and TIMES * (k // 2) <= longest:
        here, lag = _nearest(at, ids)
        level = (lag <= k) & ((lag > k // 2) | (k == GRAM))
        places.append(here[level])
        lags.append(lag[level])
        at, ids = _doubled(at, ids, k, n)
        k *= 2
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, lag = np.concatenate(places), np.concatenate(lags)
    sort = np.argsort(place, kind="stable")
    return place[sort], lag[sort]


def _diagonals(places: list[int], lags: list[int]) -> Iterator[tuple[int, int, int]]:
    """(first place, last place, lag) of each diagonal, as soon as a word does not lengthen it."""
    active: dict[int, list[int]] = {}  # lag: first and last place
    now = -1
    for i, p in zip(places, lags, strict=True):
        if i != now:
            for lag in [lag for lag, (_, last) in active.items() if last < i - 1]:
                yield *active.pop(lag), lag
            now = i
        diagonal = active.setdefault(p, [i, i])
        if diagonal[1] < i - 1:  # ended, and the same lag begins anew
            yield *diagonal, p
            diagonal[0] = i
        diagonal[1] = i
    for lag, (first, last) in active.items():
        yield first, last, lag


def find_runs(codes: np.ndarray, rows: np.ndarray) -> dict[int, list[Run]]:
    """The runs (start, length, period) of each text that has any, by start, then period."""
    place, lag = _events(codes, rows)
    found: dict[int, list[Run]] = {}
    text = np.searchsorted(rows, place, side="right") - 1
    cuts = np.flatnonzero(np.diff(text)) + 1
    for some in np.split(np.arange(len(place)), cuts) if len(place) else []:
        t = int(text[some[0]])
        a, b = int(rows[t]), int(rows[t + 1])
        runs = []
        for first, last, p in _diagonals(place[some].tolist(), lag[some].tolist()):
            k = GRAM  # the last place stands for the k words from it on
            while k < p:
                k *= 2
            start, end = first - p, last + k
            if end - start < max(LEAST, TIMES * p):
                continue
            open_left = start > a and codes[start - 1] == codes[start - 1 + p]
            open_right = end < b and codes[end] == codes[end - p]
            if not open_left and not open_right:
                runs.append((start - a, end - start, p))
        if runs:
            found[t] = sorted(runs, key=lambda r: (r[0], r[2]))
    return found


def perturbed(doc_id: int | None, codes: np.ndarray) -> np.ndarray:
    """The contract's words: for one id in ten, those from a on repeat with period p."""
    h, n = (None if doc_id is None else zlib.crc32(str(doc_id).encode())), len(codes)
    if h is None or h % 10 or n == 0:
        return codes
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((codes[:a], codes[a + np.arange(n - a) % p]))


def _kept(n: int, runs: list[Run]) -> np.ndarray:
    """Which words no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def digest(doc_id: int | None, codes: np.ndarray, vocabulary: list[bytes], runs: list[Run]) -> tuple:
    """A row of ``_OUT``."""
    kept = codes[_kept(len(codes), runs)] if runs else codes
    collapsed = hashlib.sha256(b" ".join(map(vocabulary.__getitem__, kept.tolist()))).hexdigest()
    listed = hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()).hexdigest()
    if not runs:
        return doc_id, len(codes), 0, None, None, None, None, listed, collapsed
    start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return doc_id, len(codes), len(runs), start, length, period, 1000 * length // period, listed, collapsed


def _texts(batches: Iterator[pa.RecordBatch], change) -> Iterator[tuple[list, np.ndarray, np.ndarray, list[bytes]]]:
    for batch in slices(batches, "text"):
        w = words(batch.column("text"))
        ids, codes = batch.column("doc_id").cast(pa.int64()).to_pylist(), w.codes
        if change is not None and len(codes):
            codes = np.concatenate([change(d, codes[a:b]) for d, a, b in zip(ids, w.rows[:-1].tolist(), w.rows[1:].tolist(), strict=True)])
        yield ids, codes, w.rows, w.vocabulary.to_pylist()


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, period) of every run of each row of ``docs`` (doc_id, text); starts are word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, codes, rows, _ in _texts(batches, None):
            out = [(ids[t], *r) for t, runs in find_runs(codes, rows).items() for r in runs]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["doc_id", "start", "length", "period"]), _RUNS, preserve_index=False)

    return _source(docs).mapInArrow(run, "doc_id long, start long, length long, period long")


_RUNS = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "period")])


def run_digests(docs: DataFrame, change=None) -> DataFrame:
    """A row for each of ``docs`` (doc_id, text): its runs counted, the most repeated one, checksums of all runs and of the text without repeats.

    ``change(doc_id, codes)`` may replace a text's words (as numbers) before.
    """
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _OUT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, codes, rows, vocabulary in _texts(batches, change):
            runs = find_runs(codes, rows)
            out = [digest(d, codes[rows[t] : rows[t + 1]], vocabulary, runs.get(t, [])) for t, d in enumerate(ids)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return _source(docs).mapInArrow(run, _OUT)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their runs, after the contract's repetition of words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return run_digests(docs, perturbed)
