"""Language identification by hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs, drawn from its code point.
An n-gram of letters is bound: the product of its letters' vectors, each permuted
(rotated) by the letter's distance from the n-gram's end, so order matters. A
text is bundled: the sum of the vectors of all its n-grams. So is a language, over all
its training texts. A text has the language whose bundle has the greatest cosine with the
text's (ties: the smallest name); the score is that cosine, 0 where it is below.

Letters are those of Unicode, lower-cased; runs of anything else are one space, and texts begin
and end with one. Spaces have a vector like letters.

Learning adds counts, so it is exact whatever the order: tasks count the n-grams of a
language in a slice of texts, bundle the counts, and send one vector of whole numbers a language;
these are added by (language, group of tasks), then by language. Profiles are stored in the shared
folder; ``AT_ONCE`` languages at a time come to the driver and go out with the scoring tasks, and
each pass keeps the better of its languages and those before, so no number of languages is too large.
Vectors of n-grams are computed where they occur, ``CHUNK`` at a time; no vocabulary is kept.

Edges: a null text, or one without a letter, is ``und`` with score 0 and teaches nothing, as do rows with
a null language; without any profile all are ``und``. A null doc_id is held out. Texts are
read whole (memory follows the longest one); repeated rows teach and are predicted each; extra columns are not looked at; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.words import slices
from salesmart.session import scratch_dir

DIMENSIONS = 1024
N = 3
NONE = "und"
SEED = 20_240_229
#: Distinct n-grams bound at once, counts of a matrix, languages of a pass and of a task's dictionary.
CHUNK = 8192
CELLS = 4 << 20
AT_ONCE = 512
SLICE_BYTES = 4 << 20
_PROFILE = "lang string, part long, bundle binary"
_PREDICTED = "doc_id long, text string, held_out boolean, lang_pred string, score double"


# --- letters and n-grams --------------------------------------------------------------------------------------


def _distinct(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct code points in order, and a table from code point to place among them."""
    used = np.bincount(points, minlength=1) > 0
    return np.flatnonzero(used), np.cumsum(used) - 1


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single spaces of texts one after another (``rows`` are their borders); a text without a letter is empty.

    Each text begins and ends with a space.
    """
    lowered = [f" {t.lower()} " if t else "" for t in texts]
    ends = np.cumsum([0, *map(len, lowered)])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    distinct, place = _distinct(points)
    letter = np.array([chr(c).isalpha() for c in distinct.tolist()], bool)[place[points]]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of spaces
    keep[ends[:-1][np.diff(ends) > 0]] = True
    has = np.concatenate(([0], np.cumsum(letter)))
    keep &= np.repeat(has[ends[1:]] > has[ends[:-1]], np.diff(ends))
    return np.where(letter, points, 32)[keep], np.concatenate(([0], np.cumsum(keep)))[ends]


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, number of n-gram) of all n-grams in order, and the distinct n-grams as rows of code points."""
    points, rows = code_points(texts)
    distinct, place = _distinct(points)
    codes = place[points]
    text = np.repeat(np.arange(len(texts)), np.diff(rows))
    n, k = len(points), len(distinct)
    if n < N:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, N), np.int64)
    number = sum(codes[i : n - N + 1 + i] * k ** (N - 1 - i) for i in range(N))  # k < 2^21, so three fit
    whole = text[: n - N + 1] == text[N - 1 :]
    number, text = number[whole], text[: n - N + 1][whole]
    if k**N <= CELLS:
        seen, place = _distinct(number)
        which = place[number]
    else:
        which, seen = pd.factorize(number, sort=True)
    return text, which, distinct[np.stack([seen // k ** (N - 1 - i) % k for i in range(N)], axis=1)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits of noise for each number (the finalizer of splitmix64)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """The signs of some code points, +1 or -1 (int8)."""
    words = DIMENSIONS // 64
    seeds = points.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
    with np.errstate(over="ignore"):
        noise = _mixed(_mixed(seeds) ^ np.uint64(SEED))
    bits = np.unpackbits(noise.view(np.uint8).reshape(len(points), -1), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def bound_vectors(grams: np.ndarray) -> np.ndarray:
    """The bound vectors of n-grams (a row of code points each)."""
    points, at = np.unique(grams, return_inverse=True)
    letters, at = letter_vectors(points), at.reshape(grams.shape)
    out = np.ones((len(grams), DIMENSIONS), np.int8)
    for i in range(N):
        out *= np.roll(letters, N - 1 - i, axis=1)[at[:, i]]
    return out


def bundles(groups: np.ndarray, which: np.ndarray, grams: np.ndarray, n_groups: int) -> np.ndarray:
    """The sums of the vectors of each group's n-grams: whole numbers, as doubles."""
    out = np.zeros((n_groups, DIMENSIONS))
    if n_groups * len(grams) > CELLS and np.any(groups[1:] < groups[:-1]):
        order = np.argsort(groups, kind="stable")
        groups, which = groups[order], which[order]
    for first in range(0, len(grams), CHUNK):
        vectors = bound_vectors(grams[first : first + CHUNK]).astype(np.float32)
        mine, numbers, width = groups, which, len(vectors)
        if len(grams) > CHUNK:
            some = (which >= first) & (which < first + CHUNK)
            mine, numbers = groups[some], which[some] - first
        step = max(1, CELLS // width)
        for g in range(0, n_groups, step):
            n = min(step, n_groups - g)
            c, d = (0, len(mine)) if n == n_groups else np.searchsorted(mine, [g, g + n])
            counts = np.bincount((mine[c:d] - g) * width + numbers[c:d], minlength=n * width).reshape(n, width)
            small = counts.sum(axis=1).max() < 2**24  # then all sums are exact as floats
            out[g : g + n] += counts.astype(np.float32) @ vectors if small else counts.astype(np.float64) @ vectors.astype(np.float64)
    return out


# --- learning -----------------------------------------------------------------------------------------------------


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    total: dict[str, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        names = list(total)
        rows = [names, [part] * len(names), [total.pop(n).tobytes() for n in names]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.string(), pa.int64(), pa.binary()), strict=True)], ["lang", "part", "bundle"])

    for batch in slices(batches, "text", SLICE_BYTES):
        names, group = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
        text, which, grams = ngrams(batch.column("text").to_pylist())
        of_text = group[text]
        sums = bundles(of_text, which, grams, len(names))
        taught = np.bincount(of_text, minlength=len(names)) > 0
        for name, bundle in zip(names[taught], sums[taught].astype(np.int64), strict=True):
            total[name] = total.get(name, 0) + bundle
        if len(total) > AT_ONCE:
            yield out()
    yield out()


def _added(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(DIMENSIONS, np.int64)
    for bundle in pdf["bundle"]:
        total += np.frombuffer(bundle, np.int64)
    return pd.DataFrame({"lang": [key[0]], "part": [int(key[1]) if len(key) > 1 else 0], "bundle": [total.tobytes()]})


def learn(docs: DataFrame) -> DataFrame:
    """(lang, part, bundle) of each language of ``docs`` (text, lang) that has a letter, stored in the shared folder."""
    spark = docs.sparkSession
    folder = f"{scratch_dir(spark, 'languages')}/profiles"
    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    parts = known.mapInArrow(_learn, _PROFILE)
    some = parts.groupBy("lang", F.pmod("part", F.lit(64)).alias("part")).applyInPandas(_added, _PROFILE)
    some.groupBy("lang").applyInPandas(_added, _PROFILE).write.parquet(folder)
    return spark.read.schema(_PROFILE).parquet(folder)


# --- predicting ----------------------------------------------------------------------------------------------------


def _predict(names: list[str], profiles: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A pass over some languages, by name: a text takes the best of them where it beats what it has."""
    norms = np.sqrt((profiles.astype(np.float64) ** 2).sum(axis=1))
    units = np.divide(profiles, norms[:, None], out=np.zeros(profiles.shape), where=norms[:, None] > 0).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            text, which, grams = ngrams(batch.column("text").to_pylist())
            sums = bundles(text, which, grams, batch.num_rows)
            size = np.sqrt((sums**2).sum(axis=1))
            has = np.bincount(text, minlength=batch.num_rows) > 0
            cosine = np.round(np.divide(sums @ units, size[:, None], out=np.zeros((batch.num_rows, len(names))), where=size[:, None] > 0), 9)
            best = cosine.argmax(axis=1)  # the first, so the smallest name
            before = batch.column("lang_pred").to_pylist()
            old = np.array([x if x is not None else -2.0 for x in batch.column("score").to_pylist()])
            new = cosine[np.arange(batch.num_rows), best]
            better = has & (new > old)
            columns = [batch.column(c) for c in ("doc_id", "text", "held_out")]
            columns.append(pa.array([names[b] if x else y for b, x, y in zip(best.tolist(), better.tolist(), before, strict=True)], pa.string()))
            score = np.where(better, new, old)
            columns.append(pa.array(score, pa.float64(), mask=score < -1))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PREDICTED.split(", ")])

    return run


def predict(docs: DataFrame, profiles: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row of ``docs`` (doc_id, text, held_out)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "held_out",
                       F.lit(None).cast("string").alias("lang_pred"), F.lit(None).cast("double").alias("score"))
    after = None
    while True:
        some = profiles if after is None else profiles.where(F.col("lang") > after)
        block = some.orderBy("lang").limit(at_once).collect()  # at most at_once vectors
        if not block:
            break
        after = block[-1]["lang"]
        vectors = np.stack([np.frombuffer(r["bundle"], np.int64) for r in block])
        docs = docs.mapInArrow(_predict([r["lang"] for r in block], vectors), _PREDICTED)
        if len(block) < at_once:
            break
    return docs.select("doc_id", "held_out", F.coalesce("lang_pred", F.lit(NONE)).alias("lang_pred"), F.greatest(F.coalesce("score", F.lit(0.0)), F.lit(0.0)).alias("score"))


def op11_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learnt from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))
    return predict(docs.select("doc_id", "text", held.alias("held_out")), learn(docs.where(~held)))
