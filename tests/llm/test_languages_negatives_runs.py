"""Language profiles, hard negatives and periodic runs against plain versions of themselves."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from salesmart.llm import language_profiles as lp
from salesmart.llm.hard_negatives import Rows, hard_negatives, threshold_top
from salesmart.llm.periodic_runs import find_runs, periodic_runs, perturbed, run_digests

SF = "/root/testdata/sf0.01"


# --- periodic runs ----------------------------------------------------------------------------------------------


def plain_runs(w: list) -> list[tuple[int, int, int]]:
    """Every lag and every place; the smallest lag of a stretch is its period."""
    found: dict[tuple[int, int], int] = {}
    for p in range(1, len(w) // 3 + 1):
        i = p
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - p]:
                j += 1
            if j > i and j - i + p >= max(24, 3 * p):
                found.setdefault((i - p, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng: random.Random) -> list[int]:
    w: list[int] = []
    for _ in range(rng.randint(0, 6)):
        letters = rng.choice([1, 2, 3, 5, 50])
        base = [rng.randrange(letters) for _ in range(rng.randint(1, rng.choice([3, 20, 60])))]
        kind = rng.randrange(5)
        if kind == 0:
            w += base
        elif kind == 1:
            w += base * rng.randint(2, 8)
        elif kind == 2:
            w += (base * 40)[: rng.randint(10, 90)]
        elif kind == 3 and w:
            w += w[-rng.randint(1, len(w)) :]
        else:
            w += ((base + base + [rng.randrange(letters)]) * rng.randint(1, 5))[:300]
    return w


def test_runs_equal_all_lags():
    rng = random.Random(7)
    n = 0
    for _ in range(600):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 4))]
        got = find_runs(np.array(sum(texts, []), np.int64), np.cumsum([0, *map(len, texts)]))
        want = {t: r for t, w in enumerate(texts) if (r := plain_runs(w))}
        assert got == want
        n += sum(map(len, want.values()))
    assert n > 1000


def test_runs_of_long_repeats_stay_linear():
    assert find_runs(np.zeros(400_000, np.int64), np.array([0, 400_000])) == {0: [(0, 400_000, 1)]}
    base = np.random.default_rng(1).integers(0, 9, 50_000)
    assert find_runs(np.tile(base, 4)[:170_001], np.array([0, 170_001])) == {0: [(0, 170_001, 50_000)]}


def _digest_row(doc_id, text):
    w = [x.decode() for x in (text or "").encode().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if x]
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g = h // 10
        a, p = g % len(w), 1 + (len(w) - g % len(w)) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    kept = [x for i, x in enumerate(w) if not any(s + p <= i < s + n for s, n, p in runs)]
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return doc_id, len(w), len(runs), *best, milli, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(kept))


def test_run_digests_of_odd_documents(spark, odd_docs):
    short = odd_docs.where("length(text) < 20000 OR text IS NULL")
    line = spark.createDataFrame([(70 + i, " ".join(["a b c d"] * 9) + "\n" + "x y " * i) for i in range(20)], "doc_id long, text string")
    docs = short.select("doc_id", "text", "piece").unionByName(line.selectExpr("doc_id", "text", "1L AS piece"))
    want = sorted((_digest_row(r.doc_id, r.text) for r in docs.collect()), key=str)
    assert sorted(map(tuple, run_digests(docs, perturbed).collect()), key=str) == want
    assert sum(r[2] for r in want) > 20
    long_one = run_digests(odd_docs.where("doc_id = 5")).first()
    assert (long_one.n_words, long_one.n_runs, long_one.start) == (30_000, 0, None)


def test_runs_of_a_table(spark, no_docs):
    docs = spark.createDataFrame([(1, "z " + "a b c " * 10 + "y"), (2, None), (3, "one two"), (1, "z " + "a b c " * 10 + "y")], "doc_id long, text string")
    assert sorted(map(tuple, periodic_runs(docs).collect())) == [(1, 1, 30, 3)] * 2
    assert periodic_runs(no_docs).collect() == [] and run_digests(no_docs).collect() == []


def test_op13_equals_plain_version(spark):
    from salesmart.llm.periodic_runs import op13_periodic_runs

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    some = [r for r in docs if len(r.text or "") < 6000]  # the plain version is quadratic
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs) and len(some) > 0.8 * len(docs)
    assert [got[r.doc_id] for r in some] == [_digest_row(r.doc_id, r.text) for r in some]


# --- hard negatives ----------------------------------------------------------------------------------------------


def plain_negatives(rows: list[tuple]) -> list[tuple]:
    """(vec_id, label, vector, anchor): every anchor against every row."""
    def numbers(v):
        try:
            q = [math.floor(256 * float(x)) for x in v]
        except (TypeError, ValueError, OverflowError):
            return None
        return q

    used = [(i, la, q, a) for i, la, v, a in rows if None not in (i, la, v) and (q := numbers(v)) is not None]
    def score(x, y):
        s = sum(int(b) * int(c) for b, c in zip(x, y, strict=False))
        return min(max(s, -(2**63)), 2**63 - 1)
    out = []
    for i, la, q, a in used:
        if not a:
            continue
        scored = [(-score(q, y), j, lb) for j, lb, y, _ in used]
        for s, j, _ in sorted(x for x in scored if x[2] == la and x[1] != i)[:5]:
            window = sorted(x for x in scored if x[2] != la and 80 * -s <= 100 * -x[0] <= 100 * -s)[:5]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(window)]
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "vec_id long, label int, vector array<double>, anchor boolean, score long")


def _got(df) -> list[tuple]:
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_hard_negatives_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        v = rng.normal(size=6) + (i % 3) * 0.5 if i % 4 else np.round(rng.normal(size=6))  # rounded ones tie
        rows.append((i, int(rng.integers(0, 4)) if i % 3 else 1, v.tolist(), i % 20 == 0))
    rows += [rows[5], rows[20], (500, 1, [], False), (501, 2, [1.0], True), (502, 2, [0.0] * 6, True), (None, 1, [1.0] * 6, True), (503, None, [1.0] * 6, True), (504, 1, None, True),
             (505, 1, [1.0, None], True), (506, 1, [float("nan")] * 6, False), (507, 1, [float("inf")] * 6, True), (508, 3, [-2.0] * 6, None)]
    want = plain_negatives(rows)
    assert len(want) > 200
    assert _got(hard_negatives(_frame(spark, rows))) == want
    assert _got(hard_negatives(_frame(spark, rows), chunk_values=120, group_values=30)) == want  # many cells


def test_hard_negatives_of_large_components(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, (rng.normal(size=3) * 10.0 ** rng.integers(-3, 9)).tolist(), i % 5 == 0) for i in range(60)]
    assert _got(hard_negatives(_frame(spark, rows))) == plain_negatives(rows)
    huge = [(i, i % 2, [1e300 * (1 + i % 3), 1.0], i == 0) for i in range(12)] + [(20, 0, [1.7e308, 0.0], True)]
    assert _got(hard_negatives(_frame(spark, huge))) == plain_negatives(huge[:-1])


def test_hard_negatives_of_nothing(spark):
    rows = [(100, 1, [1.0], True)]
    assert hard_negatives(_frame(spark, [])).collect() == [] == hard_negatives(_frame(spark, rows)).collect()


def test_threshold_stops_early():
    """On few dimensions most rows are never scored, and the result is that of all rows."""
    rng = np.random.default_rng(5)
    n = 20_000
    rows = Rows(np.arange(n), np.arange(n), np.arange(n) % 2, np.floor(256 * rng.normal(size=(n, 3))))
    anchors = Rows(np.array([n]), np.array([n]), np.array([0]), np.array([[200.0, -150.0, 90.0]]))
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray) and at.dtype == np.int64 and self.ndim == 1:
                read.append(len(at))
            return super().__getitem__(at)

    rows.labels = rows.labels.view(Counted)
    (found,) = threshold_top(rows, anchors, [[(-(2**63), 2**63 - 1)]], 5, same=False)
    scores = (rows.vectors @ anchors.vectors[0]).astype(np.int64)
    order = np.lexsort((np.arange(n), -scores))
    assert found[2].tolist() == [i for i in order if i % 2][:5]
    assert 0 < sum(read) < n / 4


# --- language profiles -------------------------------------------------------------------------------------------


def plain_bundle(text: str) -> np.ndarray:
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    letters = " " + " ".join(letters.split()) + " "
    signs = {c: lp.letter_vectors(np.array([ord(c)]))[0].astype(int) for c in set(letters)}
    total = np.zeros(lp.DIMENSIONS, int)
    for gram, n in Counter(letters[i : i + 3] for i in range(len(letters) - 2)).items():
        total += n * np.roll(signs[gram[0]], 2) * np.roll(signs[gram[1]], 1) * signs[gram[2]]
    return total


TEXTS = ["Ein Haus, das man kennt.", "the house  that\n1 knew", "é ß 漢字 \U0001f600 İstanbul", "", None, "123 !", "x", "word " * 500, "The퟿ end", "ÀÉ-of  the"]


def test_bundles_equal_plain_ones(monkeypatch):
    for chunk, cells in ((8192, 4 << 20), (5, 12)):
        monkeypatch.setattr(lp, "CHUNK", chunk)
        monkeypatch.setattr(lp, "CELLS", cells)
        text, which, grams = lp.ngrams(TEXTS)
        got = lp.bundles(text, which, grams, len(TEXTS))
        for t, bundle in zip(TEXTS, got, strict=True):
            want = plain_bundle(t) if t and any(map(str.isalpha, t)) else np.zeros(lp.DIMENSIONS)
            assert bundle.tolist() == want.tolist()


def test_letter_vectors_are_nearly_orthogonal():
    v = lp.letter_vectors(np.arange(97, 123)).astype(int)
    cosine = (v @ v.T - lp.DIMENSIONS * np.eye(26)) / lp.DIMENSIONS
    assert np.abs(cosine).max() < 0.2 and abs(cosine.mean()) < 0.01


def test_predictions_equal_plain_ones(spark, odd_docs):
    docs = odd_docs.withColumn("text", odd_docs.text.substr(1, 4000))
    profiles = lp.learn(docs)
    rows = docs.collect()
    sums: dict[str, np.ndarray] = {}
    for r in rows:
        if r.lang is not None and r.text and any(map(str.isalpha, r.text)):
            sums[r.lang] = sums.get(r.lang, 0) + plain_bundle(r.text)
    assert {r.lang: np.frombuffer(r.bundle, np.int64).tolist() for r in profiles.collect()} == {k: v.tolist() for k, v in sums.items()}
    held = docs.selectExpr("doc_id", "text", "doc_id % 2 = 0 AS held_out", "piece AS score")
    want = []
    for r in rows:
        if r.text and any(map(str.isalpha, r.text)):
            b = plain_bundle(r.text)
            cosine = {k: round(float(b @ v) / math.sqrt(float(b @ b) * float(v @ v)), 9) for k, v in sorted(sums.items())}
            best = max(cosine, key=cosine.get)
            want.append((r.doc_id, best, max(0.0, cosine[best])))
        else:
            want.append((r.doc_id, "und", 0.0))
    for at_once in (512, 1):
        got = [(r.doc_id, r.lang_pred, r.score) for r in lp.predict(held, profiles, at_once).collect()]
        by = lambda rows: sorted(rows, key=str)
        assert [x[:2] for x in by(got)] == [x[:2] for x in by(want)]
        assert [x[2] for x in by(got)] == pytest.approx([x[2] for x in by(want)], abs=2e-9)


def test_languages_of_nothing(spark, no_docs):
    profiles = lp.learn(no_docs)
    assert profiles.collect() == [] and lp.predict(no_docs.selectExpr("doc_id", "text", "true AS held_out"), profiles).collect() == []
    one = spark.createDataFrame([(1, "text", False)], "doc_id long, text string, held_out boolean")
    assert [tuple(r) for r in lp.predict(one, profiles).collect()] == [(1, False, "und", 0.0)]


def test_op11_held_out_accuracy(spark):
    got = lp.op11_language_profiles(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got) and {r.lang_pred for r in got} <= {*lang.values(), "und"}
    assert sorted(map(tuple, got)) == sorted(map(tuple, lp.op11_language_profiles(spark, SF).collect()))
