from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from salesmart.llm import katz, spherical_caps, superminhash
from salesmart.llm.components import components
from salesmart.session import scratch_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def _groups(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 501 + i) for i in range(200)]
    loose = [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)]
    links = chain + star + loose
    df = spark.createDataFrame(links, "u long, v long").repartition(7)
    got = {r.node: r.component for r in components(df, scratch_dir(spark, "test-cc")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == _groups(nodes, links)
    assert components(df.limit(0), scratch_dir(spark, "test-cc")).collect() == []


# --- SuperMinHash ---------------------------------------------------------------------------------------------


def test_signatures_are_superminhash():
    """Against the definition, one element and one swap at a time."""
    def slow(elements, m):
        out = np.full(m, np.inf)
        for e in elements:
            places = list(range(m))
            for j in range(m):
                offer, pick = superminhash._draw(np.array([e], np.uint64), j)
                k = j + int(pick[0]) % (m - j)
                places[j], places[k] = places[k], places[j]
                out[places[j]] = min(out[places[j]], j + offer[0])
        return out

    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 7, 0, 60, 400)]
    ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    got = superminhash.signatures(np.concatenate(sets), ends, 32)
    for row, s in zip(got, sets, strict=True):
        assert np.array_equal(row, slow(s, 32))


def test_equal_slots_estimate_similarity():
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    x = np.concatenate((both, a, both, b))
    got = superminhash.signatures(x, np.array([0, 900, 1800]), 1024)
    assert abs((got[0] == got[1]).mean() - 0.8) < 0.04


def _sets(rows, k):
    out = {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        out[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    return out


def _brute(rows, k, percent):
    sets = _sets(rows, k)
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    group = _groups(sets, links)
    return {i: (len(sets[i]), group[i], group[i] == i) for i in sets}


@pytest.fixture(scope="module")
def near_rows(prose):
    """Families of copies edited more and less, chains, shared passages, case and space variants, short texts."""
    rng, rows, i = random.Random(8), [], 0
    passage = prose(90, 77).split()
    for family in range(12):
        base = prose(100 + 20 * family, 200 + family).split()
        for copy in range(9):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9, 14])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            if copy == 8:
                words = words[:40] + passage + words[40:60]
            text = " ".join(words)
            rows.append((i, text.upper() if copy == 1 else text.replace(" ", "\n ", 3) if copy == 2 else text))
            i += 1
    return [*rows, (1000, None), (1001, ""), (1002, "  "), (1003, "a b"), (1004, "A  b"), (1005, "a b c"), (1006, "b a")]


@pytest.mark.parametrize("k,percent,rounds", [(4, 80, 1), (5, 80, 1), (5, 80, 0), (3, 60, 2)])
def test_near_duplicates(spark, near_rows, k, percent, rounds):
    df = spark.createDataFrame([(*r, "x") for r in near_rows], "doc_id long, text string, node string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in superminhash.near_duplicates(df, k, percent, pivot_rounds=rounds, rows=2 if percent < 80 else 4, bands=40).collect()}
    assert got == _brute(near_rows, k, percent)


@pytest.mark.parametrize("shape", ["inside", "outside"])
def test_bridge_between_the_groups_of_two_pivots(spark, shape):
    """u - x - y - w, u and w not linked: x ~ y joins them, by shingles of the pivots or by others, whichever two are the pivots."""
    def chain(name):
        words = lambda part, a, b: [f"{name}{part}{i}" for i in range(a, b)]
        if shape == "inside":
            return [words("a", s, s + 100) for s in (0, 8, 16, 24)]
        core, d = words("c", 0, 84), words("d", 0, 8)
        return [core + words("p", 0, 16), core + words("p", 0, 8) + d, core + words("q", 0, 8) + d, core + words("q", 0, 16)]

    rows, ends = [], 0
    for n in range(60):
        texts = [" ".join(w) for w in chain(f"n{n}")]
        hashes, at = superminhash.shingle_sets(pa.array(texts), 1)
        if len(np.unique(superminhash.signatures(hashes, at, 1))) > 1:
            continue  # not in one bucket
        order = sorted(range(4), key=lambda i: np.uint64(xxhash.xxh3_64_intdigest(hashes[at[i] : at[i + 1]].tobytes())).astype(np.int64))
        ends += set(order[2:]) == {0, 3}  # all weigh the same, so the largest two are the pivots
        rows += [(10 * n + i, text) for i, text in enumerate(texts)]
    assert ends >= 3
    got = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80, rows=1, bands=1).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 10 for i, _ in rows}


def test_a_bridge_without_an_id(spark):
    """1 ~ x ~ 2: the rows with x's text join the other two, with or without an id; repeats of a text without any id link nothing else."""
    words = [f"w{i}" for i in range(116)]
    text = lambda a, b: " ".join(words[a:b])
    rows = [(1, text(0, 100)), (2, text(16, 116)), (7, " ".join(f"q{i}" for i in range(60)))]
    for bridge in (9, None):
        docs = spark.createDataFrame([*rows, (bridge, text(8, 108)), (bridge, text(8, 108)), (None, " ".join(f"z{i}" for i in range(60)))], "doc_id long, text string")
        got = {(r.doc_id, r.n_shingles): r.component_id for r in superminhash.near_duplicates(docs).collect()}
        assert got == {(1, 96): 1, (2, 96): 1, (bridge, 96): 1, (7, 56): 7, (None, 56): None}


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    got = superminhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [(r.component_id, r.kept) for r in by[6]] == [(6, True)] * 2 and by[7][0].component_id == 6 and not by[7][0].kept
    assert [(by[i][0].n_shingles, by[i][0].component_id, by[i][0].kept) for i in (1, 2, 3)] == [(0, i, True) for i in (1, 2, 3)]
    assert by[None][0].kept
    assert superminhash.near_duplicates(no_docs).collect() == []


# --- embeddings --------------------------------------------------------------------------------------------------


def test_near_vectors(spark):
    rng, rows, n = np.random.default_rng(6), [], 0
    for group in range(30):
        base = rng.standard_normal(24)
        for _ in range(12):
            rows.append((n, (base + rng.standard_normal(24) * rng.choice([0.0, 0.1, 0.25, 0.4]) * np.linalg.norm(base) / 5).tolist(), int(group % 3)))
            n += 1
    v = rows[0][1]
    rows += [(n, v, 0), (n + 1, [3 * x for x in v], 0), (n + 2, v, 1), (n + 3, v, None), (n + 4, None, 0), (n + 5, [], 0), (n + 6, [0.0] * 24, 0), (n + 7, [None, *v[1:]], 0),
             (n + 8, [float("nan"), *v[1:]], 0), (n + 9, [float("inf"), *v[1:]], 0), (n + 10, v[:10], 0), (n + 11, [float("nan"), *v[1:]], 0)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, node int")

    def usable(x, label):
        return label is not None and x and all(c is not None and math.isfinite(c) for c in x) and any(x)

    links = []
    for (i, x, a), (j, y, b) in itertools.combinations(rows, 2):
        if usable(x, a) and usable(y, b) and a == b and len(x) == len(y):
            x_, y_ = np.array(x), np.array(y)
            if x_ @ y_ / np.sqrt(x_ @ x_) / np.sqrt(y_ @ y_) >= 0.93:
                links.append((i, j))
    degree, group = Counter(x for link in links for x in link), _groups([r[0] for r in rows], links)
    got = spherical_caps.near_vectors(df, block=16).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {r[0]: (degree[r[0]], group[r[0]], group[r[0]] == r[0]) for r in rows}
    assert spherical_caps.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("scale", [[1] * 32 + [0] * 32, [1 / (i + 1) for i in range(64)], [1] * 32 + [0.1] * 32, [1] * 3, [1] * 4, [1] * 12], ids=["padded", "decaying", "uneven", "d3", "d4", "d12"])
def test_near_vectors_of_any_shape(spark, scale):
    """Pairs at just over the cosine, found whatever coordinates hold the length."""
    rng, n, d = np.random.default_rng(7), 150, len(scale)
    x, y = (rng.standard_normal((n, d)) * scale for _ in "xy")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y = 0.9305 * x + math.sqrt(1 - 0.9305**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    both = np.concatenate((x, y))
    want = ((both @ both.T) >= 0.93).sum(axis=1) - 1
    assert want.min() >= 1
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(both)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in spherical_caps.near_vectors(df, block=64).collect()}
    assert got == dict(enumerate(want.tolist()))


@pytest.mark.parametrize("d", [4, 24])
def test_near_vectors_of_any_length(spark, tmp_path, d):
    """Finite vectors whose squares overflow or vanish link like others, in the query and in its SQL."""
    rng, rows = np.random.default_rng(8), []
    for group in range(6):
        base = rng.standard_normal(d)
        base /= np.abs(base).max()
        near, far = base + 0.02 * rng.standard_normal(d), rng.standard_normal(d)
        for x, size in ((base, 1.0), (near, 1e-200), (base, 1e305), (near, 1.5e308 / np.abs(near).max()), (base, 1e-300), (far / np.abs(far).max(), 1e305)):
            rows.append((len(rows), (x * size).tolist(), group))
    rows += [(len(rows), [0.0] * d, 0), (len(rows) + 1, [float("inf")] * d, 0), (len(rows) + 2, [None] * d, 0), (len(rows) + 3, None, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {tuple(r) for r in spherical_caps.op8_spherical_caps(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert got == set(con.execute(spherical_caps.OP8_SQL).fetchall())
    assert all(r[1] >= 4 for r in got if r[0] < 36 and r[0] % 6 != 5) and all(r[1] == 0 for r in got if r[0] >= 36)


def test_list_decoding_finds_all_directions():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((20, 9))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b, half = spherical_caps.product_code(9, 12)
    want = {(i, p * 12 + q) for i in range(20) for p in range(12) for q in range(12) if np.concatenate((a[p], b[q])) @ x[i] / np.sqrt(2) >= 1.5 / 3}
    row, direction = spherical_caps.directions(x, 12, 1.5, 0)
    assert set(zip(row.tolist(), direction.tolist(), strict=True)) == want
    row, direction = spherical_caps.directions(x, 12, 1.5, 9)
    scores = np.stack([np.concatenate((a[p], b[q])) for p in range(12) for q in range(12)]) @ x.T / np.sqrt(2)
    for i in range(20):
        best = set(np.argsort(-scores[:, i])[:9].tolist()) | {c for r, c in want if r == i}
        assert set(direction[row == i].tolist()) == best


# --- Katz ----------------------------------------------------------------------------------------------------------


def _katz(rows):
    tokens = [(i, [*WORD.findall((t or "").translate(LOWER)), "</s>"]) for i, t in rows]
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    c = Counter(x for (_, t), h in zip(tokens, held, strict=True) if not h for x in t)
    n, v = sum(c.values()), len(c)
    pairs = Counter(p for (_, t), h in zip(tokens, held, strict=True) if not h for p in itertools.pairwise(["</s>", *t]))
    of = Counter(pairs.values())
    d = katz.discounts([of[r] for r in range(1, katz.K + 2)])
    weight = lambda k: (d[k - 1] if k <= katz.K else 1) * k
    p1 = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    after = defaultdict(dict)
    for (h, w), k in pairs.items():
        after[h][w] = k
    divisor, alpha = {}, {}
    for h, ws in after.items():
        total, used = sum(ws.values()), sum(map(weight, ws.values()))
        divisor[h] = total if used < total else total + 1
        alpha[h] = (1 - used / divisor[h]) / (1 - sum(map(p1, ws)))

    def p(h, w):
        if h not in after:
            return p1(w)
        return weight(after[h][w]) / divisor[h] if w in after[h] else alpha[h] * p1(w)

    for h in list(after)[:50]:
        assert sum(p(h, w) for w in c) + alpha[h] * 0.1 / (n + 0.1 * (v + 1)) == pytest.approx(1, abs=1e-9)
    return [(i, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10(p1(w)) for w in t), sum(math.log10(p(a, b)) for a, b in itertools.pairwise(["</s>", *t])))
            for (i, t), h in zip(tokens, held, strict=True)]


@pytest.mark.parametrize("hot,block_bytes,bucket_rows", [(65_536, 16 << 20, 8192), (10, 2000, 10)])
def test_katz_scores(spark, odd_docs, monkeypatch, hot, block_bytes, bucket_rows):
    monkeypatch.setattr(katz, "HOT", hot)
    got = sorted((tuple(r) for r in katz.score(odd_docs, block_bytes, bucket_rows).collect()), key=str)
    want = sorted(_katz([(r.doc_id, r.text) for r in odd_docs.collect()]), key=str)
    assert [(g[0], g[2:5]) for g in got] == [(w[0], w[2:5]) for w in want] and [g[1] for g in got] == [w[1] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_katz_predicts_held_out_texts_better_than_words_alone(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    follows = {w: rng.sample(words, 3) for w in words}

    def text():
        w, out = rng.choice(words), []
        for _ in range(60):
            out.append(w)
            w = rng.choice(follows[w])
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")
    held = [r for r in katz.score(docs).collect() if r.held_out]
    assert len(held) > 10 and sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)


def test_katz_without_rows_or_training(spark, no_docs):
    assert katz.score(no_docs).collect() == []
    got = katz.score(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(True, 3, 0, 0, 0.0, 0.0)]


def test_columns_of_numbers_round_trip():
    arrays = [np.array([], np.int64), np.array([0, 255, 256, 2**40]), np.array([1.5, -2.0, 1e300]), np.array([2**63 - 1], np.uint64)]
    for a, b in zip(arrays, katz.unpack(katz.pack(*arrays)), strict=True):
        assert a.astype(b.dtype).tolist() == b.tolist()
