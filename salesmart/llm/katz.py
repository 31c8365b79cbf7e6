"""Language-model scores by Katz backoff over words and pairs of words.

Model. P1(w) = (c(w) + A) / (N + A (V + 1)) for the V training tokens and one unknown
word. P(w | h) = d_C * C(h, w) / c(h) for pairs seen in training, else alpha(h) * P1(w).
d_r are Good-Turing discounts (Katz's form, for counts up to ``K``); alpha(h) is the
mass that the discounts of h leave, divided by the P1 mass of the words not
seen after h: the probabilities after every history sum to 1. A text's first
word follows the boundary, and the boundary is predicted at its end.

Jobs. Texts are read once, in blocks of about ``BLOCK_BYTES``; a block holds its
tokens as numbers of its own distinct words. Then each level of the model is
counted and looked up in one exchange:

1. a block sends its distinct words with their training counts to buckets by
   word; a bucket adds them up, numbers the known words and answers each
   block with the numbers and counts of its words;
2. a block sends its distinct pairs (h, w) to buckets by h; a bucket adds the
   counts and answers with C(h, w) and what alpha(h) needs. The pairs of a
   frequent h (more than 1 / ``HOT`` of all tokens) are spread by (h, w), and the sums of h
   are added over its buckets; there are ``HOT`` such words at most.

The tables of the model are stored partitioned (words by bucket, pairs by
block and bucket), compressed as columns of numbers. A word that is a third of
all tokens is one entry a block. Nothing but totals, counts of counts and
sums of the frequent words reaches the driver. Tables go to the shared folder.

Edges: null and empty texts have only the end token; a null doc_id is held
out; repeated rows are learnt from and scored each; without training rows all
probabilities come from P1; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.superminhash import mix
from salesmart.llm.words import slices, words
from salesmart.session import scratch_dir

ADD = 0.1
K = 5
HOT = 65_536
BLOCK_BYTES = 16 << 20
#: Documents per bucket, to size the buckets.
BUCKET_ROWS = 8192
UNKNOWN, BOUNDARY, FIRST_WORD = 0, 1, 2
_ROWS = "kind string, block long, bucket int, payload binary"
_ANSWERS = "kind string, block long, bucket int, payload binary, stats array<double>, h long"


# --- columns of numbers as bytes -----------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers (none below 0) or doubles; by byte planes, each compressed."""
    press, out = zstandard.ZstdCompressor(level=1), [struct.pack("<I", len(arrays))]
    for a in arrays:
        a = np.asarray(a)
        if a.dtype.kind == "f":
            code, raw = 9, a.astype("<f8")
        else:
            top = int(a.max()) if len(a) else 0
            code = next(c for c in (1, 2, 4, 8) if top < 1 << (8 * c))
            raw = a.astype(f"<u{code}")
        planes = np.ascontiguousarray(raw.view(np.uint8).reshape(len(a), raw.dtype.itemsize).T)
        data = press.compress(planes.tobytes())
        out.append(struct.pack("<BQQ", code, len(a), len(data)) + data)
    return b"".join(out)


def unpack(payload: bytes) -> list[np.ndarray]:
    (count,), at, out, expand = struct.unpack_from("<I", payload), 4, [], zstandard.ZstdDecompressor()
    for _ in range(count):
        code, n, size = struct.unpack_from("<BQQ", payload, at)
        at += 17
        planes = np.frombuffer(expand.decompress(payload[at : at + size]), np.uint8)
        at += size
        kind = "<f8" if code == 9 else f"<u{code}"
        raw = np.ascontiguousarray(planes.reshape(-1, n).T).reshape(-1).view(kind) if n else np.empty(0, kind)
        out.append(raw.astype(np.float64) if code == 9 else raw.astype(np.int64))
    return out


def _row(kind: str, block: int, bucket: int, payload: bytes) -> dict:
    return {"kind": kind, "block": block, "bucket": bucket, "payload": payload}


# --- 1: blocks and their words -----------------------------------------------------------------------------


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


def _blocks(docs: DataFrame, buckets: int, block_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        for i, batch in enumerate(slices(batches, "text", block_bytes)):
            w = words(batch.column("text"), lower=True)
            n_words = len(w.vocabulary)
            order = np.argsort(-np.bincount(w.codes, minlength=n_words), kind="stable")  # numbers by frequency compress best
            number = np.empty(n_words, np.int64)
            number[order] = np.arange(1, n_words + 1)
            tokens = np.insert(number[w.codes], w.rows[1:], 0)  # 0: the boundary
            lengths = np.diff(w.rows) + 1
            ids = batch.column("doc_id").cast(pa.int64()).to_pylist()
            held = np.array([is_held_out(d) for d in ids], bool)
            counts = np.bincount(tokens[np.repeat(~held, lengths)], minlength=n_words + 1)[1:]
            vocabulary = w.vocabulary.take(pa.array(order))
            of_word = np.fromiter((xxhash.xxh3_64_intdigest(x) % buckets for x in vocabulary.to_pylist()), np.int64, n_words)
            rows = [_row("docs", first + i, 0, pack(np.array([0 if d is None else d for d in ids], np.int64).view(np.uint64), np.array([d is None for d in ids], np.int64), held.astype(np.int64), lengths, tokens, of_word))]
            for b in np.unique(of_word).tolist():
                at = np.flatnonzero(of_word == b)
                mine = vocabulary.take(pa.array(at))
                text = b"".join(mine.to_pylist())
                rows.append(_row("words", first + i, b, pack(np.asarray(pc.binary_length(mine)), np.frombuffer(text, np.uint8), counts[at])))
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("kind", pa.string()), ("block", pa.int64()), ("bucket", pa.int32()), ("payload", pa.binary())]))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _ROWS)


def _count_words(buckets: int):
    """A bucket of words: numbers for the known ones, an answer to each block, and (known words, their tokens)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        bucket, arrays, counts, sizes = int(pdf["bucket"].iloc[0]), [], [], []
        for payload in pdf["payload"]:
            lengths, text, count = unpack(payload)
            ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
            arrays.append(pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(text.astype(np.uint8))]))
            counts.append(count)
            sizes.append(len(lengths))
        codes = pa.concat_arrays(arrays).dictionary_encode().indices.to_numpy().astype(np.int64)
        total = np.bincount(codes, weights=np.concatenate(counts)).astype(np.int64)
        known = total > 0
        ids = np.where(known, FIRST_WORD + bucket + buckets * (np.cumsum(known) - 1), UNKNOWN)
        parts = np.split(codes, np.cumsum(sizes)[:-1])
        rows = [{**_row("word", int(b), bucket, pack(ids[c], total[c])), "stats": None, "h": None} for b, c in zip(pdf["block"], parts, strict=True)]
        rows.append({**_row("total", 0, bucket, b""), "stats": [float(known.sum()), float(total.sum())], "h": None})
        return pd.DataFrame(rows)

    return run


# --- 2: pairs ------------------------------------------------------------------------------------------------


class Base:
    """P1 and what else is the same for all blocks."""

    def __init__(self, words: int, tokens: int, documents: int, buckets: int):
        self.documents, self.buckets = documents, buckets
        self.n, self.v = tokens + documents, words + (documents > 0)
        self.hot_count = self.n / HOT

    def p1(self, count: np.ndarray) -> np.ndarray:
        return (count + ADD) / (self.n + ADD * (self.v + 1))


class _Block:
    """A block's tokens with the model's numbers, and its distinct pairs in the order in which they are asked for."""

    def __init__(self, base: Base, docs: bytes, answers: pd.DataFrame):
        ids, no_id, held, self.lengths, tokens, of_word = unpack(docs)
        self.ids, self.no_id, self.held = ids.view(np.int64), no_id.astype(bool), held.astype(bool)
        self.number, self.count = np.full(len(of_word) + 1, BOUNDARY), np.full(len(of_word) + 1, base.documents)
        for b, payload in zip(answers["bucket"], answers["payload"], strict=True):
            at = np.flatnonzero(of_word == b) + 1
            self.number[at], self.count[at] = unpack(payload)
        self.tokens = tokens
        before = np.concatenate(([0], tokens[:-1]))
        self.asked = np.flatnonzero(self.number[before] != UNKNOWN)  # tokens with a known history
        width = len(self.number)
        pairs, self.inverse = np.unique(before[self.asked] * width + tokens[self.asked], return_inverse=True)
        h, w = np.divmod(pairs, width)
        self.h, self.w = self.number[h], self.number[w]
        self.h_count, self.w_count = self.count[h], self.count[w]
        with np.errstate(over="ignore"):
            spread = mix(self.h.astype(np.uint64))
            self.hot = self.h_count > base.hot_count
            spread = np.where(self.hot, mix(spread + self.w.astype(np.uint64)), spread)
        self.bucket = (spread % np.uint64(base.buckets)).astype(np.int64)
        self.order = np.lexsort((self.w, self.h, self.bucket))
        self.edges = np.searchsorted(self.bucket[self.order], np.arange(base.buckets + 1))

    def training_counts(self) -> np.ndarray:
        training = np.repeat(~self.held, self.lengths)[self.asked]
        return np.bincount(self.inverse[training], minlength=len(self.h))


def _ask_pairs(base: Base):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(docs):
            b = _Block(base, docs["payload"].iloc[0], answers)
            counts = b.training_counts()
            for k in range(base.buckets):
                at = b.order[b.edges[k] : b.edges[k + 1]]
                if len(at):
                    h, runs = np.unique(b.h[at], return_counts=True)
                    w, first, place = np.unique(b.w[at], return_index=True, return_inverse=True)
                    hot = b.hot[at][np.cumsum(runs) - runs]
                    rows.append(_row("pairs", int(docs["block"].iloc[0]), k, pack(np.diff(h, prepend=0), runs, hot.astype(np.int64), np.diff(w, prepend=0), b.w_count[at][first], place, counts[at])))
        return pd.DataFrame(rows, columns=["kind", "block", "bucket", "payload"])

    return run


def _count_pairs(base: Base):
    """A bucket of pairs: an answer to each block, sums of frequent histories, and the counts of counts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        bucket, asked = int(pdf["bucket"].iloc[0]), [unpack(p) for p in pdf["payload"]]
        hs = [np.cumsum(a[0]) for a in asked]
        ws = [np.cumsum(a[3]) for a in asked]
        all_h, first_h = np.unique(np.concatenate(hs), return_index=True)
        all_w, first_w = np.unique(np.concatenate(ws), return_index=True)
        hot = np.concatenate([a[2] for a in asked])[first_h].astype(bool)
        p1 = base.p1(np.concatenate([a[4] for a in asked])[first_w])
        keys = [np.repeat(np.searchsorted(all_h, h), a[1]) * len(all_w) + np.searchsorted(all_w, w)[a[5]] for a, h, w in zip(asked, hs, ws, strict=True)]
        pairs, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([a[6] for a in asked])).astype(np.int64)
        seen = total > 0
        of_h, count = pairs[seen] // len(all_w), total[seen]
        sums = [np.bincount(of_h[count == r], minlength=len(all_h)) for r in range(1, K + 1)]
        sums.append(np.bincount(of_h[count > K], weights=count[count > K], minlength=len(all_h)))
        mass = np.bincount(of_h, weights=p1[pairs[seen] % len(all_w)], minlength=len(all_h))
        rows, parts = [], np.split(total[inverse], np.cumsum([len(k) for k in keys])[:-1])
        for block, h, mine in zip(pdf["block"], hs, parts, strict=True):
            at = np.searchsorted(all_h, h)
            rows.append({**_row("pair", int(block), bucket, pack(mine, *[s[at].astype(np.int64) for s in sums], mass[at])), "stats": None, "h": None})
        for k in np.flatnonzero(hot).tolist():
            rows.append({**_row("hot", 0, bucket, b""), "stats": [*(float(s[k]) for s in sums), float(mass[k])], "h": int(all_h[k])})
        rows.append({**_row("counts", 0, bucket, b""), "stats": [float((count == r).sum()) for r in range(1, K + 2)], "h": None})
        return pd.DataFrame(rows)

    return run


def discounts(counts: list[float]) -> np.ndarray:
    """d_1 ... d_K from the numbers of pairs seen 1 ... K + 1 times; half a count less where Good-Turing gives none between 0 and 1."""
    n, out = [0.0, *counts], []
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0.0
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return np.array(out)


def _after(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(divisor of counts, alpha) for histories: columns are n_1 ... n_K, tokens of larger counts, P1 mass seen."""
    r = np.arange(1, K + 1)
    total = sums[:, :K] @ r + sums[:, K]
    used = sums[:, :K] @ (r * d) + sums[:, K]
    divisor = np.where(used < total, total, total + 1)  # a history without discounts: as if one more token had followed it
    return divisor, (1 - used / np.maximum(divisor, 1)) / np.maximum(1 - sums[:, K + 1], 1e-300)


def _score(base: Base, d: np.ndarray, hot: dict[int, list[float]]):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(docs):
            return pd.DataFrame(columns=columns)
        b = _Block(base, docs["payload"].iloc[0], answers[answers["kind"] == "word"])
        log_p = np.empty(len(b.h))
        pairs = answers[answers["kind"] == "pair"]
        of_bucket = dict(zip(pairs["bucket"].astype(int), pairs["payload"], strict=True))
        for k in range(base.buckets):
            at = b.order[b.edges[k] : b.edges[k + 1]]
            if not len(at):
                continue
            count, *sums = unpack(of_bucket[k])
            h, place = np.unique(b.h[at], return_inverse=True)
            table = np.stack(sums, axis=1).astype(np.float64)
            for i in np.unique(place[b.hot[at]]).tolist():
                table[i] = hot[int(h[i])]
            divisor, alpha = _after(table, d)
            weight = np.where(count <= K, np.concatenate(([0.0], d))[np.minimum(count, K)], 1.0)
            with np.errstate(divide="ignore"):
                log_p[at] = np.where(count > 0, np.log10(weight * count / np.maximum(divisor[place], 1)), np.log10(alpha[place]) + np.log10(base.p1(b.w_count[at])))
        each_base = np.log10(base.p1(b.count[b.tokens] * (b.number[b.tokens] != UNKNOWN)))
        each = each_base.copy()
        each[b.asked] = log_p[b.inverse]
        row = np.repeat(np.arange(len(b.lengths)), b.lengths)
        add = lambda x: np.bincount(row, weights=x, minlength=len(b.lengths))
        out = pd.DataFrame({"doc_id": pd.array(b.ids, "Int64"), "held_out": b.held, "n_tokens": b.lengths, "n_known": add(b.count[b.tokens] > 0).astype(np.int64),
                            "train_tokens": base.n, "base_score": add(each_base), "score": add(each)}, columns=columns)
        out.loc[b.no_id, "doc_id"] = pd.NA
        return out

    return run


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for documents (doc_id, text)."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "katz")

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("errorifexists").partitionBy("kind").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    buckets = max(1, -(-docs.count() // bucket_rows))
    blocks = store(_blocks(docs, buckets, block_bytes), "blocks")
    texts = blocks.where("kind = 'docs'").select("block", "payload")
    of_words = store(blocks.where("kind = 'words'").groupBy("bucket").applyInPandas(_count_words(buckets), _ANSWERS), "words")
    known, tokens = of_words.where("kind = 'total'").agg(*[F.coalesce(F.sum(F.get("stats", F.lit(i))), F.lit(0.0)) for i in range(2)]).first()
    ids = F.col("doc_id").cast("long")
    held = F.coalesce(F.crc32(ids.cast("string")) % 10 == 0, F.lit(True))
    base = Base(int(known), int(tokens), docs.where(~held).count(), buckets)
    answers = of_words.where("kind = 'word'").select("kind", "block", "bucket", "payload")
    asked = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_ask_pairs(base), _ROWS)
    of_pairs = store(asked.groupBy("bucket").applyInPandas(_count_pairs(base), _ANSWERS), "pairs")
    counts = of_pairs.where("kind = 'counts'").agg(*[F.coalesce(F.sum(F.get("stats", F.lit(i))), F.lit(0.0)) for i in range(K + 1)]).first()
    # A history is frequent with more than 1 / HOT of all tokens, so HOT rows at most come to the driver.
    frequent = of_pairs.where("kind = 'hot'").groupBy("h").agg(*[F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(K + 2)]).collect()
    hot = {r["h"]: [r[f"s{i}"] for i in range(K + 2)] for r in frequent}
    both = answers.unionByName(of_pairs.where("kind = 'pair'").select("kind", "block", "bucket", "payload"))
    return texts.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(
        _score(base, discounts(list(counts)), hot), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their scores by the model of the documents that aren't held out."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
