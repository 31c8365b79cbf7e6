"""Near-duplicate documents by SuperMinHash signatures, banding and verification.

A document's set holds the hashes of its word shingles. Its signature has
``SLOTS`` values. Every element of the set draws a random permutation of the slots,
one place a round: in round j it offers ``j + uniform`` to the j-th slot of its
permutation, and a slot keeps the smallest offer. Ranks of one element are
thus correlated, which lowers the variance against independent minima, and a
document stops after round j as soon as all its slots are below j + 1: later offers
can't be smaller. Long documents need one or two rounds.

Slots of two documents are equal with a chance of their Jaccard similarity.
``BANDS`` bands of ``ROWS`` slots make candidates (a pair at 0.8 is missed with a chance
of 4e-7), which are verified on the full sets.

Equal sets are one node from the start. A bucket's candidates are compared
with two pivots, the member u that shares most buckets and the next such
member w of u's pairs, so a group of n near copies costs 2 n pairs. Members that
are linked to neither may still be linked to each other or to other members;
two bounds leave few such pairs; pairs of one component need no look, and members
linked to one pivot are in one. Those linked to u and those linked to w may not be,
so a pair of one of each is treated like any other. Let c be the shingles of u and w
together, in three parts: of u only, of w only, of both. As a pair x, y shares at most
min(|x & part|, |y & part|) shingles within each part, it either

* reaches the needed overlap with these alone: a bound on known numbers, and
  only pairs that meet it are verified; or
* shares shingles outside c. By prefix filtering the two then share one of
  the first of these in a fixed order (as many as leave the needed overlap
  possible), so (u, shingle) are new, much smaller buckets, to which the same applies.

After ``PIVOT_ROUNDS`` such rounds the pairs of different components that are left in
a bucket, and that the bounds allow, are verified one by one. No pair in a bucket
is passed over. The shingle sets of candidates only are built again from their texts.

Edges: documents without words or text have no set, are linked with nothing
and are kept. Shorter documents than a shingle have one, their whole sequence of
words. Repeated rows fall in one node. A null doc_id never names a component
unless all its rows have none. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.components import components
from salesmart.llm.once import once
from salesmart.llm.words import slices, words
from salesmart.session import scratch_dir

ROWS = 4
BANDS = 28
SLOTS = ROWS * BANDS
SHINGLE = 5
PERCENT = 80
#: Rounds with pivots before the remaining pairs are verified.
PIVOT_ROUNDS = 1
#: Elements whose permutations are held at once.
_CHUNK = 200_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: A member's shingles in the pivots' sets: of u only, of w only, of both. And the most that two members share there.
_PARTS = ("of_u", "of_w", "of_both")
_WITHIN = f"({' + '.join(f'least({p}, o_{p})' for p in _PARTS)})"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): sorted distinct shingle hashes, those of row i at ``ends[i]:ends[i + 1]``."""
    w = words(column, lower=True)
    n_docs = len(w.rows) - 1
    if len(w.codes) == 0:
        return np.empty(0, np.uint64), np.zeros(n_docs + 1, np.int64)
    of_word = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in w.vocabulary.to_pylist()), np.uint64, len(w.vocabulary))[w.codes]
    n = len(of_word)
    with np.errstate(over="ignore"):
        whole = np.zeros(n, np.uint64)  # of up to k words from each place, as far as the row goes
        row_end = np.repeat(w.rows[1:], np.diff(w.rows))
        for j in range(k):
            at = np.arange(n) + j
            inside = at < row_end
            whole[inside] = mix(whole[inside] * np.uint64(0x100000001B3) + of_word[at[inside]] + np.uint64(j + 1) * _GOLD)
    counts = np.diff(w.rows)
    out, ends = [], np.zeros(n_docs + 1, np.int64)
    for i, (a, c) in enumerate(zip(w.rows[:-1].tolist(), counts.tolist(), strict=True)):
        got = np.unique(whole[a : a + max(1, c - k + 1)]) if c else whole[:0]
        out.append(got)
        ends[i + 1] = ends[i] + len(got)
    return np.concatenate(out), ends


def signatures(hashes: np.ndarray, ends: np.ndarray, slots: int) -> np.ndarray:
    """A row of ``slots`` values for each set; sets without elements hold infinity."""
    out = np.full((len(ends) - 1, slots), np.inf)
    first = 0
    while first < len(ends) - 1:  # documents of about _CHUNK elements at a time
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + _CHUNK, side="right")) - 1)
        _sign(hashes[ends[first] : ends[last]], np.diff(ends[first : last + 1]), out[first:last])
        first = last
    return out


def _draw(elements: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        x = mix(elements + np.uint64(j + 1) * _GOLD)
        y = mix(x + _GOLD)
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53, y >> np.uint64(1)


def _sign(elements: np.ndarray, counts: np.ndarray, out: np.ndarray) -> None:
    slots = out.shape[1]
    flat = out.reshape(-1)
    row = np.repeat(np.arange(len(counts)), counts)
    places = None
    swapped = None
    for j in range(slots):
        if len(elements) == 0:
            return
        offer, pick = _draw(elements, j)
        k = (j + pick % np.uint64(slots - j)).astype(np.int64)
        if j == 0:
            slot, swapped = k, k
        else:
            if places is None:
                places = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
                places[np.arange(len(elements)), swapped] = 0
            each = np.arange(len(elements))
            slot = places[each, k].astype(np.int64)
            places[each, k] = places[each, j]
        np.minimum.at(flat, row * slots + slot, j + offer)
        going = (out.max(axis=1) >= j + 1)[row]
        if not going.all():
            elements, row = elements[going], row[going]
            if places is None:
                swapped = swapped[going]
            else:
                places = places[going]


def _band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), -1, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bits.shape[1] + 1, dtype=np.uint64) * _GOLD, bits.shape[:2])
        for r in range(rows):
            key = mix(key * np.uint64(0x100000001B3) + bits[:, :, r])
    return key


def _sign_documents(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    """(doc_id, n_shingles, node, bands); node is a hash of the whole set, null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, ends = shingle_sets(batch.column("text"), k)
            counts = np.diff(ends)
            keys = _band_keys(signatures(hashes, ends, rows * bands), rows)
            node = np.fromiter((xxhash.xxh3_64_intdigest(hashes[a:b].tobytes()) for a, b in itertools.pairwise(ends.tolist())), np.uint64, len(counts)).astype(np.int64)
            some = counts > 0
            offsets = np.concatenate(([0], np.cumsum(some * bands)))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(node, pa.int64(), mask=~some),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[some].reshape(-1).astype(np.int64)))], ["doc_id", "n_shingles", "node", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, node long, bands array<long>")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, ends = shingle_sets(batch.column("text"), k)
            node = np.fromiter((xxhash.xxh3_64_intdigest(hashes[a:b].tobytes()) for a, b in itertools.pairwise(ends.tolist())), np.uint64, len(ends) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.astype(np.int64)))], ["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node long, shingles array<long>")


class _Store:
    """Tables in the shared folder: each is written once and read from there on."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("errorifexists").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (u, v)."""
    mine, other = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set")) for c in "uv")
    both = once(pairs.select("u", "v").join(other, "v").join(mine, "u"), common=F.size(F.array_intersect("u_set", "v_set")))
    return both.where(F.col("common") * (100 + percent) >= (F.size("u_set") + F.size("v_set")) * percent).select("u", "v")


def _tried(pairs: DataFrame, pivots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each pair (u, v) with u's second pivot w: whether v is linked to u and to w, and v's shingles inside (by part) and outside of both.

    ``outside`` is the prefix that a pair with enough overlap must share some of.
    """
    of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set"))
    both = pairs.select("u", "v").join(of("v"), "v").join(pivots.join(of("w"), "w").join(of("u"), "u"), "u")
    size, common = (lambda c: F.size(f"{c}_set")), (lambda c: F.size(F.array_intersect(f"{c}_set", "v_set")))
    both = once(both, in_u=common("u"), in_w=common("w"), beyond=F.array_except("v_set", F.array_union("u_set", "w_set")))
    linked = lambda c: F.col(f"in_{c}") * (100 + percent) >= (size(c) + size("v")) * percent
    both = both.select("u", "v", "w", size("v").alias("n_v"), (size("v") - F.size("beyond")).alias("inside"), "in_u", "in_w", linked("u").alias("with_u"), ((F.col("v") != F.col("w")) & linked("w")).alias("with_w"), F.sort_array("beyond").alias("beyond"))
    need = F.greatest(F.lit(1), F.ceil(F.col("n_v") * percent / 100).cast("int") - F.col("inside"))
    prefix = F.slice("beyond", F.lit(1), F.greatest(F.lit(0), F.col("n_v") - F.col("inside") - need + 1))
    parts = (F.expr(e).alias(p) for p, e in zip(_PARTS, ("inside - in_w", "inside - in_u", "in_u + in_w - inside"), strict=True))
    return both.select("u", "v", "w", "n_v", "inside", *parts, "with_u", "with_w", prefix.alias("outside"))


def _labels(links: DataFrame, store: _Store, name: str) -> DataFrame:
    return store(components(links, f"{store.folder}/{name}-rounds"), name)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS, pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    store = _Store(spark, scratch_dir(spark, "near-duplicates"))
    signed = store(_sign_documents(docs, shingle, rows, bands), "signed")
    nodes = store(signed.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "nodes")
    rows_ = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = rows_.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    members = store(rows_.join(shared, "bucket").select("bucket", "node"), "members0")

    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    by_id = _sets(texts.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), shingle)
    unnamed = wanted.where("rep IS NULL").select("node")  # sets that only rows without an id have
    by_node = _sets(texts.where("doc_id IS NULL"), shingle).join(unnamed, "node", "left_semi")
    sets = store(by_id.unionByName(by_node).dropDuplicates(["node"]), "sets")

    of_size = nodes.select("node", "n")
    links, label, turn = [], None, 0

    def link(found: DataFrame, name: str) -> None:
        nonlocal label
        if found.isEmpty():
            return
        links.append(found.select("u", "v"))
        label = _labels(functools.reduce(DataFrame.unionByName, links), store, name)

    def labelled(df: DataFrame, node: str, name: str) -> DataFrame:
        if label is None:
            return df.withColumn(name, F.col(node))
        of = label.select(F.col("node").alias(node), F.col("component").alias(name))
        return df.join(of, node, "left").withColumn(name, F.coalesce(name, node))

    while turn < pivot_rounds and not members.isEmpty():
        sizes = members.groupBy("bucket").agg(F.count("*").alias("c"))
        weight = members.join(sizes, "bucket").groupBy("node").agg(F.sum("c").alias("weight"))
        weighed = members.join(weight, "node")
        pivot = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("p")).select("bucket", F.col("p.node").alias("u"))
        pairs = store(weighed.join(pivot, "bucket").where("node <> u").select("u", F.col("node").alias("v"), "weight").distinct(), f"pairs{turn}")
        pivots = pairs.groupBy("u").agg(F.max(F.struct("weight", "v")).alias("p")).select("u", F.col("p.v").alias("w"))
        tried = store(_tried(pairs, pivots, sets, percent), f"tried{turn}")
        link(tried.where("with_u").select("u", "v").unionByName(tried.where("with_w").select(F.col("w").alias("u"), "v")), f"labels{turn}")
        # Pairs that can be linked by what they share inside the pivots' sets.
        here = labelled(tried.select("u", "v", "w", "n_v", "inside", *_PARTS), "v", "component")
        near = here.where(f"v <> w AND 100 * inside >= {percent} * n_v").drop("w", "inside")  # w has met all of u's pairs
        second = near.select("u", *[F.col(c).alias(f"o_{c}") for c in ("v", "n_v", *_PARTS, "component")])
        inside = (near.join(second, "u").where(f"v < o_v AND component <> o_component AND {_WITHIN} * {100 + percent} >= (n_v + o_n_v) * {percent}")
                  .select(F.col("v").alias("u"), F.col("o_v").alias("v")).distinct())
        link(store(_verified(inside, sets, percent), f"inside{turn}"), f"labels{turn}b")
        # Pairs that share shingles outside of them.
        here = labelled(tried.select("u", "v", "n_v", *_PARTS, "outside"), "v", "component")
        rows_ = here.select("u", F.col("v").alias("node"), "n_v", *_PARTS, "component", F.explode(F.transform("outside", lambda s: F.xxhash64("u", s))).alias("bucket"))
        shared = rows_.groupBy("bucket").agg(F.count("*").alias("c"), F.min("component").alias("a"), F.max("component").alias("b")).where("c > 1 AND a <> b")
        turn += 1
        members = store(rows_.join(shared.select("bucket"), "bucket", "left_semi").select("bucket", "node", "n_v", *_PARTS), f"members{turn}")
    if not members.isEmpty():
        if turn == 0:  # no pivots: nothing is known to lie inside
            members = members.join(of_size, "node").select("bucket", "node", F.col("n").alias("n_v"), *[F.lit(0).alias(p) for p in _PARTS])
        rest = labelled(members, "node", "component")
        other = rest.select("bucket", *[F.col(c).alias(f"o_{c}") for c in ("node", "n_v", *_PARTS, "component")])
        beyond = f"least(n_v - {' - '.join(_PARTS)}, o_n_v - {' - '.join(f'o_{p}' for p in _PARTS)})"
        pairs = (rest.join(other, "bucket").where(f"node < o_node AND component <> o_component AND ({_WITHIN} + {beyond}) * {100 + percent} >= (n_v + o_n_v) * {percent}")
                 .select(F.col("node").alias("u"), F.col("o_node").alias("v")).distinct())
        link(store(_verified(pairs, sets, percent), "rest"), "labels")

    component = nodes.select("node", "rep")
    component = labelled(component, "node", "component")
    smallest = component.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = component.select("node", "component").join(smallest, "component").select("node", "component_id")
    out = signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    id_ = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", id_.alias("component_id"), F.col("doc_id").eqNullSafe(id_).alias("kept"))


def op7_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their component by four-word shingles at 0.8."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), shingle=4)


OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], chr(10)) AS s FROM w, unnest(range(1, greatest(len(ws) - 2, 2))) AS r(i) WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
link AS (SELECT u, v FROM half UNION ALL SELECT v, u FROM half),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT link.v, reach.r FROM reach JOIN link ON link.u = reach.doc_id),
least_ AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM documents JOIN least_ USING (doc_id) LEFT JOIN sizes USING (doc_id)"""
