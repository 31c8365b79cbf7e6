"""Near-duplicate embeddings by spherical-cap filters.

Filter directions are a structured random product code: the dimensions are cut
in two parts, each part has ``CODE`` random unit vectors, and every pair of
them is one direction, ``CODE`` squared in all. A vector belongs to all
directions whose inner product with it is at least ``Z / sqrt(d)``, and to its
``LEAST`` best in any case. They are list-decoded: inner products with the two
small codes are taken, and only code vectors of the first part that can still
reach the bound with the best of the second are combined with it. Vectors are first
turned by a random orthogonal matrix of their dimensions, so both parts weigh
alike also where a few coordinates hold most of the length (padding, decay). Of pairs
with a cosine of just 0.93, less than one in a thousand shares no direction
(from 12 dimensions on; closer pairs share more). Vectors of fewer than ``FULL``
dimensions, where the code has too few different directions, have all one direction:
every two of a label are compared, which grows with the square of their number.

Rows are joined on (label, dimensions, direction). They carry the vector in
bytes, with the length of the rounding error, so that no pair at the limit is
passed over; pairs that may reach it are then verified on the vectors in
double precision. A direction's rows are cut in blocks of about ``BLOCK`` by their
counts, and pairs of blocks are compared by one matrix product, so a task
holds two blocks however many vectors share a direction. Equal vectors
are one node from the start and never expanded; a link of two nodes counts for
all their copies.

Edges: vectors that are null, empty, zero or hold a null or non-finite component, and
those without a label, link with nothing, also not with copies; each is its own component.
Vectors of different lengths never link. Very large and very small components count: vectors
are first scaled by the power of two of their largest. Repeated rows are copies. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.components import components
from salesmart.session import scratch_dir

COSINE = 0.93
CODE = 128
Z = 3.0
LEAST = 48
BLOCK = 1024
SEED = 20240229
#: Vectors of fewer dimensions are compared in full.
FULL = 12
_PAIR = "u long, v long"


@lru_cache(maxsize=8)
def product_code(d: int, code: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The two parts' random unit vectors, and where the second part begins."""
    rng, half = np.random.default_rng([SEED, d]), (d + 1) // 2
    parts = []
    for size in (half, d - half):
        x = rng.standard_normal((code, max(size, 1)))
        parts.append(x / np.linalg.norm(x, axis=1, keepdims=True) if size else np.zeros((code, 0)))
    return parts[0], parts[1], half


@lru_cache(maxsize=2)
def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, d, 1]).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def directions(unit: np.ndarray, code: int = CODE, z: float = Z, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction) of all directions within the cap of each row of unit vectors, and of its ``least`` best, sorted by row."""
    a, b, half = product_code(unit.shape[1], code)
    limit = z / math.sqrt(unit.shape[1]) * math.sqrt(2)  # a direction is (x, y) / sqrt 2
    first, second = unit[:, :half] @ a.T, unit[:, half:] @ b.T
    low = np.full(len(unit), limit)
    if least:  # the least-th best sum of some good code vectors is no more than that of all
        k = min(code, 16)
        some = (np.partition(first, -k, axis=1)[:, -k:, None] + np.partition(second, -k, axis=1)[:, None, -k:]).reshape(len(unit), -1)
        low = np.minimum(low, np.partition(some, -min(least, k * k), axis=1)[:, -min(least, k * k)])
    row, x = np.nonzero(first + second.max(axis=1, keepdims=True) >= low[:, None])
    at, y = np.nonzero(first[row, x][:, None] + second[row] >= low[row][:, None])
    row, x = row[at], x[at]
    score = first[row, x] + second[row, y]
    order = np.lexsort((-score, row))
    row, direction, score = row[order], (x * code + y)[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = (rank < least) | (score >= limit)
    return row[keep], direction[keep]


def _unit_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, unit vectors) by length of vector."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths())
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        x = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), d)
        x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])  # exact; no square overflows or vanishes
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


def _filters(nodes: DataFrame, code: int, z: float, least: int) -> DataFrame:
    """(label, d, direction, node, vector, step, error) for each node and direction.

    ``step * vector`` (signed bytes) is the unit vector but for an error of length ``error``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                batch = whole.slice(i, 1024)
                for at, unit in _unit_rows(batch.column("embedding")):
                    d = unit.shape[1]
                    row, cap = (np.arange(len(unit)), np.zeros(len(unit), np.int64)) if d < FULL else directions(unit @ rotation(d), code, z, least)
                    step = np.abs(unit).max(axis=1) / 127
                    small = np.round(unit / step[:, None]).astype(np.int8)
                    error = np.linalg.norm(unit - small * step[:, None], axis=1)
                    rows = pa.array(at[row])
                    vectors = pa.array([v.tobytes() for v in small], pa.binary()).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([batch.column("label").take(rows), pa.array(np.full(len(row), d), pa.int32()), pa.array(cap, pa.int32()),
                                                      batch.column("node").take(rows), vectors, pa.array(step[row]), pa.array(error[row])],
                                                     ["label", "d", "direction", "node", "vector", "step", "error"])

    return nodes.select("label", "embedding", "node").mapInArrow(run, "label int, d int, direction int, node long, vector binary, step double, error double")


def _compare(cosine: float):
    """Pairs that may reach the cosine, within each run of rows of one (label, d, direction, i, j); rows must be sorted by these."""
    keys = ["label", "d", "direction", "i", "j"]

    def pairs(group: pa.Table) -> Iterator[pa.RecordBatch]:
        side, node, step, error = (group.column(c).to_numpy() for c in ("side", "node", "step", "error"))
        d, i, j = (group.column(c)[0].as_py() for c in ("d", "i", "j"))
        x = np.frombuffer(b"".join(group.column("vector").to_pylist()), np.int8).reshape(-1, d) * step[:, None]
        left = np.flatnonzero(side == 0)
        right = left if i == j else np.flatnonzero(side == 1)
        slack = error[left][:, None] + error[right] + error[left][:, None] * error[right] + 1e-9
        a, b = np.nonzero(x[left] @ x[right].T + slack >= cosine)
        if i == j:
            a, b = a[a < b], b[a < b]
        if len(a):
            u, v = node[left[a]], node[right[b]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            code = np.stack([table.column(k).to_numpy() for k in keys], axis=1)
            starts = np.concatenate(([0], np.flatnonzero((code[1:] != code[:-1]).any(axis=1)) + 1, [len(code)]))
            for p, q in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                key = tuple(code[p])
                if held and key != last:
                    yield from pairs(pa.concat_tables(held).combine_chunks())
                    held = []
                last = key
                held.append(table.slice(p, q - p))
        if held:
            yield from pairs(pa.concat_tables(held).combine_chunks())

    return run


def _verified(pairs: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """(u, v, n_u, n_v) of the pairs whose cosine, in double precision, reaches the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x, y = (np.empty(batch.num_rows, object) for _ in "xy")
            for out, name in ((x, "e_u"), (y, "e_v")):
                for at, unit in _unit_rows(batch.column(name)):
                    for i, row in zip(at.tolist(), unit, strict=True):
                        out[i] = row
            yield batch.select(["u", "v", "n_u", "n_v"]).filter(pa.array([float(a @ b) >= cosine for a, b in zip(x, y, strict=True)]))

    mine, other = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("embedding").alias(f"e_{c}")) for c in "uv")
    both = pairs.join(mine, "u").join(other, "v").select("u", "v", "n_u", "n_v", "e_u", "e_v")
    return both.mapInArrow(run, "u long, v long, n_u long, n_v long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, code: int = CODE, z: float = Z, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    folder = scratch_dir(spark, "near-vectors")
    store = lambda df, name: (df.write.mode("errorifexists").parquet(f"{folder}/{name}"), spark.read.schema(df.schema).parquet(f"{folder}/{name}"))[1]
    df = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("int").alias("label"))
    usable = (F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    exact = F.transform("embedding", lambda x: x + F.lit(0.0))  # -0.0 is 0.0
    df = df.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", exact)))
    nodes = store(df.where("node IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("n"), F.min("vec_id").alias("rep")), "nodes")
    filters = store(_filters(nodes, code, z, least), "filters")
    sizes = filters.groupBy("label", "d", "direction").agg(F.count("*").alias("size")).where("size > 1").withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).drop("size")
    own = F.pmod(F.xxhash64("node", "direction"), F.col("blocks")).cast("int")
    dealt = filters.join(sizes, ["label", "d", "direction"]).withColumn("own", own)
    # A row meets every block once: as the left side of those from its own on, as the right side of those before.
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("label", "d", "direction", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "vector", "step", "error")
    keys = ["label", "d", "direction", "i", "j"]
    pairs = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compare(cosine), _PAIR).distinct()
    links = store(_verified(pairs, nodes, cosine), "links")

    both = links.select("u", "n_v").unionByName(links.select(F.col("v").alias("u"), F.col("n_u").alias("n_v")))
    degree = both.groupBy("u").agg(F.sum("n_v").alias("others"))
    label = store(components(links.select("u", "v"), f"{folder}/rounds"), "components")
    named = nodes.select("node", "n", "rep").join(label, "node", "left").select("node", "n", "rep", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "component").join(degree, named["node"] == degree["u"], "left").select("node", "component_id", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"))
    out = df.select("vec_id", "node").join(named, "node", "left")
    id_ = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), id_.alias("component_id"), F.col("vec_id").eqNullSafe(id_).alias("kept"))


def op8_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings with their links and component within the label."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


OP8_SQL = f"""
WITH RECURSIVE raw AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
top AS (SELECT vec_id, label, e, list_max(list_transform(e, lambda x: abs(x))) AS m FROM raw),
v AS (SELECT vec_id, label, CASE WHEN m > 0 AND isfinite(m) AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      THEN list_transform(e, lambda x: x / pow(2::DOUBLE, floor(log2(CASE WHEN m > 0 AND isfinite(m) THEN m ELSE 1::DOUBLE END)))) END AS e FROM top),
ok AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE label IS NOT NULL AND e IS NOT NULL),
link AS (SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
         WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {COSINE}),
reach(vec_id, r) AS (SELECT vec_id, vec_id FROM ok UNION SELECT link.w, reach.r FROM reach JOIN link ON link.u = reach.vec_id),
least_ AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
deg AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT v.vec_id, coalesce(deg.n, 0) AS n_links, coalesce(component_id, v.vec_id) AS component_id, coalesce(component_id, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN least_ USING (vec_id) LEFT JOIN deg ON deg.u = v.vec_id"""
