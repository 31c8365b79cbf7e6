"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target of words by its weight, at most ``MAX_COPIES`` times
its size; what a capped source leaves is shared again by weight. A document
of a source whose target is f times its size is wanted f times. The whole
part is taken; the fraction is rounded so that the words taken stay the
words wanted: of two documents with fractions p, q and sizes s, t, words move
from one to the other at random until one fraction is 0 or 1, with chances
that leave each fraction's expectation as it is. s*p + t*q never changes, so a
source misses its target by the rounding of its last fraction at most.

Leaves of the reduction are groups of about ``LEAF_ROWS`` documents of a
source, dealt by a hash of the document, so a source with most of the rows
is spread like the others. A leaf ends with one fraction at most; ``FAN_IN``
such residuals meet in a node of the next level, until a source has one,
which is rounded by its chance. All random numbers come from hashes of the
leaf and the document, so reruns agree, however the rows are stored.

Edges: null or empty texts have size 0 and are taken once per whole wanted
copy (no words); null is a source like others, the last in order; equal rows
are rounded each on its own and may differ in copies, but which of them
differs can't be seen; an empty table gives no rows; extra columns pass.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import scratch_dir

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_COPIES = 2.0
LEAF_ROWS = 8192
FAN_IN = 64


def source_targets(sizes: dict, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES) -> dict:
    """The words wanted of each source: ``share`` of all words by weight, none above ``cap`` times its size.

    Sources in order of code points, null last, take the weights in turn.
    """
    names = sorted(sizes, key=lambda s: (s is None, [] if s is None else [ord(c) for c in s]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, free = share * sum(sizes.values()), {}, list(names)
    while free:
        left = total - sum(out.values())
        by_weight = left / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * by_weight > cap * sizes[s]]
        if not full:
            out.update((s, weight[s] * by_weight) for s in free)
            break
        out.update((s, cap * sizes[s]) for s in full)
        free = [s for s in free if s not in out]
    return {s: out[s] for s in names}


def pivotal(sizes: np.ndarray, fractions: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Fractions rounded to 0 or 1 but for one, whose place is returned (-1: none), with the weighted sum kept."""
    p = fractions.astype(np.float64).copy()
    held, eps, draws = -1, 1e-9, rng.random(len(p))
    for j in range(len(p)):
        if p[j] <= eps or p[j] >= 1 - eps:
            p[j] = round(p[j])
            continue
        if held < 0:
            held = j
            continue
        i, ratio = held, sizes[held] / sizes[j]
        up = min(1 - p[i], p[j] / ratio)  # what i may gain, and what it may lose to j
        down = min(p[i], (1 - p[j]) / ratio)
        if draws[j] * (up + down) < down:
            p[i], p[j] = p[i] + up, p[j] - up * ratio
        else:
            p[i], p[j] = p[i] - down, p[j] + down * ratio
        for k in (i, j):
            if p[k] <= eps or p[k] >= 1 - eps:
                p[k] = round(p[k])
        held = next((k for k in (i, j) if 0 < p[k] < 1), -1)
    return p, held


def _level(final: bool):
    """Rounds the fractions of a group; the last one stays, or at the root is rounded by its chance."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tie", "row"]).reset_index(drop=True)
        seed = [int(k) & 0x7FFFFFFF if k is not None else 0 for k in key[1:]] + [int(key[0]) & 0x7FFFFFFF, int(pdf["tie"].iloc[0]) & 0x7FFFFFFF]
        rng = np.random.default_rng(seed)
        p, held = pivotal(pdf["size"].to_numpy(np.float64), pdf["p"].to_numpy(np.float64), rng)
        if final and held >= 0:
            p[held] = float(rng.random() < p[held])
        return pdf.assign(p=p)[["row", "tie", "source_no", "leaf", "size", "p"]]

    return run


_PART = "row long, tie long, source_no int, leaf long, size long, p double"
WORD = r"[^\x20\x09-\x0D]+"


def with_sizes(docs: DataFrame) -> DataFrame:
    """The words of each text."""
    return docs.withColumn("__size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def copies(rows: DataFrame, folder: str, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES,
           leaf_rows: int = LEAF_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """(row, copies, source_size, target) of rows (row unique, tie a hash that does not depend on storage, source, size).

    The sums by source come to the driver: a number per source, of which there are few.
    """
    spark = rows.sparkSession
    sizes = {r["source"]: (int(r["size"]), int(r["rows"])) for r in rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()}
    if not sizes:
        return spark.createDataFrame([], "row long, copies long, source_size long, target double")
    targets = source_targets({s: n for s, (n, _) in sizes.items()}, weights, share, cap)
    names = list(targets)
    table = spark.createDataFrame(
        [(i, s, sizes[s][0], float(targets[s]), targets[s] / sizes[s][0] if sizes[s][0] else 0.0, max(1, math.ceil(sizes[s][1] / leaf_rows))) for i, s in enumerate(names)],
        "source_no int, source string, source_size long, target double, wanted double, leaves int")
    # A row per source: the number of sources bounds it, and it was just collected.
    wanted = (rows.join(F.broadcast(table), rows["source"].eqNullSafe(table["source"])).drop(table["source"])
              .select("row", "tie", "source_no", "size", "source_size", "target", F.floor("wanted").cast("long").alias("whole"),
                      (F.col("wanted") - F.floor("wanted")).alias("p"), F.pmod("tie", F.col("leaves")).cast("long").alias("leaf")))
    open_ = wanted.where("size > 0 AND p > 0").select("row", "tie", "source_no", "leaf", "size", "p")
    leaves, level, rounded = max(max(1, math.ceil(n / leaf_rows)) for _, n in sizes.values()), 0, []
    while True:
        final = leaves == 1
        now = open_.groupBy("source_no", "leaf").applyInPandas(_level(final), _PART)
        now.write.mode("errorifexists").parquet(f"{folder}/level{level}")
        now = spark.read.schema(_PART).parquet(f"{folder}/level{level}")
        rounded.append(now.where("p = 0 OR p = 1").select("row", "p"))
        if final:
            break
        leaves, level = -(-leaves // fan_in), level + 1
        open_ = now.where("p > 0 AND p < 1").withColumn("leaf", F.floor(F.col("leaf") / fan_in).cast("long"))
    ones = rounded[0]
    for r in rounded[1:]:
        ones = ones.unionByName(r)
    ones = ones.where("p = 1").select(F.col("row").alias("__one"))
    return (wanted.join(ones, wanted["row"] == ones["__one"], "left")
            .select("row", (F.col("whole") + F.col("__one").isNotNull().cast("long")).alias("copies"), "source_size", "target"))


def _rows(docs: DataFrame, folder: str, carried: list[str]) -> DataFrame:
    """(row, tie, source, size, doc), written once, so that row numbers hold; doc holds the carried columns."""
    numbered = with_sizes(docs).select(
        F.monotonically_increasing_id().alias("row"), F.xxhash64("doc_id", "source", "__size").alias("tie"),
        F.col("source").cast("string").alias("source"), F.col("__size").alias("size"), F.struct(*[F.col(f"`{c}`") for c in carried]).alias("doc"))
    numbered.write.mode("errorifexists").parquet(f"{folder}/rows")
    return docs.sparkSession.read.schema(numbered.schema).parquet(f"{folder}/rows")


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of documents (doc_id, source, text)."""
    folder = scratch_dir(docs.sparkSession, "mixing")
    rows = _rows(docs, folder, ["doc_id"])
    return (rows.join(copies(rows.select("row", "tie", "source", "size"), folder, **options), "row")
            .select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"))


def take(docs: DataFrame, folder: str, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` (doc_id, source, text and others), each as often as it is taken."""
    rows = _rows(docs, folder, docs.columns)
    wanted = copies(rows.select("row", "tie", "source", "size"), folder, **options).where("copies > 0").select("row", "copies")
    repeated = rows.select("row", "doc").join(wanted, "row").select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("again"))
    return repeated.select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words the mix takes of each."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))
