"""Hard negatives by Fagin's threshold algorithm over integer vectors.

An anchor's score for a row is the inner product of their vectors of whole numbers. Its
positives are the first rows of its own label; a negative for a positive is a
row of another label whose score lies in the window from ``LOW`` % of the
positive's score up to that score. Higher scores come first, then smaller ids.

Method. A cell holds some anchors and some candidates, and for each dimension the
candidates sorted by that component. An anchor reads the lists side by side, from
the large end where its own component is positive and from the small end where it is
negative (sorted access). Rows seen for the first time are scored in whole
numbers (random access). All rows not yet seen score at most the threshold, the sum of
the anchor's components times the values the lists have come to. The anchor is done once the
threshold is strictly below the kth score of each of its windows (the window's lower bound
while it holds fewer than k rows; strictly, since equal scores may have smaller ids), or every
row was seen. Lists are read to depths that double.

Jobs. The rows with their whole numbers are stored in the shared folder. Every anchor meets every
candidate in one cell of a grid, groups of anchors times chunks of candidates, both with
a bound on their values. A first job finds the positives (chunks of the rows of a label, as
many as the label needs), a second the negatives (chunks of all rows). A cell gives at most k rows
for a window; these are merged by (anchor, window), of which Spark keeps k a task before the
exchange. The work grows with anchors times rows, as that of any exact query set against
all rows may; no row is skipped but by the threshold.

Edges: rows with a null id, label or vector, or a null or non-finite component (also one that
overflows when scaled), take no part. Shorter vectors count as ending in zeros; empty ones score
0. Scores are exact at any size of the components and then taken as the nearest long. Repeated rows
are rows each, but rows with the anchor's own id are not its positives. Windows of positives below
zero are empty. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.session import scratch_dir

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
#: Values (rows times dimensions) of a chunk of candidates and of a group of anchors, about.
CHUNK_VALUES = 2 << 20
GROUP_VALUES = 1 << 19
_LONG = (-(2**63), 2**63 - 1)
_ROWS = "uid long, vec_id long, label long, vector array<double>, anchor boolean"
_POSITIVES = "uid long, slot long, positive_id long, positive_score long"
_FOUND = "uid long, slot long, id long, row_uid long, score long"


# --- the threshold algorithm ---------------------------------------------------------------------------------


@dataclass
class Rows:
    """Rows of a cell; ``uid`` tells rows with equal ids apart, ``vectors`` are whole numbers as doubles."""

    uid: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def of(pdf: pd.DataFrame) -> Rows:
        vectors = list(pdf["vector"])
        lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
        x = np.zeros((len(vectors), int(lengths.max(initial=0))))
        x[np.arange(x.shape[1]) < lengths[:, None]] = np.concatenate([*vectors, np.empty(0)])
        return Rows(*(pdf[c].to_numpy(np.int64) for c in ("uid", "vec_id", "label")), x)

    def __len__(self) -> int:
        return len(self.ids)


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with zeros up to the same width, as the narrowest type in which all sums of their products are exact."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, width)
    if bound < 2**53:
        kind = np.float32 if bound < 2**24 else np.float64
        return a.astype(kind), b.astype(kind)
    return tuple(np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape) for x in (a, b))


def _longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([min(max(s, _LONG[0]), _LONG[1]) for s in scores.tolist()], np.int64)


class Lists:
    """The candidates of a cell, sorted by each component, and the anchors' vectors."""

    def __init__(self, rows: Rows, anchors: Rows):
        self.vectors, self.anchors = _exact(rows.vectors, anchors.vectors)
        self.up = np.argsort(self.vectors, axis=0, kind="stable").T  # a list of places for each dimension, from the small end
        self.values = np.take_along_axis(self.vectors.T, self.up, axis=1)
        width = len(self.up)
        self.side = (self.anchors >= 0) * width + np.arange(width)  # the lists that an anchor reads

    def seen(self, depth: int) -> np.ndarray:
        """Bits of the rows among the first ``depth`` of each list: from the small ends, then from the large ends."""
        bits = np.zeros((2, *self.up.shape), bool)
        np.put_along_axis(bits[0], self.up[:, :depth], True, axis=1)
        np.put_along_axis(bits[1], self.up[:, self.up.shape[1] - depth :], True, axis=1)
        return np.packbits(bits, axis=2).reshape(2 * len(self.up), -1)

    def thresholds(self, depth: int, some: np.ndarray) -> np.ndarray:
        """The most that a row can score that is in none of the first ``depth`` of some anchors' lists."""
        a, low, high = self.anchors[some], self.values[:, depth - 1], self.values[:, self.values.shape[1] - depth]
        return _longs(np.where(a < 0, a, 0) @ low + np.where(a < 0, 0, a) @ high)


@dataclass
class Best:
    """The rows found so far that some window of an anchor may keep, best first."""

    scores: np.ndarray
    places: np.ndarray


def _in_window(scores: np.ndarray, low: int, high: int, k: int) -> slice:
    """The first k of descending scores from high down to low."""
    n = len(scores)
    first = n - int(np.searchsorted(scores[::-1], high, side="right"))
    return slice(first, min(first + k, max(first, n - int(np.searchsorted(scores[::-1], low, side="left")))))


def threshold_top(rows: Rows, anchors: Rows, windows: list[list[tuple[int, int]]], k: int, same: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor, window, places of rows, scores) of the first k rows of each window (low, high) of each anchor.

    Only rows of the anchor's label but not of its id count if ``same``, else only rows of other labels.
    """
    n = len(rows)
    if n == 0:
        return
    lists = Lists(rows, anchors)
    best = [Best(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    done = np.zeros((len(windows), -(-n // 8)), np.uint8)
    left = np.array([i for i, w in enumerate(windows) if w], np.int64)
    depth = min(n, max(8, n // 512)) if len(lists.up) else n
    while len(left):
        bits = lists.seen(depth) if depth < n else np.packbits(np.ones((2 * max(1, len(lists.up)), n), bool), axis=1)
        limits = lists.thresholds(depth, left) if depth < n else np.full(len(left), _LONG[0])
        after = []
        for i, limit in zip(left.tolist(), limits.tolist(), strict=True):
            now = np.bitwise_or.reduce(bits[lists.side[i]] if len(lists.up) else bits, axis=0)
            new = np.flatnonzero(np.unpackbits(now & ~done[i], count=n))
            done[i] = now
            new = new[(rows.labels[new] == anchors.labels[i]) & (rows.ids[new] != anchors.ids[i]) if same else rows.labels[new] != anchors.labels[i]]
            scores = _longs(lists.vectors[new] @ lists.anchors[i])
            fits = (scores >= min(low for low, _ in windows[i])) & (scores <= max(high for _, high in windows[i]))
            scores, places = np.concatenate((best[i].scores, scores[fits])), np.concatenate((best[i].places, new[fits]))
            order = np.lexsort((rows.uid[places], rows.ids[places], ~scores))  # -scores overflows at the least long
            scores, places = scores[order], places[order]
            parts = [_in_window(scores, low, high, k) for low, high in windows[i]]
            kept = np.zeros(len(scores), bool)
            for part in parts:
                kept[part] = True
            kth = [int(scores[part.stop - 1]) if part.stop - part.start == k else low for part, (low, _) in zip(parts, windows[i], strict=True)]
            best[i] = Best(scores[kept], places[kept])
            if depth < n and limit >= min(kth) and not np.unpackbits(now, count=n).all():
                after.append(i)
        left = np.array(after, np.int64)
        depth = min(n, 2 * depth)
    for i, found in enumerate(best):
        for j, (low, high) in enumerate(windows[i]):
            part = _in_window(found.scores, low, high, k)
            yield i, j, found.places[part], found.scores[part]


def window_of(positive: int) -> tuple[int, int]:
    """The scores s with LOW * positive <= 100 * s <= HIGH * positive."""
    return -(-LOW * positive // 100), HIGH * positive // 100


# --- jobs --------------------------------------------------------------------------------------------------------


def _cell(left: pd.DataFrame, right: pd.DataFrame, slots: list[list[tuple[int, tuple[int, int]]]], k: int, same: bool) -> pd.DataFrame:
    """What a cell finds; ``slots`` are the (number, window) of each anchor."""
    out = []
    if len(left) and len(right):
        anchors, rows = Rows.of(left), Rows.of(right)
        windows = [[window for _, window in some] for some in slots]
        for i, j, places, scores in threshold_top(rows, anchors, windows, k, same):
            out += [(anchors.uid[i], slots[i][j][0], rows.ids[p], rows.uid[p], s) for p, s in zip(places.tolist(), scores.tolist(), strict=True)]
    return pd.DataFrame(out, columns=[c.split()[0] for c in _FOUND.split(", ")]).astype("int64")


def _find_positives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    return _cell(left, right, [[(0, _LONG)]] * len(left), POSITIVES, same=True)


def _find_negatives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    asked = [[(int(p["slot"]), window_of(int(p["positive_score"]))) for p in some] for some in left.get("windows", [])]
    return _cell(left, right, [[(slot, (low, high)) for slot, (low, high) in some if low <= high] for some in asked], NEGATIVES, same=False)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each anchor's window, ranked."""
    best = Window.partitionBy("uid", "slot").orderBy(F.col("score").desc(), "id", "row_uid")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _part(parts: Column | int) -> Column:
    return F.pmod(F.xxhash64("uid"), F.lit(parts) if isinstance(parts, int) else parts).cast("long")


def _each(parts: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), (F.lit(parts) if isinstance(parts, int) else parts).cast("long") - 1))


def _stored(df: DataFrame, path: str, schema: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def hard_negatives(rows: DataFrame, chunk_values: int = CHUNK_VALUES, group_values: int = GROUP_VALUES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank) for each anchor of
    ``rows`` (vec_id, label, vector, anchor: boolean)."""
    spark = rows.sparkSession
    folder = scratch_dir(spark, "hard-negatives")
    numbers = F.transform(F.col("vector").cast("array<double>"), lambda x: x * SCALE)
    valid = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), numbers.alias("vector"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = valid.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(~odd)
    # floor() of Spark gives a long, which large components don't fit; those have no fraction
    floor = F.transform("vector", lambda x: F.when(F.abs(x) < 2.0**62, F.floor(x).cast("double")).otherwise(x))
    table = _stored(valid.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", floor.alias("vector"), "anchor"), f"{folder}/rows", _ROWS)
    size = table.agg(F.count("*").alias("rows"), F.count(F.when(F.col("anchor"), 1)).alias("anchors"), F.max(F.size("vector")).alias("width")).first()
    width = max(1, size["width"] or 1)
    chunk, group = max(1, chunk_values // width), max(1, group_values // width)
    chunks, groups = max(spark.sparkContext.defaultParallelism, -(-size["rows"] // chunk)), max(1, -(-size["anchors"] // group))

    def side() -> tuple[DataFrame, DataFrame]:
        """The stored rows, and the chunks that each label needs; read anew for each side of a cogroup, whose columns Spark must tell apart."""
        rows = spark.read.schema(_ROWS).parquet(f"{folder}/rows")
        return rows, rows.groupBy("label").agg(F.ceil(F.count("*") / chunk).alias("chunks"))

    (anchors, of_anchor), (candidates, of_candidate) = side(), side()
    anchors = anchors.where("anchor").select("uid", "vec_id", "label", "vector", _part(groups).alias("g"))
    candidates = candidates.select("uid", "vec_id", "label", "vector").withColumn("g", _each(groups))
    left = anchors.join(of_anchor, "label").withColumn("c", _each(F.col("chunks"))).groupBy("label", "g", "c")
    right = candidates.join(of_candidate, "label").withColumn("c", _part(F.col("chunks"))).groupBy("label", "g", "c")
    found = left.cogroup(right).applyInPandas(_find_positives, _FOUND)
    positives = _stored(_merged(found, POSITIVES).select("uid", F.col("rank").cast("long").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                        f"{folder}/positives", _POSITIVES)

    windows = positives.groupBy("uid").agg(F.collect_list(F.struct("slot", "positive_score")).alias("windows"))
    asked = anchors.join(windows, "uid").withColumn("c", _each(chunks))
    found = asked.groupBy("g", "c").cogroup(candidates.withColumn("c", _part(chunks)).groupBy("g", "c")).applyInPandas(_find_negatives, _FOUND)
    named = _merged(found, NEGATIVES).join(positives, ["uid", "slot"]).join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
    return named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), F.col("slot").cast("int").alias("positive_rank"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of all anchors of ``embeddings`` among all its rows."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), F.col("embedding").alias("vector"), (F.col("vec_id") % 100 == 0).alias("anchor"))).drop("positive_rank")


OP12_SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= {NEGATIVES}"""
