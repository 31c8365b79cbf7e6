"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Pieces longer than a sequence are cut before; a piece that fills a sequence
alone is a sequence. The others are dealt by a hash to blocks of about
``BLOCK_ROWS`` pieces. Each block is packed by several islands. An island
holds a small population of whole packings of the block's pieces and evolves
it:

* crossover injects whole well-filled bins of one parent into the other,
  removes the bins that hold one of their pieces, and puts the pieces that
  lose their bin back: first in exchange for a shorter member of a bin that they
  fill better, then by best fit, longest first;
* mutation empties some of the least filled bins and puts their pieces back
  likewise;
* the worse half of the population gives way to better children.

Between epochs each island's best packing moves to the next island of the
block (a shuffle of small rows by block and island). A better packing has fewer
bins or, with as many, its free space in fewer of them. A block is done when it
needs no more bins than its tokens fill at least and all of them but one are full.

Every block leaves some badly filled bins. The worst of them, an eighth of a
block's bins or two at most, are emptied and their pieces are dealt to new, fewer
blocks, and so on until one block is left: a tree of log(pieces) levels, in which
no task and never the driver sees more than a block. Blocks have ``BLOCK_ROWS``
pieces, or more where these fill less than ``BLOCK_BINS`` sequences, so each level
has at most about a quarter of the tokens of the one before.

Edges: empty or null texts are pieces of their end id; repeated rows are
packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.tokens import encoder, tokenizer_path
from salesmart.llm.words import slices
from salesmart.session import scratch_dir

CAPACITY = 4096
BLOCK_ROWS = 2000
BLOCK_BINS = 16
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
CHILDREN = 8
#: Bins filled less than this may be emptied into the next level, the worst ``1 / TAIL_SHARE`` of a block's bins at most.
TAIL_FILL = 0.999
TAIL_SHARE = 8

_ISLAND = "block long, island int, row_ids binary, lengths binary, population array<binary>, n_bins int, unevenness double, done boolean"


# --- one packing of a block: for each piece the number of its bin -------------------------------------


class Bins:
    """Bins under construction: members, free space, and the open bins sorted by free space."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.members: list[list[int]] = []
        self.order: list[tuple[int, int]] = []  # (free space, bin)

    def add_bin(self, members: list[int]) -> None:
        free = self.capacity - sum(self.lengths[i] for i in members)
        if free > 0:
            insort(self.order, (free, len(self.members)))
        self.members.append(members)

    def best_fit(self, items: list[int]) -> None:
        """Puts the items, longest first, where the least space stays free."""
        lengths, order = self.lengths, self.order
        for i in sorted(items, key=lambda k: (-lengths[k], k)):
            at = bisect_left(order, (lengths[i], -1))
            if at == len(order):
                self.add_bin([i])
                continue
            free, b = order.pop(at)
            self.members[b].append(i)
            if free > lengths[i]:
                insort(order, (free - lengths[i], b))

    def exchange(self, items: list[int]) -> list[int]:
        """Exchanges a member of an open bin for the longer item that fills the bin best; the items then left over."""
        lengths, order = self.lengths, []
        pool = sorted((lengths[i], i) for i in items)
        for free, b in self.order:
            members, gain, k, at = self.members[b], 0, -1, -1
            for j, m in enumerate(members):
                fits = bisect_right(pool, (lengths[m] + free, len(lengths))) - 1
                if fits >= 0 and pool[fits][0] - lengths[m] > gain:
                    gain, k, at = pool[fits][0] - lengths[m], j, fits
            if gain > 0:
                _, new = pool.pop(at)
                insort(pool, (lengths[members[k]], members[k]))
                self.members[b] = [*members[:k], new, *members[k + 1 :]]
            if free > gain:
                insort(order, (free - gain, b))
        self.order = order
        return [i for _, i in pool]

    def packing(self) -> np.ndarray:
        out = np.empty(len(self.lengths), np.int32)
        for b, members in enumerate(self.members):
            out[members] = b
        return out


def fills(packing: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(packing, weights=lengths, minlength=int(packing.max()) + 1)


def quality(packing: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """To be minimised: bins, then less the mean square fill, which prefers full bins beside an emptier one."""
    f = fills(packing, lengths)
    return len(f), -float(((f / capacity) ** 2).mean())


def members_of(packing: np.ndarray) -> list[list[int]]:
    order = np.argsort(packing, kind="stable")
    return [x.tolist() for x in np.split(order, np.cumsum(np.bincount(packing))[:-1])]


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of ``b`` in ``a``."""
    of_b = members_of(b)
    f = fills(b, lengths)
    good = np.argsort(-f, kind="stable")[: max(1, len(f) // 2)]
    injected = rng.choice(good, size=max(1, len(good) // 2), replace=False).tolist()
    taken = np.zeros(len(a), bool)
    for k in injected:
        taken[of_b[k]] = True
    hit = np.zeros(int(a.max()) + 1, bool)
    hit[a[taken]] = True
    bins = Bins(lengths.tolist(), capacity)
    displaced: list[int] = []
    for k, members in enumerate(members_of(a)):
        if hit[k]:
            displaced += [i for i in members if not taken[i]]
        else:
            bins.add_bin(members)
    for k in injected:
        bins.add_bin(of_b[k])
    bins.best_fit(bins.exchange(displaced))
    return bins.packing()


def mutate(a: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Empties the least filled bin and some random others, and packs their pieces anew."""
    f = fills(a, lengths)
    n = len(f)
    gone = np.zeros(n, bool)
    gone[np.argsort(f, kind="stable")[: max(1, n // 50)]] = True
    gone[rng.choice(n, size=min(n, max(2, n // 20)), replace=False)] = True
    bins, displaced = Bins(lengths.tolist(), capacity), []
    for k, members in enumerate(members_of(a)):
        if gone[k]:
            displaced += members
        else:
            bins.add_bin(members)
    bins.best_fit(bins.exchange(displaced))
    return bins.packing()


def founders(lengths: np.ndarray, capacity: int, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit with the longest first, then the same over rising shares of pieces set at random before."""
    out = []
    for k in range(size):
        bins, all_items = Bins(lengths.tolist(), capacity), rng.permutation(len(lengths))
        early = all_items[: len(lengths) * k // (4 * size)].tolist()
        for i in early:
            bins.best_fit([i])
        bins.best_fit(all_items[len(early) :].tolist())
        out.append(bins.packing())
        if finished(out[-1], lengths, capacity):
            break
    return sorted(out, key=lambda p: quality(p, lengths, capacity))


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    return -(-int(lengths.sum()) // capacity)


def finished(packing: np.ndarray, lengths: np.ndarray, capacity: int) -> bool:
    """Whether no packing is better by much: the least number of bins, and all but one full."""
    f = fills(packing, lengths)
    return len(f) <= least_bins(lengths, capacity) and int((f < TAIL_FILL * capacity).sum()) <= 1


def evolve(population: list[np.ndarray], lengths: np.ndarray, capacity: int, children: int, size: int, seed: int) -> list[np.ndarray]:
    """The population after some children, best first; it ends early where no packing can be better by much."""
    rng = np.random.default_rng(seed)
    ranked = sorted(((quality(p, lengths, capacity), p) for p in population), key=lambda x: x[0])
    for _ in range(children):
        if finished(ranked[0][1], lengths, capacity):
            break
        if len(ranked) > 1:
            a, b = rng.choice(len(ranked), size=2, replace=False)
            child = crossover(ranked[a][1], ranked[b][1], lengths, capacity, rng)
        else:
            child = ranked[0][1]
        if rng.random() < 0.5 or len(ranked) == 1:
            child = mutate(child, lengths, capacity, rng)
        ranked = sorted([*ranked, (quality(child, lengths, capacity), child)], key=lambda x: x[0])[:size]
    return [p for _, p in ranked]


# --- islands on Spark ------------------------------------------------------------------------------


def _row(block: int, island: int, ids: bytes, lengths: np.ndarray, population: list[np.ndarray], capacity: int) -> dict:
    n_bins, unevenness = quality(population[0], lengths, capacity)
    return {"block": block, "island": island, "row_ids": ids, "lengths": lengths.astype("<i4").tobytes(), "population": [p.astype("<i4").tobytes() for p in population],
            "n_bins": n_bins, "unevenness": unevenness, "done": finished(population[0], lengths, capacity)}


def _packings(row: dict) -> list[np.ndarray]:
    return [np.frombuffer(p, "<i4") for p in row["population"]]


_COLUMNS = ["block", "island", "row_ids", "lengths", "population", "n_bins", "unevenness", "done"]


def _dealt(df: DataFrame, blocks: int, *by: str) -> DataFrame:
    """The rows by block. They are small and the work on them is not, so Spark is told how many tasks to make of them."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartition(min(blocks, max(tasks, blocks // 64)), *by)


def _grown(rows: list[dict], epoch: int, n_islands: int, capacity: int, children: int, size: int) -> pd.DataFrame:
    """The islands after an epoch of their own, and the best packing of each on its way to the next island of the block."""
    out = []
    for r in rows:
        lengths = np.frombuffer(r["lengths"], "<i4").astype(np.int64)
        grown = evolve(_packings(r), lengths, capacity, children, size, zlib.crc32(f"{r['block']},{r['island']},{epoch}".encode()))
        out.append(_row(r["block"], r["island"], r["row_ids"], lengths, grown, capacity))
        if not out[-1]["done"]:  # the emigrant: only the packing travels
            out.append({**_row(r["block"], (r["island"] + 1) % n_islands, b"", lengths, grown[:1], capacity), "lengths": b""})
    return pd.DataFrame(out, columns=_COLUMNS)


def _settle(pieces: DataFrame, blocks: int, capacity: int, islands: int, children: int, population: int) -> DataFrame:
    """The islands of each block with their founders, after the first epoch; one island is enough where its founders can't be beaten.

    Here and in ``_epoch`` one Python function does all of a group's work, so a task needs one Python worker."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id")
        lengths, out = pdf["length"].to_numpy(np.int64), []
        for k in range(islands):
            start = founders(lengths, capacity, population, np.random.default_rng([int(key[0]), k]))
            out.append(_row(int(key[0]), k, pdf["row_id"].to_numpy("<i8").tobytes(), lengths, start, capacity))
            if out[0]["done"]:
                break
        return _grown(out, 0, islands, capacity, children, population)

    return _dealt(pieces.select("block", "row_id", "length"), blocks, "block").groupBy("block").applyInPandas(run, _ISLAND)


def _epoch(islands: DataFrame, blocks: int, epoch: int | None, capacity: int, n_islands: int, children: int, size: int) -> DataFrame:
    """Every island takes in who came, then evolves for another epoch (None: it was the last)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        home = pdf[pdf["row_ids"].str.len() > 0]
        if len(home) == 0:
            return home[_COLUMNS]
        r = home[_COLUMNS].to_dict("records")[0]
        if len(pdf) > len(home):
            lengths = np.frombuffer(r["lengths"], "<i4").astype(np.int64)
            everyone = [p for row in pdf[_COLUMNS].to_dict("records") for p in _packings(row)]
            different = {p.tobytes(): p for p in everyone}.values()
            ranked = sorted(different, key=lambda p: (quality(p, lengths, capacity), p.tobytes()))[:size]
            r = _row(r["block"], r["island"], r["row_ids"], lengths, ranked, capacity)
        return pd.DataFrame([r], columns=_COLUMNS) if epoch is None else _grown([r], epoch, n_islands, capacity, children, size)

    return _dealt(islands, blocks * n_islands, "block", "island").groupBy("block", "island").applyInPandas(run, _ISLAND)


def worst_bins(f: np.ndarray, capacity: int, tail_fill: float) -> np.ndarray:
    """Which bins go on to the next level: of those not full, the least filled ones, an eighth of all or two."""
    worst = np.zeros(len(f), bool)
    worst[np.argsort(f, kind="stable")[: max(2, len(f) // TAIL_SHARE)]] = True
    return worst & (f < tail_fill * capacity)


def _unfold(best: DataFrame, capacity: int, tail_fill: float) -> DataFrame:
    """(row_id, length, sequence_id, offset, tail) of the blocks' packings; the sequence is named by its lowest row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.to_dict("records"):
                row_ids, lengths, packing = np.frombuffer(r["row_ids"], "<i8"), np.frombuffer(r["lengths"], "<i4").astype(np.int64), _packings(r)[0]
                order = np.argsort(packing, kind="stable")
                f = fills(packing, lengths).astype(np.int64)
                ends = np.cumsum(lengths[order])
                first = np.concatenate(([0], np.cumsum(np.bincount(packing))[:-1]))
                begins = ends - lengths[order]
                b = packing[order]
                yield pd.DataFrame({"row_id": row_ids[order], "length": lengths[order], "sequence_id": np.minimum.reduceat(row_ids[order], first)[b],
                                    "offset": begins - begins[first][b], "tail": worst_bins(f, capacity, tail_fill)[b]})

    return best.mapInPandas(run, "row_id long, length long, sequence_id long, offset long, tail boolean")


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def pack(pieces: DataFrame, folder: str, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS, islands: int = ISLANDS,
         epochs: int = EPOCHS, population: int = POPULATION, children: int = CHILDREN, tail_fill: float = TAIL_FILL) -> DataFrame:
    """(row_id, sequence_id, offset) for pieces (row_id unique, length from 1 to capacity); ``epochs`` is 1 or more.

    Levels are written to ``folder`` on the shared store, so the work on a
    level is not repeated when an executor is lost later.
    """
    whole = F.col("length") >= capacity
    done = [pieces.where(whole).select("row_id", F.col("row_id").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest, level = pieces.where(~whole).select("row_id", "length"), 0
    while True:
        count, tokens = rest.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        blocks = max(1, min(-(-count // block_rows), tokens // (BLOCK_BINS * capacity)))
        last = blocks == 1
        dealt = rest.withColumn("block", F.pmod(F.xxhash64(F.lit(level), "row_id"), F.lit(blocks)))
        state = _settle(dealt, blocks, capacity, islands, children, population)
        for e in [*range(1, epochs), None]:
            state = _epoch(state, blocks, e, capacity, islands, children, population)
        by_quality = Window.partitionBy("block").orderBy(F.col("n_bins"), F.col("unevenness"), F.col("island"))
        best = state.withColumn("rank", F.row_number().over(by_quality)).where("rank = 1").drop("rank")
        placed = _stored(_unfold(best, capacity, tail_fill), f"{folder}/level{level}")
        settled = placed if last else placed.where(~F.col("tail"))
        done.append(settled.select("row_id", "sequence_id", "offset"))
        if last:
            break
        rest, level = placed.where("tail").select("row_id", "length"), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


# --- pieces of documents ---------------------------------------------------------------------------


def cut(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document's ids and end id: pieces of ``capacity``, the last may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, False)
        for batch in slices(batches, "text"):
            ids, ends = enc.encode(batch.column("text"))
            whole = np.insert(ids, ends[1:], end_id).astype("<u4")
            ends = ends + np.arange(len(ends))
            rows, starts, lengths, crc, piece = [], [], [], [], []
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                for k, at in enumerate(range(a, b, capacity)):
                    stop = min(at + capacity, b)
                    rows.append(i)
                    piece.append(k)
                    starts.append(at - a)
                    lengths.append(stop - at)
                    crc.append(zlib.crc32(whole[at:stop]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long"))


def pack_documents(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of documents (doc_id, text)."""
    folder = scratch_dir(docs.sparkSession, "packing")
    row_id: Column = F.monotonically_increasing_id()  # fixed by the write
    pieces = _stored(cut(docs, path, end_id, capacity).withColumn("row_id", row_id), f"{folder}/pieces")
    places = pack(pieces.select("row_id", "length"), folder, capacity, **options)
    return pieces.join(places, "row_id").drop("row_id")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 1)
