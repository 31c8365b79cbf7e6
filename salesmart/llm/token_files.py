"""Token ids of documents in binary blocks with Elias-Fano boundaries.

Documents are encoded where they are read, dealt to shards by ranges of
doc_id, sorted there, and written as blocks of about ``BLOCK_TOKENS`` ids.
A block is one byte string:

    b"EFT1", bytes per id (1 byte), documents without doc_id (8 bytes),
    lowest doc_id (8, signed), Elias-Fano list of doc_id less the lowest,
    Elias-Fano list of the n + 1 document boundaries in the id array,
    the id array (little-endian, 2 or 4 bytes an id)

so the ids and offsets of a document are read by two selects, without a table
of 64-bit offsets. Blocks are stored as the rows of a Parquet table (shard,
block, counts, payload): Spark's writer commits them once whatever
executors are lost, to any store it can write to. Blocks are numbered in
ascending doc_id order over all shards; documents without doc_id come first,
rows of equal doc_id in the order of a hash of their ids.

Nulls, empty texts: the end id alone. Repeated rows are all kept.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.elias_fano import EliasFano
from salesmart.llm.tokens import encoder, tokenizer_path
from salesmart.llm.words import ragged, slices
from salesmart.session import scratch_dir

MAGIC = b"EFT1"
BLOCK_TOKENS = 1 << 20
#: Rows of documents per shard, to size the shards.
SHARD_ROWS = 16_384
_HEAD = struct.Struct("<4sBQq")
_TOKENS = "doc_id long, shard int, n_tokens long, tie long, ids binary"
_BLOCKS = "shard int, block int, n_docs long, before long, n_tokens long, payload binary"


def _ends(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)


def pack_block(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """A block of documents sorted by doc_id, those without one first."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    low = int(known[0]) if len(known) else 0
    gaps = known.astype(np.uint64) - np.uint64(low & 0xFFFFFFFFFFFFFFFF)  # exact also over the whole range of long
    head = _HEAD.pack(MAGIC, width, len(doc_ids) - len(known), low)
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    return head + EliasFano.encode(gaps).to_bytes() + EliasFano.encode(_ends([len(i) for i in ids])).to_bytes() + flat.astype(f"<u{width}").tobytes()


class Block:
    """Reads a block: ``offsets`` and ``doc_ids`` by select, ``ids`` as a view of the array."""

    def __init__(self, payload: bytes):
        magic, self.width, self.n_null, self.low = _HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token block")
        self._docs, at = EliasFano.from_bytes(payload, _HEAD.size)
        self._bounds, at = EliasFano.from_bytes(payload, at)
        self.ids = np.frombuffer(payload, f"<u{self.width}", self._bounds.top, at)
        self.n = self._bounds.n - 1

    def offsets(self, which: np.ndarray) -> np.ndarray:
        """Where the documents at places ``which`` of the block begin; place n is the end."""
        return self._bounds.select(which)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + [self.low + int(x) for x in self._docs.select(np.arange(self._docs.n)).astype(np.uint64)]


def tokenize(docs: DataFrame, path: str, spaces: bool, end_id: int, bounds: list[float]) -> DataFrame:
    """(doc_id, shard, n_tokens, tie, ids): each document's ids with the end id, compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, press = encoder(path, spaces), zstandard.ZstdCompressor(level=1)
        edges = np.asarray(bounds, np.float64)
        for batch in slices(batches, "text"):
            ids, ends = enc.encode(batch.column("text"))
            doc_ids = batch.column("doc_id").cast(pa.int64())
            packed, ties = [], []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                raw = np.append(ids[a:b], np.uint32(end_id)).astype(f"<u{enc.width}").tobytes()
                packed.append(press.compress(raw))
                ties.append(zlib.crc32(raw))
            values = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            shard = np.where(np.asarray(doc_ids.is_null()), 0, np.searchsorted(edges, values, side="left"))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(shard, pa.int32()), pa.array(np.diff(ends) + 1, pa.int64()), pa.array(ties, pa.int64()), pa.array(packed, pa.binary())],
                ["doc_id", "shard", "n_tokens", "tie", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _TOKENS)


def _to_blocks(block_tokens: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, doc_ids, ids, total, before = None, 0, [], [], 0, 0
        unpress = zstandard.ZstdDecompressor()

        def done():
            return pa.RecordBatch.from_pylist([{"shard": shard, "block": block, "n_docs": len(doc_ids), "before": before, "n_tokens": total, "payload": pack_block(doc_ids, ids, width)}], pa.schema(
                [("shard", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())]))

        for batch in batches:
            for d, s, packed in zip(batch.column("doc_id").to_pylist(), batch.column("shard").to_pylist(), batch.column("ids"), strict=True):
                if doc_ids and (s != shard or total >= block_tokens):
                    yield done()
                    block, before = (block + 1, before + total) if s == shard else (0, 0)
                    doc_ids, ids, total = [], [], 0
                shard = s
                doc_ids.append(d)
                ids.append(np.frombuffer(unpress.decompress(packed.as_py()), f"<u{width}"))
                total += len(ids[-1])
        if doc_ids:
            yield done()

    return run


def shard_bounds(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> list[float]:
    """Edges of doc_id that deal the rows evenly: a number per shard, so few whatever the input."""
    n = max(1, -(-docs.count() // shard_rows))
    if n == 1:
        return []
    edges = docs.select(F.col("doc_id").cast("double").alias("doc_id")).approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n)
    return sorted(set(edges))


def write_blocks(docs: DataFrame, folder: str, path: str, spaces: bool, end_id: int,
                 block_tokens: int = BLOCK_TOKENS, shard_rows: int = SHARD_ROWS) -> None:
    """Encodes (doc_id, text) and writes the blocks to ``folder``."""
    bounds = shard_bounds(docs.select("doc_id"), shard_rows)
    shards = (tokenize(docs, path, spaces, end_id, bounds)
              .repartitionById(len(bounds) + 1, F.col("shard"))
              .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "tie", "n_tokens"))
    width = encoder(path, spaces).width
    (shards.select("doc_id", "shard", "ids").mapInArrow(_to_blocks(block_tokens, width), _BLOCKS)
     .write.mode("errorifexists").option("compression", "zstd").parquet(folder))


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks with ``base``, the ids of all blocks before.

    A block knows what its shard holds before it; what other shards hold is a
    sum over a row per shard, written beside the blocks. Spark sees the size
    of that file and sends it to all tasks, or shuffles where it is large.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(folder)
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("of_shard"))
    starts = shards.select("shard", (F.sum("of_shard").over(Window.orderBy("shard")) - F.col("of_shard")).alias("start"))
    starts.write.mode("overwrite").parquet(f"{folder}-shards")
    starts = spark.read.schema("shard int, start long").parquet(f"{folder}-shards")
    return blocks.join(starts, "shard").withColumn("base", F.col("before") + F.col("start"))


def documents_of(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column("base").to_pylist(), batch.column("payload"), strict=True):
                b = Block(payload.as_py())
                at = b.offsets(np.arange(b.n + 1))
                ids = b.ids.astype("<u4")
                crc = [zlib.crc32(ids[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.doc_ids(), pa.int64()), pa.array(at[:-1] + base), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.select("base", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the token files and back: their place and the checksum of their ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = scratch_dir(spark, "token-files") + "/blocks"
    write_blocks(docs, folder, tokenizer_path("byte_bpe_50k.json"), True, 0)
    return documents_of(read_blocks(spark, folder))
