from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import packing, token_files
from salesmart.llm.elias_fano import EliasFano
from salesmart.llm.tokens import Encoder, tokenizer_path
from salesmart.llm.words import slices, words
from salesmart.session import scratch_dir

FILES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]


@pytest.mark.parametrize("name,spaces", FILES)
def test_encoder_equals_the_whole_tokenizer(name, spaces):
    rng, letters = random.Random(1), " \t\n\r 　 ab é'sß1２€.,!\x1c\x85́ΣσİA漢字×"
    texts = ["", None, " ", "a  b\n\n c ", "don't stop. it's 10,5!", "<|endoftext|> x", *("".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(4000))]
    encoder = Encoder(tokenizer_path(name), spaces)
    for _ in range(2):  # the second time from the store
        ids, ends = encoder.encode(pa.array(texts))
        for i, e in enumerate(encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)):
            assert ids[ends[i] : ends[i + 1]].tolist() == e.ids, repr(texts[i])


def test_slices_keep_all_rows():
    batch = pa.record_batch([pa.array(["ab" * i for i in range(50)] + [None])], ["text"])
    got = list(slices(iter([batch, batch.slice(0, 0)]), "text", 100))
    assert sum(b.num_rows for b in got) == 51 and len(got) > 5
    assert pa.Table.from_batches(got).column("text").to_pylist() == batch.column("text").to_pylist()


def test_words_of_sliced_arrays():
    column = pa.array(["x y", None, "a  b", "", "c"]).slice(1)
    w = words(column)
    assert [[w.vocabulary[c].as_py() for c in w.codes[a:b]] for a, b in zip(w.rows[:-1].tolist(), w.rows[1:].tolist())] == [[], [b"a", b"b"], [], [b"c"]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**50), max_size=300))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    code, end = EliasFano.from_bytes(EliasFano.encode(np.array(values, np.uint64)).to_bytes())
    assert code.select(np.arange(len(values))).tolist() == values
    with pytest.raises(IndexError):
        code.select(np.array([len(values)]))


def test_elias_fano_is_small():
    gaps = np.random.default_rng(0).integers(1, 2000, 100_000)
    assert len(EliasFano.encode(np.cumsum(gaps)).to_bytes()) * 8 / 100_000 < 2 + np.log2(gaps.mean()) + 1


def _ids(docs, name, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    t.encode_special_tokens = True
    return [(r.doc_id, [*t.encode(r.text or "", add_special_tokens=False).ids, end]) for r in docs.collect()]


def test_token_files(spark, odd_docs):
    folder = scratch_dir(spark, "test-tokens") + "/blocks"
    token_files.write_blocks(odd_docs, folder, tokenizer_path("byte_bpe_50k.json"), True, 0, block_tokens=3000, shard_rows=10)
    got = token_files.documents_of(token_files.read_blocks(spark, folder)).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]
    want = sorted((str(d), len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in _ids(odd_docs, "byte_bpe_50k.json", 0))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want


def test_token_files_of_nothing(spark, no_docs):
    folder = scratch_dir(spark, "test-tokens") + "/blocks"
    token_files.write_blocks(no_docs, folder, tokenizer_path("byte_bpe_50k.json"), True, 0)
    assert token_files.documents_of(token_files.read_blocks(spark, folder)).collect() == []


def test_block_of_extreme_doc_ids():
    ids = [None, -(2**63), 5, 5, 2**63 - 1]
    block = token_files.Block(token_files.pack_block(ids, [np.array([i], np.uint32) for i in range(5)], 2))
    assert block.doc_ids() == ids and block.offsets(np.arange(6)).tolist() == [0, 1, 2, 3, 4, 5] and block.ids.tolist() == [0, 1, 2, 3, 4]


def _check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_documents(spark, odd_docs):
    got = packing.pack_documents(odd_docs, tokenizer_path("word_bpe_49k.json"), 1, block_rows=20).collect()
    n = _check_packing(got, 4096)
    want, total = [], 0
    for d, ids in _ids(odd_docs, "word_bpe_49k.json", 1):
        total += len(ids)
        want += [(str(d), k, a, len(ids[a : a + 4096]), zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert n <= -(-total // 4096) + 1


def test_packing_of_nothing(spark, no_docs):
    assert packing.pack_documents(no_docs, tokenizer_path("word_bpe_49k.json"), 1).collect() == []


def test_levels_leave_few_bins(spark):
    rng = np.random.default_rng(3)
    lengths = rng.integers(30, 100, 3000).tolist()
    pieces = spark.createDataFrame([(i, int(x)) for i, x in enumerate(lengths)], "row_id long, length long")
    got = pieces.join(packing.pack(pieces, scratch_dir(spark, "test-pack"), capacity=100, block_rows=200), "row_id").collect()
    assert len(got) == 3000
    n = _check_packing(got, 100)
    alone = len(packing.founders(np.array(lengths), 100, 1, rng)[0]), int(packing.founders(np.array(lengths), 100, 1, rng)[0].max()) + 1
    assert n <= 1.02 * alone[1]


@pytest.mark.parametrize("lengths", [[1] * 5000, [60 + i % 41 for i in range(2500)], [100 - i % 3 for i in range(1500)], [3] * 3000 + [97] * 1500])
def test_levels_end_at_one_block(spark, lengths):
    """Tiny pieces, pieces that fill a bin alone, and pieces that go together only across blocks."""
    pieces = spark.createDataFrame(list(enumerate(lengths)), "row_id long, length long")
    got = pieces.join(packing.pack(pieces, scratch_dir(spark, "test-pack-end"), capacity=100, block_rows=100), "row_id").collect()
    assert sorted(r.row_id for r in got) == list(range(len(lengths)))
    n, least = _check_packing(got, 100), max(sum(x > 50 for x in lengths), -(-sum(lengths) // 100))
    assert least <= n <= 1.03 * least + 1


def test_search_leaves_fewer_tail_bins_than_founders(spark):
    """On the documents: children that crossover and mutation made take the founders' place, and less goes on to the next level."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    cut = packing.cut(docs, tokenizer_path("word_bpe_49k.json"), 1).where("length < 4096").select("length").collect()
    lengths = np.random.default_rng(4).permutation([r.length for r in cut])
    founders_tail = search_tail = accepted = 0
    for at in range(0, len(lengths) - 1000, 2000):
        block = np.array(lengths[at : at + 2000], np.int64)
        start = packing.founders(block, 4096, packing.POPULATION, np.random.default_rng(at))
        grown = packing.evolve(start, block, 4096, 2 * packing.CHILDREN, packing.POPULATION, at)
        known = {p.tobytes() for p in start}
        accepted += grown[0].tobytes() not in known
        founders_tail += int((packing.fills(start[0], block) < packing.TAIL_FILL * 4096).sum())
        search_tail += int((packing.fills(grown[0], block) < packing.TAIL_FILL * 4096).sum())
        assert grown[0].max() <= start[0].max()
    assert accepted > 0 and search_tail < founders_tail


def test_genetic_steps_keep_every_piece_once_and_improve():
    rng = np.random.default_rng(1)
    lengths = rng.integers(20, 60, 120)
    start = packing.founders(lengths, 100, 4, rng)
    for _ in range(20):
        child = packing.mutate(packing.crossover(start[0], start[-1], lengths, 100, rng), lengths, 100, rng)
        assert packing.fills(child, lengths).max() <= 100 and len(child) == 120
        assert sorted(np.unique(child)) == list(range(child.max() + 1))
    grown = packing.evolve(start, lengths, 100, 60, 4, 9)
    assert packing.quality(grown[0], lengths, 100) <= min(packing.quality(p, lengths, 100) for p in start)
    assert packing.evolve(start, lengths, 100, 60, 4, 9)[0].tolist() == grown[0].tolist()
