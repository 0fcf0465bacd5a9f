import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chatscope.llm import bpe, token_files
from chatscope.session import scratch_path
from tests.conftest import SF_SMALL


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1))))
@settings(max_examples=200, deadline=None)
def test_ranks_round_trip(values):
    v = np.array(values, dtype=np.uint32)
    control, data = token_files.encode_ranks(v)
    assert len(control) == -(-len(v) // 4)
    assert len(data) == sum(1 + (x > 0xFF) + (x > 0xFFFF) + (x > 0xFFFFFF) for x in values)
    assert token_files.decode_ranks(control, data, len(v)).tolist() == values


def test_block_is_ranked_by_frequency_and_checked():
    ids = np.array([70_000] * 9 + [5] * 3 + [6] * 3 + [1], dtype=np.uint32)
    block = token_files.encode_block(pa.array([1, 2, None]), np.array([10, 0, 6]), ids)
    docs, sizes, back = token_files.decode_block(block, "x")
    assert docs.to_pylist() == [1, 2, None] and sizes.tolist() == [10, 0, 6] and back.tolist() == ids.tolist()
    lengths = token_files._HEAD.unpack_from(block)[1:]
    table = block[token_files._HEAD.size + sum(lengths[:2]):][:lengths[2]]
    assert np.frombuffer(table, "<u4").tolist() == [70_000, 5, 6, 1] and lengths[4] == len(ids)  # a byte each
    with pytest.raises(ValueError, match="damaged"):
        token_files.decode_block(block[:-6] + b"\0" + block[-5:], "x")


def test_large_ids_give_the_same_ranks(monkeypatch):
    ids = np.random.default_rng(1).zipf(1.3, 5000).clip(max=900).astype(np.uint32)
    dense = token_files.encode_block(pa.array([1]), np.array([len(ids)]), ids)
    monkeypatch.setattr(token_files, "_DENSE", 0)
    assert token_files.encode_block(pa.array([1]), np.array([len(ids)]), ids) == dense
    wide = ids.astype(np.uint32) * np.uint32(4_000_000)
    assert token_files.decode_block(token_files.encode_block(pa.array([1]), np.array([len(ids)]), wide), "x")[2].tolist() == wide.tolist()


def expected(rows, tok, end=2):
    """The contract, one document after another."""
    out, start = [], 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [end]
        out.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_tokens", [300, token_files.BLOCK_TOKENS])
def test_files_against_the_library(spark, block_tokens):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = scratch_path(spark, f"tok/{block_tokens}")
    token_files.write_tokens(docs.repartition(7), path, bpe.encoder, block_tokens=block_tokens)
    want = expected(docs.collect(), bpe.load_tokenizer(bpe.vocabulary_file()))
    got = token_files.read_tokens(spark, path, partition_bytes=20_000)
    assert got.rdd.getNumPartitions() > 3
    rows = sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got.collect())
    assert rows == want
    with pytest.raises(Exception, match="already holds"):
        token_files.write_tokens(docs, path, bpe.encoder)


def test_odd_rows(spark, odd_docs, no_docs):
    tok = bpe.load_tokenizer(bpe.vocabulary_file())
    got = token_files.round_trip(odd_docs, scratch_path(spark, "tok/odd"), bpe.encoder).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0)) and len(ids) == odd_docs.count()
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    crc = lambda t: zlib.crc32(np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
    assert sorted((repr(r.doc_id), r.ids_crc32) for r in got) == sorted((repr(r.doc_id), crc(r.text)) for r in odd_docs.collect())
    assert token_files.round_trip(no_docs, scratch_path(spark, "tok/none"), bpe.encoder).collect() == []


def test_string_ids_and_hot_id(spark):
    df = spark.createDataFrame([(f"k{k % 3}", f"text {k // 2}") for k in range(300)], "doc_id string, text string")
    got = token_files.round_trip(df, scratch_path(spark, "tok/str"), bpe.encoder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(f"k{k % 3}" for k in range(300))


def test_failed_tasks_leave_no_manifest(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    path = scratch_path(spark, "tok/fail")

    def broken():
        def run(text):
            raise RuntimeError("no encoder")
        return run

    with pytest.raises(Exception, match="no encoder"):
        token_files.write_tokens(df, path, broken)
    with pytest.raises(Exception):
        token_files.read_tokens(spark, path).collect()
