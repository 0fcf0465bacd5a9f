import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chatscope.llm import bpe, packing
from tests.conftest import SF_SMALL

PATH = bpe.vocabulary_file()
DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256")


@pytest.fixture(scope="module")
def tok():
    return bpe.load_tokenizer(PATH)


def test_encoder_and_word_cuts_equal_the_library(tok):
    enc, pieces, rng = bpe.load_encoder(PATH), bpe.piece_table(tok), random.Random(3)
    parts = [*"ab'sre  \n\t\r.,!19½²é  　中😀\x1c\x85#ßİ", "<|endoftext|>", " the", "'ll", "\r\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        ids = tok.encode(text, add_special_tokens=False).ids
        words = bpe.split_words(text)
        words = words[:1] + [" " + w for w in words[1:]]
        assert "".join(words) == text
        assert enc(text) == ids == [i for w in words for i in enc(w)], repr(text)
        assert b"".join(pieces[i] for i in ids).decode("utf-8", "replace") == tok.decode(ids, skip_special_tokens=False)


LONG_RUNS = [" " * 2_000_000 + "word", "a" + "\t" * 2_000_000 + " b", "x" + " \n\t\u3000" * 500_000,
             "x" + " \n" * 1_000_000 + "<|endoftext|> y" + " " * 1_100_000]


def test_runs_of_millions_of_spaces(spark, tok):
    enc = bpe.load_encoder(PATH)
    for t in LONG_RUNS:
        assert enc(t) == tok.encode(t, add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(LONG_RUNS)), "doc_id long, text string")
    got = bpe.encode_and_decode(docs, columns=DIGESTS).collect()
    assert sorted(map(tuple, got)) == [(k, *expected_bpe(tok, t)) for k, t in enumerate(LONG_RUNS)]
    packed = packing.pack(docs, bpe.encoder).groupBy("doc_id").sum("length").collect()
    assert sorted(map(tuple, packed)) == [(k, len(enc(t)) + 1) for k, t in enumerate(LONG_RUNS)]


@given(st.lists(st.integers(0, 2**40)))
def test_number_packing_round_trip(v):
    assert bpe.unpack_numbers(bpe.pack_numbers(np.array(v, dtype=np.int64))).tolist() == v


def expected_bpe(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


@pytest.mark.parametrize("is_scan", [False, True])
def test_bpe_against_library(spark, tok, is_scan):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = bpe.encode_and_decode(docs, is_scan=is_scan, block_bytes=50_000, columns=DIGESTS).collect()  # many blocks
    assert len(got) == len(texts)
    assert all(tuple(r)[1:] == expected_bpe(tok, texts[r.doc_id]) for r in got)


def test_bpe_odd_rows(tok, odd_docs, no_docs):
    got = sorted(map(repr, (tuple(r) for r in bpe.encode_and_decode(odd_docs, columns=DIGESTS).collect())))
    want = sorted(repr((r.doc_id, *expected_bpe(tok, r.text))) for r in odd_docs.collect())
    assert got == want
    assert bpe.encode_and_decode(no_docs).collect() == []
    real = bpe.encode_and_decode(odd_docs).collect()
    assert sorted(repr((r.doc_id, r.n_tokens, r.ids, r.text)) for r in real) == sorted(
        repr((r.doc_id, len(ids), ids, r.text or "")) for r in odd_docs.collect()
        for ids in [tok.encode(r.text or "", add_special_tokens=False).ids])


def check_packing(docs_rows, pieces, tok, capacity):
    ids = {}
    for r in docs_rows:
        ids.setdefault(r.doc_id, []).append(tok.encode(r.text or "", add_special_tokens=False).ids + [0])
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        want = []
        for full in ids[d]:
            head = len(full) % capacity or capacity
            cuts = [0, *range(min(head, len(full)), len(full), capacity), len(full)]
            want += [(k, a, b - a, zlib.crc32(np.array(full[a:b], "<u4").tobytes()))
                     for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        assert sorted((p.piece, p.start, p.length, p.ids_crc32) for p in own) == sorted(want)
    seqs = {}
    for p in pieces:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for s in seqs.values():
        end = 0
        for off, n in sorted(s):
            assert off == end
            end += n
        assert end <= capacity
    return len(seqs)


def test_packing_real_and_odd_rows(spark, tok, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    pieces = packing.pack(docs, bpe.encoder).collect()
    used = check_packing(docs.collect(), pieces, tok, 2048)
    assert used <= -(-sum(p.length for p in pieces) // 2048) + 1
    check_packing(odd_docs.collect(), packing.pack(odd_docs, bpe.encoder, capacity=64).collect(), tok, 64)
    assert packing.pack(no_docs, bpe.encoder).collect() == []


def test_sequences_hold_the_ids(tok, odd_docs):
    packed = packing.pack(odd_docs, bpe.encoder, capacity=64, keep_ids=True)
    rows = packed.collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    for s in packing.sequences(packed).collect():
        own = sorted((r.offset, bytes(r.ids)) for r in rows if r.sequence_id == s.sequence_id)
        assert bytes(s.ids) == b"".join(x for _, x in own) and s.n_pieces == len(own) and s.length * 4 == len(s.ids) <= 256


def best_possible(sizes, capacity):
    """Fewest bins by exhaustive search."""
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in sorted(set(range(len(bins))), key=lambda k: bins[k]):
            if bins[k] + sizes[i] <= capacity:
                go(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1:]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9))
def test_dominance_never_costs_a_sequence(sizes):
    counts = np.bincount(np.array(sizes, dtype=np.int64), minlength=13)
    fixed, left = packing.reduce_by_dominance(counts, 12)
    rest = [s for s in range(13) for _ in range(left[s])]
    assert sum(p.count for p in fixed) + best_possible(sorted(rest, reverse=True), 12) == best_possible(
        sorted(sizes, reverse=True), 12)
    assert all(0 < p.used <= 12 for p in fixed)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=300))
def test_histogram_packing_is_best_fit_and_places_every_rank(sizes):
    counts = np.bincount(np.array(sizes, dtype=np.int64), minlength=41)
    patterns = packing.best_fit(counts, 40)
    rooms = []
    for s in sorted(sizes, reverse=True):  # plain best-fit decreasing, one item at a time
        fits = [k for k, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= s
        else:
            rooms.append(40 - s)
    assert sorted(40 - p.used for p in patterns for _ in range(p.count)) == sorted(rooms)
    table = packing.slots(packing.pack_histogram(counts, 40), 40)
    taken = set()
    for s in range(1, 41):
        seq, off = table.place(np.full(counts[s], s), np.arange(counts[s]))
        for q, o in zip(seq.tolist(), off.tolist(), strict=True):
            cells = {(q, o + k) for k in range(s)}
            assert o + s <= 40 and not cells & taken
            taken |= cells
