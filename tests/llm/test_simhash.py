import random

import numpy as np
import pytest
import xxhash

from chatscope.llm import simhash
from chatscope.llm.components import components
from tests.conftest import SF_SMALL


def plain_fingerprint(text, n=3):
    """From the definition, bit by bit."""
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace(
        "\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", None, "A", "One two", "É ÀB c", "a\tb\nc\x0bd\x1ce", "x y z " * 50, "  q"])
def test_fingerprint_definition(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_masks_fix_all_but_radius_blocks():
    m = simhash.block_masks(2)
    assert len(set(m)) == 28 and all(bin(x).count("1") == 48 for x in m)
    rng = random.Random(5)
    for _ in range(500):  # any two within the radius share a choice of blocks
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        assert any(a & x == b & x for x in m)


def test_forest_spans_exactly_the_links():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    f = np.unique(np.concatenate([base] + [b ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for b in base]))
    edges = simhash.link_forest(f, 2, tile=16)
    assert all(int(f[a] ^ f[b]).bit_count() <= 2 for a, b in edges)
    want = brute_components(list(range(len(f))), [int(x) for x in f], 2)
    assert len(edges) == len(f) - len(set(want))


@pytest.mark.parametrize("pairs,want", [
    ([], {}), ([(1, 1)], {}), ([(3, 2), (2, 1), (2, 3)], {1: 1, 2: 1, 3: 1}),
    ([(i, i + 1) for i in range(-40, 40)], {i: -40 for i in range(-40, 41)}),
    ([(0, i) for i in range(1, 60)] + [(100, 101), (None, 5)], {**{i: 0 for i in range(60)}, 100: 100, 101: 100})])
def test_components(spark, pairs, want):
    got = components(spark.createDataFrame(pairs, "a long, b long"), 10).collect()
    assert len(got) == len(want) and {r.v: r.root for r in got} == want


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    rows += [(10_000 + k, (r.text or "") + " tail") for k, r in enumerate(rows[:40])]  # near copies
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    want = dict(zip([d for d, _ in rows], brute_components([d for d, _ in rows], fps, 2), strict=True))
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(rows)
    assert {r.doc_id: r.fingerprint for r in got} == {d: f"{f:016x}" for (d, _), f in zip(rows, fps, strict=True)}


def test_odd_rows_and_keep_one(odd_docs, no_docs):
    rows = odd_docs.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    comp = brute_components([r.doc_id for r in rows], fps, 2)
    got = simhash.near_duplicates(odd_docs).collect()
    assert sorted(map(repr, ((r.doc_id, r.fingerprint, r.component_id) for r in got))) == sorted(
        repr((r.doc_id, f"{f:016x}", c)) for r, f, c in zip(rows, fps, comp, strict=True))
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(
        {repr(c) for c in comp if c is not None} | {"None" for r, c in zip(rows, comp, strict=True) if c is None})
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.keep_one(no_docs).collect() == []


def test_keep_one_with_repeated_ids_of_differing_texts(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(40)) for x in "abc")
    rows = [(5, b), (5, a), (3, a), (9, c), (5, c)]
    comp = brute_components(list(range(5)), [plain_fingerprint(t) for _, t in rows], 2)
    assert comp[1] == comp[2] and len(set(comp)) == 3
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id int, text string"))
    assert sorted(map(tuple, kept.collect())) == sorted([(3, a), (5, b), (5, c)])  # one of each component
