import hashlib
import random
import re

import numpy as np
import pytest

from chatscope.llm import fim
from tests.conftest import SF_SMALL

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text):
    """The contract, unit by unit."""
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    lo, hi = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, len(u), "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_every_rank_is_found_exactly():
    rng = random.Random(5)
    texts = ["".join(rng.choice(["ab", "Z", " ", "é", "\n", "😀", "1", "word"]) for _ in range(rng.randint(1, 400)))
             for _ in range(60)] + ["x", "x" * 500, "\n" * 3000]
    lists = fim.SkipLists(texts)
    assert len(lists.lanes) > 2
    for k, t in enumerate(texts):
        u = UNIT.findall(t)
        assert lists.n[k] == len(u)
        want = np.concatenate([[0], np.cumsum([len(x) for x in u])])
        ranks = np.arange(len(u) + 1)
        assert lists.chars_before(np.full(len(ranks), k), ranks).tolist() == want.tolist()
    for low, lane in zip(lists.lanes, lists.lanes[1:]):  # widths are the sums over the lane below
        assert lane.units.sum() == low.units.sum() and lane.chars.sum() == low.chars.sum()
        assert len(lane.units) < len(low.units)


def test_descent_is_logarithmic():
    lists = fim.SkipLists(["a " * 200_000])
    assert lists.n[0] == 400_000 and len(lists.lanes) >= 5
    assert all(len(a.units) > 2 * len(b.units) for a, b in zip(lists.lanes[:4], lists.lanes[1:5]))


@pytest.mark.parametrize("group_chars", [50, 1 << 21])
def test_against_brute_force(spark, odd_docs, no_docs, group_chars):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tricky = spark.createDataFrame(
        [(100_000 + k, t) for k, t in enumerate(["<P", "a<S", "<<M", "a<P>b", "<", "<S", "P>", "İß <M", "<S>", "a\x00b"] * 20)],
        "doc_id long, text string")
    for df in (docs, odd_docs, tricky):
        got = sorted(map(repr, map(tuple, fim.transform(df, group_chars=group_chars).collect())))
        assert got == sorted(repr(brute(r.doc_id, r.text)) for r in df.collect())
        back = fim.round_trip(df).collect()
        assert sorted((repr(r.doc_id), r.output_sha256, r.restored_sha256) for r in back) == sorted(
            (repr(r.doc_id), sha(brute(r.doc_id, r.text)[-1]), sha(r.text or "")) for r in df.collect())
    assert fim.round_trip(no_docs).collect() == []


def test_own_markers_and_string_ids(spark):
    df = spark.createDataFrame([(f"id-{k}", "one two three four") for k in range(50)], "doc_id string, text string")
    marks = ("[p]", "(s)", "{m}")
    out = fim.transform(df, markers=marks)
    rows = out.select(fim.restored(out.output, out.form, marks).alias("t"), "form").collect()
    assert {r.t for r in rows} == {"one two three four"} and {r.form for r in rows} == {"plain", "psm", "spm"}
    with pytest.raises(ValueError, match="markers"):
        fim.transform(df, markers=("<a>", "<a<", "<b>"))
