import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chatscope.llm import collocations as C
from tests.conftest import SF_SMALL


def brute_counts(rows):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return counts, n


def brute(rows, min_count, top):
    """The contract with dictionaries and Python's integers."""
    counts, n = brute_counts(rows)
    out = []
    for lang, f in counts.items():
        got = []
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        for p, a in cand.items():
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not any(p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in cand.items() if len(q) > len(p)):
                got.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(got)[:top])]
    return sorted(out)


def phrases_of(texts):
    numbers = C._Numbers()
    stream = [x for t in texts for x in (*C.word_numbers(t.encode(), numbers), np.zeros(1, np.int32))]
    return C.count_phrases(numbers, np.concatenate(stream))


def as_dict(phrases):
    names, keys, n = phrases
    return {tuple(names[i - 1] for i in abc if i): c for *abc, c in zip(*(x.tolist() for x in C.labels(keys)), n.tolist())}


def random_texts(seed, n=40):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["a", "B", "é", "c,", "d.", "zz\t", "\n", "a", "a", "É"]) for _ in range(rng.randint(0, 60)))
            for _ in range(n)]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 17])
def test_transducer_holds_the_sorted_phrases(monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK", chunk)
    for seed in range(8):
        texts = random_texts(seed)
        got = phrases_of(texts)
        assert (np.diff(got[1]) > 0).all()
        want = {tuple(w.encode() for w in p): f for p, f in brute_counts([("x", t) for t in texts])[0]["x"].items()}
        assert as_dict(got) == want
        t = C.CountTransducer.from_bytes(C.build(got).to_bytes())
        back = t.phrases()
        assert back[0] == got[0] and back[1].tolist() == got[1].tolist() and back[2].tolist() == got[2].tolist()
        # minimal below the root: no two states with equal arcs
        arcs = [tuple(zip(*(x[a:b].tolist() for x in (t.label, t.weight, t.target)))) for a, b in zip(t.first, t.first[1:])]
        assert len(set(arcs[:-1])) == len(arcs) - 1


def test_equal_endings_share_a_state():
    t = C.build(phrases_of([f"w{k} to the" for k in range(50)]))
    assert len(t.first) - 1 <= 6  # the leaf, the root, after "to", and what all the w share


def test_colliding_signatures_are_told_apart():
    b = C.Builder([b"a"])
    arcs = np.array([[1, 2, 0], [2, 1, 0], [1, 2, 0], [1, 1, 0], [2, 2, 0]], dtype=np.int64)
    got = b._freeze(arcs, np.array([0, 1, 2, 3]))
    assert got[0] == got[2] and len(set(got.tolist())) == 3


def test_union_and_composition():
    parts = [random_texts(s) for s in range(5)]
    whole = as_dict(phrases_of(sum(parts, [])))
    autos = [C.build(phrases_of(p)) for p in parts]
    names, keys, n = C.united([a.phrases() for a in autos])
    assert as_dict((names, keys, n)) == whole
    auto = C.build((names, keys, n))
    asked = phrases_of(["a b nowhere c", "zz zz é a", "a a a a"])
    acceptor = C.build((asked[0], asked[1], np.ones(len(asked[1]), np.int64)))
    want = [whole.get(p, 0) for p in as_dict(asked)]
    assert auto.compose(acceptor.phrases()).tolist() == want and any(want) and not all(want)
    empty = C.build(([], np.empty(0, np.int64), np.empty(0, np.int64)))
    assert empty.compose(asked).tolist() == [0] * len(asked[1])


def test_ranges_split_every_phrase_alike():
    bounds = sorted([("x", b"a", b"", b""), ("x", b"a", b"b", b"mm"), ("x", b"b", b"", b""), ("x", b"nope", b"q", b""),
                     ("y", b"a", b"", b""), ("x", "é".encode(), b"a", b"a")])
    for seed in range(4):
        p = phrases_of(random_texts(seed))
        for lang in "wxyz":
            got = {}
            for r, part in C.by_range(p[0], p[1], lang, bounds):
                for q in as_dict(C.narrowed(p, part)):
                    got[q] = r
            want = {q: sum(b <= (lang, *(list(q) + [b""] * 2)[:3]) for b in bounds) for q in as_dict(p)}
            assert got == want


@pytest.mark.parametrize("ranges, shard_words", [(1, C.SHARD_WORDS), (40, 3000)])
def test_query_against_brute_force(spark, ranges, shard_words):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = C.mine(docs, ranges=ranges, shard_words=shard_words, top=300)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10, 300)


def test_odd_rows_hot_phrases_and_ties(spark, odd_docs, no_docs):
    rng = random.Random(2)
    words = ["w%d" % k for k in range(12)]
    rows = [(rng.choice(["en", None, "und", "fr"]), "the the of " + " ".join(rng.choice(words) for _ in range(30))) for _ in range(300)]
    rows += [("en", "the copy of one text, again and again")] * 400 + [("en", None), (None, ""), ("en", "x" * 70_000 + " y")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for frame in (df, odd_docs):
        want = brute([(r.lang, r.text) for r in frame.collect()], 3, 50)
        assert sorted(map(tuple, C.mine(frame, min_count=3, top=50, ranges=9).collect())) == want and want
    assert C.mine(no_docs).collect() == []


def test_long_texts_are_cut_without_loss(monkeypatch):
    text = " ".join(random_texts(1, 300))
    whole = as_dict(phrases_of([text]))
    monkeypatch.setattr(C, "_CUT", 50)
    assert as_dict(phrases_of([text])) == whole


def test_scores_are_exact_for_large_counts(spark):
    rows = [(10**15, 10**15 + 7, 10**15 + 3, None, None), (9 * 10**15, 9 * 10**15, 9 * 10**15 + 1, 9 * 10**15 + 1, 9 * 10**15),
            (12_345_678_901, 98_765_432_109_876, 12_345_678_902, 12_345_678_903, 98_765_432_109_875)]
    df = spark.createDataFrame(rows, "a long, l1 long, r1 long, l2 long, r2 long")
    for r in C._with_scores(df).collect():
        cuts = [(10**6 * r.a**2 // (r.l1 * r.r1), 1, r.l1, r.r1)]
        if r.l2 is not None:
            cuts.append((10**6 * r.a**2 // (r.l2 * r.r2), 2, r.l2, r.r2))
        score, _, left, right = min(cuts)
        assert (r.score, r.l, r.r) == (score, left, right)
