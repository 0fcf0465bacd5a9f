"""Metric definitions on hand-computed cases and properties."""

import math
import random

import pytest

from chatscope.functions.lcs import lcs_length
from chatscope.functions.porter import stem


def lcs_dp(a, b):
    """Plain dynamic programme."""
    prev = [0] * (len(b) + 1)
    for x in a or ():
        cur = [0]
        for j, y in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if x == y else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def test_lcs_bit_parallel_equals_dp():
    rng = random.Random(7)
    for _ in range(2000):
        a = [rng.choice("abcde") for _ in range(rng.randint(0, 40))]
        b = [rng.choice("abcde") for _ in range(rng.randint(0, 40))]
        assert lcs_length(a, b) == lcs_dp(a, b)
    long_a = [str(rng.randint(0, 50)) for _ in range(3000)]
    long_b = [str(rng.randint(0, 50)) for _ in range(2500)]
    assert lcs_length(long_a, long_b) == lcs_length(long_b, long_a)


@pytest.mark.parametrize("word,expected", [
    ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"),
    ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"),
    ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"),
    ("relational", "relat"), ("conditional", "condit"), ("hopeful", "hope"), ("goodness", "good"),
    ("revival", "reviv"), ("adjustment", "adjust"), ("adoption", "adopt"), ("controll", "control"),
    ("generalization", "gener"), ("oscillators", "oscil"),
])
def test_porter(word, expected):
    assert stem(word) == expected


@pytest.mark.parametrize("word,plain,extended", [
    ("dying", "dy", "die"), ("news", "new", "news"), ("innings", "in", "inning"), ("dies", "di", "die"), ("died", "di", "die"),
    ("enjoy", "enjoi", "enjoy"), ("happy", "happi", "happi"), ("possibly", "possibli", "possibl"),
    ("carefully", "carefulli", "care"), ("geology", "geologi", "geolog"), ("skies", "ski", "sky"), ("applied", "appli", "appli")])
def test_stem_variants(word, plain, extended):
    assert stem(word, extended=False) == plain and stem(word) == extended


def _pairs(spark, rows):
    return spark.createDataFrame([("m", i, "", r, p) for i, (r, p) in enumerate(rows)],
                                 "model string, sample_id long, prompt string, reference string, prediction string")


def test_bleu_identity_and_zero(spark):
    from chatscope.operators.metrics import bleu
    same = _pairs(spark, [("the cat sat on the mat today", "the cat sat on the mat today")] * 3)
    assert math.isclose(bleu(same).first()["value"], 1.0, rel_tol=1e-12)
    none = _pairs(spark, [("a b c d e", "v w x y z")])
    assert bleu(none).first()["value"] == 0.0


def test_bleu_smoothing_and_brevity(spark):
    """Hand computation: hyp 'a b c d' vs ref 'a b c e f': p1=3/4, p2=2/3, p3=1/2, p4=0 -> 1/(2*1)."""
    from chatscope.operators.metrics import bleu
    v = bleu(_pairs(spark, [("a b c e f", "a b c d")])).first()["value"]
    p = [3 / 4, 2 / 3, 1 / 2, 1 / (2 * 1)]
    expected = math.exp(1 - 5 / 4) * math.exp(sum(math.log(x) for x in p) / 4)
    assert math.isclose(v, expected, rel_tol=1e-12)


def test_rouge_n_hand_case(spark):
    from chatscope.operators.metrics import rouge_n_per_sample
    rows = rouge_n_per_sample(_pairs(spark, [("The cat, the hat!", "the cat sat")])).collect()
    r1 = [r for r in rows if r["n"] == 1][0]
    # ref tokens: the cat the hat; pred: the cat sat -> match 2
    assert math.isclose(r1["precision"], 2 / 3) and math.isclose(r1["recall"], 2 / 4)
    r2 = [r for r in rows if r["n"] == 2][0]
    assert math.isclose(r2["precision"], 1 / 2) and math.isclose(r2["recall"], 1 / 3)


def test_rouge_l_symmetric_f1_and_empty(spark):
    from chatscope.operators.metrics import rouge_l_per_sample
    a, b = "police killed the gunman", "the gunman police killed"
    f_ab = rouge_l_per_sample(_pairs(spark, [(a, b)])).first()["f1"]
    f_ba = rouge_l_per_sample(_pairs(spark, [(b, a)])).first()["f1"]
    assert math.isclose(f_ab, f_ba) and math.isclose(f_ab, 0.5)
    assert rouge_l_per_sample(_pairs(spark, [("x y", "")])).first()["f1"] == 0.0


def test_white_space_is_pythons(spark):
    from pyspark.sql import functions as F

    from chatscope.functions import ngrams as NG
    from chatscope.functions.text import py_strip
    texts = ["a\u00a0b c", "\x1c x\u2003y\u3000", "\u200bz\x85", "tab\tnl\n", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(NG.bleu13a_tokens("t").alias("b"), NG.chrf_chars("t").alias("c"), py_strip("t").alias("s")).collect()
    assert [r.b for r in got] == [t.split() for t in texts]
    assert ["".join(r.c) for r in got] == ["".join(t.split()) for t in texts]
    assert [r.s for r in got] == [t.strip() for t in texts]
    assert df.select(F.count("*")).first()[0] == len(texts)


def test_repeated_samples_count_twice(spark):
    from chatscope.operators import metrics as M
    rows = [("m", 1, "a b c d e f", "a b c d e f"), ("m", 1, "a b c d e f", "a b x y z w"), ("m", 1, "a b c d e f", "a b x y z w"),
            ("m", 2, "p q r s", "p q r s")]
    both = spark.createDataFrame(rows, "model string, sample_id long, reference string, prediction string")
    apart = spark.createDataFrame([(m, i, r, p) for i, (m, _, r, p) in enumerate(rows)],
                                  "model string, sample_id long, reference string, prediction string")
    for metric in (M.rouge_n, M.rouge_l, M.bleu, M.chrf):
        a, b = ({r.metric: r.value for r in metric(df).collect()} for df in (both, apart))
        assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], rel_tol=1e-12) for k in a)


def test_chrf_leaves_out_hypotheses_without_reference_grams(spark):
    """Hypothesis n-grams of a segment count only for orders that its reference has."""
    from chatscope.operators.metrics import chrf_stats
    rows = {r.n: r for r in chrf_stats(_pairs(spark, [("ab", "abcdef"), ("abcd", "abcd")])).collect()}
    assert [rows[n].hyp for n in range(1, 5)] == [6 + 4, 5 + 3, 2, 1]


def test_metric_selection(spark):
    from chatscope.operators.metrics import metrics_long
    pairs = _pairs(spark, [("the running dogs", "a running dog")])
    with pytest.raises(ValueError, match="no metric"):
        metrics_long(pairs, rouge=False, bleu_=False, chrf_=False)
    got = {r.metric: r.value for r in metrics_long(pairs, bleu_=False, chrf_=False, rouge_keys=("rouge1", "rougeL")).collect()}
    assert set(got) == {"rouge_rouge1", "rouge_rougeL"} and math.isclose(got["rouge_rouge1"], 2 / 3)  # dogs and dog share a stem
    plain = metrics_long(pairs, bleu_=False, chrf_=False, rouge_keys=("rouge1",), stem=False).first()
    assert math.isclose(plain.value, 1 / 3)
    vectors = spark.createDataFrame([("m", 1, "pred", 0, [1.0, 0.0]), ("m", 1, "ref", 0, [0.0, 1.0]), ("m", 1, "ref", 1, [2.0, 0.0]),
                                     ("n", 1, "pred", 0, [1.0, 1.0])],
                                    "model string, sample_id long, side string, pos long, embedding array<double>")
    bert = {(r.model, r.metric): r.value for r in metrics_long(pairs, rouge=False, bleu_=False, chrf_=False, vectors=vectors).collect()}
    assert bert == {("m", "bertscore_precision"): 1.0, ("m", "bertscore_recall"): 0.5, ("m", "bertscore_f1"): 2 / 3,
                    **{("n", f"bertscore_{k}"): 0.0 for k in ("precision", "recall", "f1")}}


def test_chrf_identity(spark):
    from chatscope.operators.metrics import chrf
    v = chrf(_pairs(spark, [("hello world", "hello world")])).first()["value"]
    assert math.isclose(v, 1.0)


def test_embedding_match_chunking_is_exact(spark):
    """Chunk size must not change the result (blocked nested loop = all pairs)."""
    from pyspark.sql import functions as F

    from chatscope.operators.metrics import embedding_match
    rng = random.Random(3)
    rows = [(s, side, pos, [rng.uniform(-1, 1) for _ in range(8)])
            for s in range(3) for side in ("pred", "ref") for pos in range(rng.randint(1, 9))]
    v = spark.createDataFrame(rows, "sample_id long, side string, pos long, embedding array<double>")
    a = {r["sample_id"]: r for r in embedding_match(v, chunk=2).collect()}
    b = {r["sample_id"]: r for r in embedding_match(v, chunk=1000).collect()}
    for k in a:
        assert math.isclose(a[k]["f1"], b[k]["f1"], rel_tol=1e-12)
    assert v.select(F.count("*")).first()[0] == len(rows)


def _table_places(ref, cand):
    """A plain table and the way back."""
    t = [[0] * (len(cand) + 1) for _ in range(len(ref) + 1)]
    for i, a in enumerate(ref, 1):
        for j, b in enumerate(cand, 1):
            t[i][j] = t[i - 1][j - 1] + 1 if a == b else max(t[i - 1][j], t[i][j - 1])
    out, i, j = set(), len(ref), len(cand)
    while i and j:
        if ref[i - 1] == cand[j - 1]:
            i, j = i - 1, j - 1
            out.add(i)
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out


def test_rouge_lsum_against_a_plain_table(spark):
    import random
    from collections import Counter

    from chatscope.functions.lcs import lcs_places, union_lcs_hits
    from chatscope.operators.metrics import metrics_long, rouge_lsum_per_sample
    rng = random.Random(3)
    text = lambda: "\n".join(" ".join(rng.choice("abcde") * 2 for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 5)))
    rows, want = [], {}
    for k in range(150):
        r, p = text(), text()
        rs, ps = ([x.split() for x in t.split("\n")] for t in (r, p))
        assert all(lcs_places(x, y) == _table_places(x, y) for x in rs for y in ps)
        left_r, left_p, hits = Counter(sum(rs, [])), Counter(sum(ps, [])), 0
        for x in rs:
            for i in sorted(set().union(*(_table_places(x, y) for y in ps))):
                if left_r[x[i]] and left_p[x[i]]:
                    hits, left_r[x[i]], left_p[x[i]] = hits + 1, left_r[x[i]] - 1, left_p[x[i]] - 1
        assert union_lcs_hits(sum(rs, []), [len(x) for x in rs], sum(ps, []), [len(x) for x in ps]) == hits
        rows.append(("m", k, r, p))
        n, m = sum(map(len, rs)), sum(map(len, ps))
        want[k] = 2 * hits / (n + m) if hits else 0.0
    pairs = spark.createDataFrame(rows + [("m", 900, None, "aa"), ("m", 901, "aa", "")], "model string, sample_id long, reference string, prediction string")
    got = {r.sample_id: r.f1 for r in rouge_lsum_per_sample(pairs).collect()}
    assert all(abs(got[k] - v) < 1e-12 for k, v in want.items()) and got[900] == got[901] == 0.0
    for stem in (True, False):
        keys = {r.metric for r in metrics_long(pairs, bleu_=False, chrf_=False, rouge_keys=("rouge1", "rougeL", "rougeLsum"), stem=stem).collect()}
        assert keys == {"rouge_rouge1", "rouge_rougeL", "rouge_rougeLsum"}
    import pytest
    with pytest.raises(ValueError, match="rougeX"):
        metrics_long(pairs, rouge_keys=("rougeX",))
