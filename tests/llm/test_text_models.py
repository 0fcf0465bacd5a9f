import math
import zlib

import numpy as np
import pytest

from chatscope.llm import lang_id, masked_lm, quality_crf
from chatscope.llm.common import crc32_mod
from tests.conftest import SF_ORACLE, SF_SMALL


def held(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# ------------------------------------------------------------------ language ID
def slow_counts(text, n_buckets):
    s = " " + " ".join(text.lower().split()) + " "
    out = np.zeros(n_buckets, dtype=np.int64)
    shift = 32 - (n_buckets - 1).bit_length()
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            h = (ord(s[i]) + (n << 24)) & 0xFFFFFFFF
            for c in s[i + 1:i + n]:
                h = (h * 0x01000193 + ord(c)) & 0xFFFFFFFF
            h ^= h >> 15
            out[((h * 2654435761) & 0xFFFFFFFF) >> shift] += 1
    return out


@pytest.mark.parametrize("text", ["a", "Hällo  Wörld", "中文 text", "x" * 300, "\n"])
def test_bucket_counts_definition_and_pieces(text, monkeypatch):
    want = slow_counts(text, 1 << 10)
    assert (lang_id.bucket_counts(text, 1 << 10) == want).all()
    monkeypatch.setattr(lang_id, "_CHUNK", 7)  # long texts go in pieces
    assert (lang_id.bucket_counts(text, 1 << 10) == want).all()


def test_language_training_counts_everything_and_predicts_held_out(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    part = docs.where(crc32_mod("doc_id", 4) != 2)
    model = lang_id.train(part)
    rows = part.select("text", "lang").collect()
    langs = sorted({r.lang for r in rows})
    counts = {la: sum(lang_id.bucket_counts(r.text) for r in rows if r.lang == la) + 0.5 for la in langs}
    assert model.langs == tuple(langs)
    for k, la in enumerate(langs):
        assert np.allclose(model.log_prob[:, k], np.log(counts[la] / counts[la].sum()))
        assert math.isclose(model.log_prior[k], math.log(sum(r.lang == la for r in rows) / len(rows)))
    got = {r.doc_id: r for r in lang_id.classify(docs, model).collect()}
    test = [r for r in docs.collect() if held(r.doc_id, 4) == 2]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in test) >= 0.98 * len(test)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_odd_rows(odd_docs, no_docs):
    model = lang_id.train(odd_docs)
    got = lang_id.classify(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    for r, d in zip(got, odd_docs.collect(), strict=True):
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in d.text or ""))
        assert r.score == 0.0 if r.lang_pred == "und" else 0 < r.score <= 1
    none = lang_id.train(no_docs)
    assert {(r.lang_pred, r.score) for r in lang_id.classify(odd_docs, none).collect()} == {("und", 0.0)}
    assert lang_id.classify(no_docs, model).collect() == []
    kept = lang_id.keep_confident(odd_docs, model)
    assert kept.columns == odd_docs.columns and all(any(c.isalpha() for c in r.text) for r in kept.collect())


def test_language_filter_drops_unlearned_languages(spark):
    import corpus_pipeline
    base = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    odd = ["Быстрая коричневая лиса прыгает через ленивую собаку и бежит дальше в лес. " * 5,
           "素早い茶色の狐はのろまな犬を飛び越える。そして森へ走っていく。" * 6, "bcdfg hjklm npqrs tvwxz zxvbn mkjhg fdspq rtwcx " * 8]
    rows = [(10**6 + k, t, None, "s", len(t)) for k, t in enumerate(odd)]
    docs = base.unionByName(spark.createDataFrame(rows, base.schema))
    got = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF_ORACLE).select("doc_id").collect()}
    assert not any(10**6 + k in got for k in range(len(odd)))
    assert got == {r.doc_id for r in base.collect() if any(map(str.isalpha, r.text or ""))}  # learned languages stay


# ------------------------------------------------------------------ line field
def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(2)
    emit = rng.normal(size=(3, 5, 2))
    n = [5, 1, 3]
    mask = np.arange(5)[None, :] < np.array(n)[:, None]
    step, weight = rng.normal(size=(2, 2)), np.array([0.2, 1.0, 0.5])
    good, pairs = quality_crf.forward_backward(emit, mask, step, weight)
    want_pairs = np.zeros((2, 2))
    for d in range(3):
        z, marg, pair = 0.0, np.zeros(5), np.zeros((2, 2))
        for code in range(2 ** n[d]):
            y = [code >> k & 1 for k in range(n[d])]
            p = math.exp(sum(emit[d, k, y[k]] for k in range(n[d])) + sum(step[a, b] for a, b in zip(y, y[1:], strict=False)))
            z += p
            for k in range(n[d]):
                marg[k] += p * y[k]
            for a, b in zip(y, y[1:], strict=False):
                pair[a, b] += p
        assert np.allclose(good[d], marg / z)
        want_pairs += weight[d] * pair / z
    assert np.allclose(pairs, want_pairs)


def test_line_features_of_a_small_text(monkeypatch):
    text = "AB cd 12\n\nAB cd 12\n$$! x"
    f, w = quality_crf.line_features(text)
    names = quality_crf.LINE_FEATURES
    at = {n: names.index(n) for n in names}
    assert f.shape == (4, quality_crf.N_FEATURES) and w.tolist() == [8, 1, 8, 5]
    assert np.allclose(f[0, [at["upper"], at["lower"], at["digit"], at["space"]]], 2 / 8)
    assert np.allclose(f[3, [at["symbol"], at["bang"], at["space"]]], [2 / 5, 1 / 5, 1 / 5])
    assert f[:, at["seen_before"]].tolist() == [0, 0, 1, 0] and f[:, at["no_word"]].tolist() == [0, 1, 0, 0]
    m = len(names)
    assert (f[1:, m:2 * m] == f[:-1, :m]).all() and (f[:-1, 2 * m:3 * m] == f[1:, :m]).all()
    monkeypatch.setattr(quality_crf, "_PIECE", 3)  # long texts go in pieces
    assert np.allclose(quality_crf.line_features(text)[0], f)


def test_quality_held_out_and_odd_rows(spark, odd_docs, no_docs):
    docs, labels = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "labels"))
    field = quality_crf.train(docs, labels.where(crc32_mod("doc_id", 5) != 0))
    got = {r.doc_id: r for r in quality_crf.classify(docs, field).collect()}
    test = [(got[r.doc_id].score, r.quality) for r in labels.collect() if held(r.doc_id, 5) == 0]
    pos, neg = [s for s, q in test if q], [s for s, q in test if not q]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.97 and sum(s >= 0.3 for s in pos) >= 0.95 * len(pos)
    odd = quality_crf.classify(odd_docs, field).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in odd)
    scores = {}
    for r, d in zip(odd, odd_docs.collect(), strict=True):
        assert scores.setdefault(d.text or "", r.score) == pytest.approx(r.score)
    assert quality_crf.classify(no_docs, field).collect() == []
    assert quality_crf.keep_good(odd_docs, field).columns == odd_docs.columns
    empty = quality_crf.train(no_docs, labels.limit(0))
    assert {r.score for r in quality_crf.classify(odd_docs, empty).collect()} == {0.5}
    lines = quality_crf.label_lines(odd_docs, field)
    per_doc = {}
    for r in lines.where("doc_id = 1").collect():
        assert r.good == (r.probability >= 0.5)
        per_doc[r.line_no] = (r.line, r.probability)
    text = odd_docs.where("doc_id = 1").first().text
    assert [per_doc[k][0] for k in range(len(per_doc))] == text.split("\n")
    weighed = sum(max(len(x.encode()), 1) * p for x, p in per_doc.values()) / sum(max(len(x.encode()), 1) for x, _ in per_doc.values())
    assert weighed == pytest.approx(field.scores([text])[0])
    assert lines.count() == sum((r.text or "").count("\n") + 1 for r in odd_docs.collect())
    null_marks = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert quality_crf.train(odd_docs, null_marks).constant == 0.5


def test_quality_sample_has_one_row_per_id(spark, monkeypatch):
    rows = [(1, "good line here"), *[(1, f"good line {i}") for i in range(300)], (2, "### !!! ***"), (3, None), (3, "more good words")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id int, quality int")
    seen = []
    monkeypatch.setattr(quality_crf, "fit", lambda feats, y: seen.append((feats, y)))
    quality_crf.train(docs, labels)
    (feats, y), = seen
    assert y.tolist() == [1, 0, 1]
    for f, text in zip(feats, ["good line 0", "### !!! ***", "more good words"], strict=True):
        assert np.allclose(f, quality_crf.line_features(text)[0])


# ------------------------------------------------------------------ masked LM
def test_masked_lm_gradient():
    rng = np.random.default_rng(0)
    flat = masked_lm.untrained()
    ctx, tgt = rng.integers(0, masked_lm.VOCAB + 1, (40, 4)), rng.integers(0, masked_lm.VOCAB, 40)
    g = masked_lm.gradient(flat, ctx, tgt)
    for i in [*np.argsort(-abs(g))[:5], *rng.choice(np.flatnonzero(g), 20)]:
        up, down = flat.astype(np.float64), flat.astype(np.float64)
        up[i] += 1e-4
        down[i] -= 1e-4
        num = (masked_lm.log_probs(up, ctx, tgt).mean() - masked_lm.log_probs(down, ctx, tgt).mean()) / 2e-4
        assert g[i] == pytest.approx(num, rel=1e-2, abs=1e-5)


def slow_log_prob(flat, ids):
    """Sum over positions of log p(class) + log p(member | class), one word at a time."""
    v = masked_lm.views(flat.astype(np.float64))
    line, total = [masked_lm.PAD] * 2 + list(ids) + [masked_lm.PAD] * 2, 0.0
    for i in range(2, len(line) - 2):
        x = np.concatenate([v["emb"][line[i + o]] for o in (-2, -1, 1, 2)])
        h = np.tanh(x @ v["w1"] + v["b1"])
        c, m = divmod(line[i], masked_lm.SIDE)
        for logits, k in ((h @ v["wc"] + v["bc"], c), (h @ v["ww"][c] + v["bw"][c], m)):
            total += logits[k] - np.log(np.exp(logits).sum())
    return total


def test_masked_lm_against_brute_force_and_unigrams(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    vocab = masked_lm.vocabulary(docs)
    rows = docs.collect()
    counts = {}
    for r in rows:
        for w in masked_lm.split_words(r.text):
            counts[w] = counts.get(w, 0) + 1
    top = sorted(counts, key=lambda w: (-counts[w], w))[:masked_lm.FREQUENT]
    assert dict(vocab) == {w: k for k, w in enumerate(top)}
    weights = masked_lm.train(docs, vocab)
    got = {r.doc_id: r for r in masked_lm.score(docs, vocab, weights).collect()}
    for r in rows[:5]:
        assert got[r.doc_id].log_prob == pytest.approx(slow_log_prob(weights, vocab.ids(r.text)[:]), rel=1e-3)
    ids = np.concatenate([vocab.ids(r.text) for r in rows])
    p = np.bincount(ids, minlength=masked_lm.VOCAB) / len(ids)
    assert sum(r.log_prob for r in got.values()) / len(ids) > np.log(p[ids]).mean()  # neighbours tell something
    odd = masked_lm.score(odd_docs, vocab, weights).collect()
    for r, d in zip(odd, odd_docs.collect(), strict=True):
        n = len(masked_lm.split_words(d.text))
        assert r.n_words == n and (r.mean_log_prob is None) == (n == 0) and (n or r.log_prob == 0.0)
    assert masked_lm.score(no_docs, vocab, weights).collect() == []
    none = masked_lm.vocabulary(no_docs)
    assert len(none) == 0 and masked_lm.train(no_docs, none).shape == (masked_lm.N_WEIGHTS,)
    masked_lm.train(odd_docs, masked_lm.vocabulary(odd_docs))


def test_masked_lm_scores_the_words_themselves(spark, odd_docs, no_docs):
    common = " ".join(f"c{i}" for i in range(masked_lm.FREQUENT))
    rows = [(k, common) for k in range(6)] + [(10, "c1 ztion c2 c3"), (11, "c1 qtion c2 c3"), (None, "ztion ztion"), (12, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    vocab = masked_lm.vocabulary(docs)
    weights = masked_lm.train(docs, vocab)
    got = {r.doc_id: r for r in masked_lm.score_words(docs, vocab, weights).collect()}
    assert got[10].log_prob - got[11].log_prob == pytest.approx(math.log(3))  # one ending, three times as frequent
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    vocab = masked_lm.vocabulary(real)
    weights = masked_lm.train(real, vocab)
    texts = {r.doc_id: r.text for r in real.collect()}
    n, total = {}, {}
    for t in texts.values():
        for w, i in zip(masked_lm.split_words(t), vocab.ids(t), strict=True):
            n[w], total[i] = n.get(w, 0) + 1, total.get(i, 0) + 1
    ids = {r.doc_id: r.log_prob for r in masked_lm.score(real, vocab, weights).collect()}
    whole = {r.doc_id: r for r in masked_lm.score_words(real.repartition(2), vocab, weights, block_words=500).collect()}
    assert whole.keys() == texts.keys()
    for d, t in texts.items():
        share = sum(math.log(n[w] / total[i]) for w, i in zip(masked_lm.split_words(t), vocab.ids(t), strict=True))
        assert whole[d].log_prob == pytest.approx(ids[d] + share, rel=1e-6)
    odd = masked_lm.score_words(odd_docs, vocab, weights).collect()
    assert sorted((repr(r.doc_id), r.n_words) for r in odd) == sorted(
        (repr(r.doc_id), len(masked_lm.split_words(r.text))) for r in odd_docs.collect())
    assert all((r.mean_log_prob is None) == (r.n_words == 0) and (r.n_words or r.log_prob == 0.0) for r in odd)
    assert masked_lm.score_words(no_docs, vocab, weights).collect() == []


def test_masked_lm_packs_numbers():
    assert masked_lm._unpack(masked_lm._pack([70_000, 3, 3, 1 << 24])).tolist() == [3, 3, 70_000, 1 << 24]
    assert masked_lm._unpack(masked_lm._pack([])).tolist() == []


def test_shard_average_is_weighted():
    import pyarrow as pa
    a, b = np.ones(masked_lm.N_WEIGHTS, "<f4"), np.full(masked_lm.N_WEIGHTS, 4, "<f4")
    batch = pa.RecordBatch.from_pydict({"shard": [1, 2], "words": [2, 1], "weights": [a.tobytes(), b.tobytes()]})
    (out,) = masked_lm._average(iter([batch]))
    assert out["words"].to_pylist() == [3] and np.allclose(np.frombuffer(out["weights"][0].as_py(), "<f4"), 2)
