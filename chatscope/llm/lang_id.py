"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts (language, bucket) pairs over *all* training rows in Spark and
collects only the summed table: at most ``languages x n_buckets`` numbers,
whatever the input size. The log-probability matrix is broadcast, and each
Arrow batch is scored in numpy from the sparse bucket counts of its texts.

Defined results: a null text or one without any letter is ``und`` with score
0.0; so is every text when nothing could be learned (no training rows). Ties go
to the alphabetically first language. Rows without a language are not trained on.

The posterior only compares the learned languages with each other and is close to 1 for nearly any text, so
it says nothing about texts in none of them. For a filter, ``with_floors`` learns from the same rows how probable
texts of each language are: the mean log-probability per n-gram of every training row under its own language.
A text less probable under its best language than that language's mean by ``SPREADS`` standard deviations
is in no learned language. At most one in ``SPREADS ** 2`` training rows can lie so low, whatever their distribution.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
MIN_SCORE = 0.3  # a filter's posterior: below it hardly any language stands out
SPREADS = 10.0  # a filter's standard deviations below the mean of a language's training rows
MIN_SPREAD = 0.25  # nats per n-gram; the least standard deviation assumed, for languages of few or equal rows
N_BUCKETS = 1 << 13
ORDERS = (1, 2, 3)
_MULT = np.uint32(2654435761)  # Knuth's multiplicative constant
_CHUNK = 1 << 20


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def bucket_counts(text: str, n_buckets: int = N_BUCKETS) -> np.ndarray:
    """Counts of the hashed 1-3 character n-grams of the lower-cased text.

    White-space runs count as one space, and a space frames the text. Long
    texts are walked in overlapping pieces, so memory stays bounded.
    """
    s = " " + " ".join(text.lower().split()) + " "
    cp = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    shift = np.uint32(32 - (n_buckets - 1).bit_length())
    out = np.zeros(n_buckets, dtype=np.int64)
    for at in range(0, len(cp), _CHUNK):
        for n in ORDERS:
            part = cp[at:at + _CHUNK + n - 1]
            if len(part) < n:
                continue
            h = part[: len(part) - n + 1] * np.uint32(1) + np.uint32(n << 24)
            for k in range(1, n):
                h = h * np.uint32(0x01000193) + part[k: len(part) - n + 1 + k]
            h ^= h >> np.uint32(15)
            out += np.bincount((h * _MULT) >> shift, minlength=n_buckets)
    return out


@dataclass(frozen=True)
class LangModel:
    langs: tuple[str, ...]
    log_prior: np.ndarray  # (languages,)
    log_prob: np.ndarray  # (n_buckets, languages)
    floor: np.ndarray | None = None  # (languages,) least mean log-probability per n-gram of a text in the language

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, posterior, and whether the text is as probable as texts of that language are (true without floors)."""
        if not self.langs or not has_letter(text):
            return UNDETERMINED, 0.0, False
        counts = bucket_counts(text, self.log_prob.shape[0])
        hit = np.flatnonzero(counts)
        scores = self.log_prior + counts[hit] @ self.log_prob[hit]
        p = np.exp(scores - scores.max())
        best = int(scores.argmax())
        fits = self.floor is None or (scores[best] - self.log_prior[best]) / counts.sum() >= self.floor[best]
        return self.langs[best], float(p[best] / p.sum()), bool(fits)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", n_buckets: int = N_BUCKETS,
          smoothing: float = 0.5) -> LangModel:
    """Learn from every row of ``docs`` that has a language."""
    rows = docs.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for b in batches:
            for la, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = t.as_py()
                if not has_letter(t):
                    continue
                if la not in sums:
                    sums[la], n_docs[la] = np.zeros(n_buckets, dtype=np.int64), 0
                sums[la] += bucket_counts(t, n_buckets)
                n_docs[la] += 1
        for la, v in sums.items():
            hit = np.flatnonzero(v)
            # bucket -1 carries the number of documents
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([la] * (len(hit) + 1), pa.string()),
                "bucket": pa.array(np.append(hit, -1), pa.int32()),
                "n": pa.array(np.append(v[hit], n_docs[la]), pa.int64())})

    summed = rows.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n"))
    got = summed.toArrow()  # at most languages x (n_buckets + 1) rows
    names = got.column("lang").to_pylist()
    langs = tuple(sorted(set(names)))
    counts, docs_of = np.zeros((n_buckets, len(langs))), np.ones(len(langs))
    at = np.array([langs.index(x) for x in names], dtype=np.int64)
    bucket, n = np.asarray(got.column("bucket")), np.asarray(got.column("n"))
    is_doc = bucket < 0
    docs_of[at[is_doc]] = n[is_doc]
    counts[bucket[~is_doc], at[~is_doc]] = n[~is_doc]
    smooth = counts + smoothing
    return LangModel(langs, np.log(docs_of / max(docs_of.sum(), 1.0)), np.log(smooth / smooth.sum(axis=0, keepdims=True)))


def with_floors(docs: DataFrame, model: LangModel, text: str = "text", lang: str = "lang") -> LangModel:
    """``model`` with a floor for each language, learned from every row of ``docs`` that has a language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        sums = np.zeros((len(m.langs), 3))
        at = {la: k for k, la in enumerate(m.langs)}
        for b in batches:
            for la, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = t.as_py()
                if la in at and has_letter(t):
                    counts = bucket_counts(t, m.log_prob.shape[0])
                    hit = np.flatnonzero(counts)
                    x = counts[hit] @ m.log_prob[hit, at[la]] / counts.sum()
                    sums[at[la]] += 1, x, x * x
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(len(sums))), "n": pa.array(sums[:, 0]),
                                          "x": pa.array(sums[:, 1]), "xx": pa.array(sums[:, 2])})

    summed = rows.mapInArrow(moments, "k bigint, n double, x double, xx double").groupBy("k").agg(
        *(F.sum(c).alias(c) for c in ("n", "x", "xx")))
    floor = np.full(len(model.langs), -np.inf)
    for r in summed.collect():  # one row per language
        if r.n:
            mean = r.x / r.n
            floor[r.k] = mean - SPREADS * max(max(r.xx / r.n - mean * mean, 0.0) ** 0.5, MIN_SPREAD)
    return replace(model, floor=floor)


def predictor(docs: DataFrame, model: LangModel) -> Column:
    """A column expression ``struct<lang_pred, score, fits>`` of a text column, model broadcast once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, fits boolean")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for s in batches:
            yield pd.DataFrame([m.judge(t) for t in s], columns=["lang_pred", "score", "fits"])

    return language


def classify(docs: DataFrame, model: LangModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)``, one row per input row."""
    p = predictor(docs, model)
    return docs.select(F.col(doc_id).alias("doc_id"), p(F.col(text).cast("string")).alias("p")).select(
        "doc_id", "p.lang_pred", "p.score")


def keep_confident(docs: DataFrame, model: LangModel, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """Rows whose language is known with a posterior of at least ``min_score`` and, if the model has
    floors, whose text is no less probable than its language's floor; all columns kept.
    """
    from chatscope.llm.common import free_name
    tmp = free_name(docs, "_lang")
    p = predictor(docs, model)
    return docs.withColumn(tmp, p(F.col(text).cast("string"))).where(
        (F.col(f"{tmp}.lang_pred") != UNDETERMINED) & (F.col(f"{tmp}.score") >= min_score)
        & F.col(f"{tmp}.fits")).drop(tmp)
