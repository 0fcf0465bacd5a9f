"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is labelled good or bad. Its emission scores are linear in the
features of the line itself and of its two neighbours; a 2x2 table scores the
step from one line's label to the next. Forward-backward gives each line's
marginal of being good, and a document's score is the mean of these marginals
weighted by line length. Training maximises the conditional likelihood, each
line of a labelled document bearing the document's label.

The field is fitted on a bounded sample: at most ``SAMPLE_DOCS`` labelled
documents, those with the smallest hashes of their ids, without those of more than
``SAMPLE_CHARS`` characters or ``SAMPLE_LINES`` lines; of documents that repeat an id, the one
with the smallest text. Scoring covers every line of every text.

Defined results: null and empty texts are one empty line; a document with
several labels counts with their mean (0.5 or more is good); rows with a null label or
id are not trained on; with no labelled rows, or of one kind only, every score is the share of
good labels (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatscope.llm.common import free_name

SAMPLE_DOCS = 6000
SAMPLE_CHARS = 50_000
SAMPLE_LINES = 300
THRESHOLD = 0.3
_PIECE = 4 << 20

_SYMBOLS = b"#*$%&|<>=~^_{}[]\\/@+`"
_CLASSES = {  # byte classes whose shares of a line are features
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789",
    "space": bytes(range(9, 14)) + b" ", "symbol": _SYMBOLS, "pipe": b"|", "bang": b"!?", "stop": b".,;:",
    "other": bytes(range(128, 256)),
}
_TABLE = np.zeros((256, len(_CLASSES)), dtype=bool)
for _k, _members in enumerate(_CLASSES.values()):
    _TABLE[list(_members), _k] = True

LINE_FEATURES = [*_CLASSES, "log_bytes", "word_length", "distinct_words", "repeats_word", "tail_symbol", "tail_bang",
                 "seen_before", "no_word"]
N_FEATURES = 3 * len(LINE_FEATURES) + 3  # own, previous, next; bias, first line, last line


def _word_features(line: bytes) -> tuple[float, float, float, float, float, float]:
    words = line.split()
    n = len(words)
    if not n:
        return 0.0, 1.0, 0.0, 0.0, 0.0, 1.0
    distinct = len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:]))
    tails = bytes(w[-1] for w in words)
    return (min(sum(map(len, words)) / n, 40.0) / 10, distinct / n ** 0.9, same / n,
            (n - len(tails.translate(None, _SYMBOLS))) / n, tails.count(b"!") / n, 0.0)


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features ``(lines, N_FEATURES)`` and weights (UTF-8 bytes of the line, at least 1) of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    lines = raw.split(b"\n")
    size = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    own = np.zeros((len(lines), len(LINE_FEATURES)), dtype=np.float32)
    counts = np.zeros((len(lines), len(_CLASSES)), dtype=np.int64)
    at = np.frombuffer(raw, dtype=np.uint8)
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    for i in range(0, len(at), _PIECE):  # bounded memory for very long texts
        part = _TABLE[at[i:i + _PIECE]]
        line = np.searchsorted(start, i, side="right") - 1
        last = np.searchsorted(start, min(i + _PIECE, len(at)) - 1, side="right")
        cuts = np.maximum(start[line:last] - i, 0)
        counts[line:last] += np.add.reduceat(part, cuts, axis=0, dtype=np.int64)
    c = len(_CLASSES)
    newline = list(_CLASSES).index("space")
    counts[:-1, newline] -= 1  # the \n itself
    own[:, :c] = counts / np.maximum(size, 1)[:, None]
    own[:, c] = np.log1p(size) / 6
    own[:, c + 1:c + 6] = 0
    seen: set[bytes] = set()
    for k, x in enumerate(lines):
        f = _word_features(x)
        own[k, c + 1:c + 6] = f[:5]
        own[k, c + 6] = x in seen and bool(x)
        own[k, c + 7] = f[5]
        seen.add(x)
    out = np.zeros((len(lines), N_FEATURES), dtype=np.float32)
    m = len(LINE_FEATURES)
    out[:, :m] = own
    out[1:, m:2 * m] = own[:-1]
    out[:-1, 2 * m:3 * m] = own[1:]
    out[:, 3 * m] = 1
    out[0, 3 * m + 1] = out[-1, 3 * m + 2] = 1
    return out, np.maximum(size, 1)


def _pad(feats: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Right-padded lengths: ``(documents, longest, N_FEATURES)`` and the mask of real lines."""
    n = np.array([len(f) for f in feats])
    x = np.zeros((len(feats), int(n.max()), N_FEATURES), dtype=np.float32)
    for i, f in enumerate(feats):
        x[i, : len(f)] = f
    return x, np.arange(x.shape[1])[None, :] < n[:, None]


def forward_backward(emit: np.ndarray, mask: np.ndarray, step: np.ndarray, weight: np.ndarray | None = None):
    """Marginals of label 1 of right-padded chains and, given chain weights, the weighted expected label pairs.

    ``emit`` is (documents, lines, 2), ``step`` the 2x2 scores of label pairs.
    """
    d, t, _ = emit.shape
    alpha = np.zeros((d, t, 2))
    beta = np.zeros((d, t, 2))
    alpha[:, 0] = emit[:, 0]
    for k in range(1, t):
        prev = alpha[:, k - 1]
        new = np.logaddexp(prev[:, :1] + step[0], prev[:, 1:] + step[1]) + emit[:, k]
        alpha[:, k] = np.where(mask[:, k, None], new, prev)
    for k in range(t - 2, -1, -1):
        nxt = beta[:, k + 1] + emit[:, k + 1]
        new = np.logaddexp(step[:, 0] + nxt[:, :1], step[:, 1] + nxt[:, 1:])
        beta[:, k] = np.where(mask[:, k + 1, None], new, beta[:, k + 1])
    log_z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    good = np.exp(np.minimum(alpha[:, :, 1] + beta[:, :, 1] - log_z[:, None], 0)) * mask
    pairs = np.zeros((2, 2))
    if t > 1 and weight is not None:
        both = mask[:, 1:, None, None] * weight[:, None, None, None]
        p = (alpha[:, :-1, :, None] + step + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - log_z[:, None, None, None])
        pairs = (np.exp(np.minimum(p, 0)) * both).sum(axis=(0, 1))
    return good, pairs


@dataclass(frozen=True)
class LineField:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray  # (N_FEATURES,) score of label 1 over label 0
    step: np.ndarray  # (2, 2)
    constant: float | None = None  # the score where nothing could be learned

    def line_marginals(self, feats: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of good for every line of each document."""
        if self.constant is not None:
            return [np.full(len(f), self.constant) for f in feats]
        out: list[np.ndarray] = [np.empty(0)] * len(feats)
        order = sorted(range(len(feats)), key=lambda i: len(feats[i]))
        score = [((f - self.mean) / self.scale) @ self.weight for f in feats]
        at = 0
        while at < len(order):  # documents of like length together, so that padding stays small
            longest = max(8, 2 * len(feats[order[at]]))
            end = at + 1
            while end < len(order) and len(feats[order[end]]) <= longest and end - at < 512:
                end += 1
            some = order[at:end]
            n = np.array([len(feats[i]) for i in some])
            emit = np.zeros((len(some), int(n.max()), 2))
            for row, i in enumerate(some):
                emit[row, : n[row], 1] = score[i]
            mask = np.arange(emit.shape[1])[None, :] < n[:, None]
            good, _ = forward_backward(emit, mask, self.step)
            for row, i in enumerate(some):
                out[i] = good[row, : n[row]]
            at = end
        return out

    def scores(self, texts) -> np.ndarray:
        both = [line_features(t) for t in texts]
        good = self.line_marginals([f for f, _ in both])
        return np.array([np.clip(g @ w / w.sum(), 0, 1) for g, (_, w) in zip(good, both, strict=True)], dtype=float)


def fit(feats: list[np.ndarray], labels: np.ndarray, rounds: int = 150, rate: float = 0.1, ridge: float = 1e-3) -> LineField:
    """Maximum conditional likelihood by full-batch Adam; documents weigh alike, whatever their length."""
    zero, flat = np.zeros(N_FEATURES), np.zeros((2, 2))
    if not len(labels) or labels.min() == labels.max():
        return LineField(zero, zero + 1, zero, flat, float(labels.mean()) if len(labels) else 0.5)
    rows = np.concatenate(feats)
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    bias = 3 * len(LINE_FEATURES)
    mean[bias], scale[bias] = 0, 1
    groups = []
    order = np.argsort([len(f) for f in feats], kind="stable")
    for part in np.array_split(order, max(1, len(order) // 500)):
        x, mask = _pad([(feats[i] - mean) / scale for i in part])
        groups.append((x * mask[:, :, None], mask, labels[part].astype(float)))
    par = np.zeros(N_FEATURES + 4)
    m, v = np.zeros_like(par), np.zeros_like(par)
    for r in range(1, rounds + 1):
        w, step = par[:N_FEATURES], par[N_FEATURES:].reshape(2, 2)
        grad = np.zeros_like(par)
        for x, mask, y in groups:
            emit = np.zeros((*mask.shape, 2))
            emit[:, :, 1] = x @ w.astype(np.float32)
            share = 1.0 / mask.sum(axis=1)  # a document's lines together weigh one
            good, pairs = forward_backward(emit, mask, step, share)
            diff = (mask * y[:, None] - good) * share[:, None]
            grad[:N_FEATURES] += np.einsum("dtf,dt->f", x, diff.astype(np.float32))
            stay = mask.sum(axis=1) - 1
            grad[N_FEATURES:] += (_observed(y, stay, share) - pairs).ravel()
        grad = grad / len(labels) - ridge * par
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        par = par + rate * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.999 ** r)) + 1e-8)
    return LineField(mean, scale, par[:N_FEATURES], par[N_FEATURES:].reshape(2, 2))


def _observed(y: np.ndarray, stay: np.ndarray, share: np.ndarray) -> np.ndarray:
    out = np.zeros((2, 2))
    out[1, 1] = (stay * share * y).sum()
    out[0, 0] = (stay * share * (1 - y)).sum()
    return out


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, sample_lines: int = SAMPLE_LINES) -> LineField:
    """Fit on the bounded sample of ``labels(doc_id, <label>)`` joined to ``docs``.

    The features of the sample are computed in Spark; what reaches the driver is
    bounded by ``sample_docs`` and ``sample_lines``.
    """
    marks = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(doc_id).alias("id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    chosen = marks.orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).where(
        (F.coalesce(F.length("text"), F.lit(0)) <= sample_chars)
        & (F.coalesce(F.size(F.split("text", "\n")), F.lit(1)) <= sample_lines))
    # the sample has at most sample_docs rows of two numbers; of a repeated id one row counts
    picked = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [line_features(t.as_py())[0].astype("<f4").tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(f, pa.binary()), b.column(2)],
                                             names=["id", "f", "y"])

    id_type = picked.schema["id"].dataType.simpleString()
    got = picked.mapInArrow(features, f"id {id_type}, f binary, y int").toArrow()
    got = got.sort_by([("id", "ascending"), ("f", "ascending")])
    feats = [np.frombuffer(x.as_py(), "<f4").reshape(-1, N_FEATURES) for x in got["f"]]
    return fit(feats, np.asarray(got["y"], dtype=np.int64))


def scorer(docs: DataFrame, field: LineField) -> Column:
    """A column function text -> score, the field broadcast once."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("double")
    def quality_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = shared.value
        for s in batches:
            parts = [f.scores(s.iloc[i:i + 512]) for i in range(0, len(s), 512)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return quality_score


def label_lines(docs: DataFrame, field: LineField, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, line_no, line, probability, good)``: every line of every text with its marginal and label."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                texts = [t or "" for t in b.column(1).slice(at, 256).to_pylist()]
                good = shared.value.line_marginals([line_features(t)[0] for t in texts])
                n = [len(g) for g in good]
                p = np.concatenate(good)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(np.repeat(np.arange(at, at + len(n)), n))),
                    pa.array(np.concatenate([np.arange(k) for k in n])), pa.array([x for t in texts for x in t.split("\n")], pa.string()),
                    pa.array(p), pa.array(p >= 0.5)], names=["doc_id", "line_no", "line", "probability", "good"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(label, f"doc_id {id_type}, line_no bigint, line string, probability double, good boolean")


def classify(docs: DataFrame, field: LineField, doc_id: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)``, one row per input row."""
    s = scorer(docs, field)
    return docs.select(F.col(doc_id).alias("doc_id"), s(F.col(text).cast("string")).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, field: LineField, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``; all columns kept."""
    tmp = free_name(docs, "_score")
    return docs.withColumn(tmp, scorer(docs, field)(F.col(text).cast("string"))).where(
        F.col(tmp) >= threshold).drop(tmp)
