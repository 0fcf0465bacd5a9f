"""Text-generation metrics over a pairs table.

Input: ``(model, sample_id, reference, prediction)`` – one row per scored
sample (references and predictions paired by key, never by position).

Plan for the n-gram metrics (ROUGE-N, BLEU, chrF): the narrow pairs table
is spread once by ``(model, sample_id)``; an Arrow UDF counts the n-grams of
each row and their clipped matches inside its batch (``functions/grams.py``), so
n-grams are never rows: nothing is sorted, spilled or shuffled but the texts
and per-model partial sums. A single huge text is one row and one task whatever
the plan. Totals come from the lengths.

ROUGE-L needs an LCS per sample: an Arrow UDF too (bit-parallel).
Embedding match is a blocked nested loop: the vectors are dealt once by sample, packed into
bounded chunks per sample and side, and joined by sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatscope.functions import ngrams as NG
from chatscope.functions.grams import clipped_counts_of
from chatscope.operators.records import fence
from chatscope.session import materialize, plan_bytes

SAMPLE = ["model", "sample_id"]


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


BYTES_PER_TASK = 32 << 20


def work_partitions(df: DataFrame) -> int:
    """Partition count for stages whose rows explode into many more: by the input's estimated size.

    One partition for every ``BYTES_PER_TASK`` of the plan's size estimate, and at
    least the session's shuffle width, without a ceiling. An explicit count
    keeps AQE from merging a shuffle that is small in bytes but not in work.
    """
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-plan_bytes(df) // BYTES_PER_TASK))


def _keyed(pairs: DataFrame) -> DataFrame:
    """Narrow pairs, hash-partitioned by sample; a sample may have several rows.

    Every metric builds the same exchange over the same input, so Spark runs it once for all of them.
    """
    return pairs.select(*SAMPLE, "prediction", "reference").repartition(work_partitions(pairs), *SAMPLE)


def _tokenised(pairs: DataFrame, tok, stem: bool = False) -> DataFrame:
    """Narrow token table, partitioned by sample."""
    t = _keyed(pairs).select(*SAMPLE, tok(F.col("prediction")).alias("pt"), tok(F.col("reference")).alias("rt"))
    if stem:
        from chatscope.functions.porter import stem_tokens_udf
        t = t.select(*SAMPLE, stem_tokens_udf("pt").alias("pt"), stem_tokens_udf("rt").alias("rt"))
    return t


def _gram_counts(tok: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    """Per row and order ``n``: clipped matches plus hypothesis/reference totals.

    ``pt``/``rt`` are token lists, or texts for n-grams of code points.
    """
    return tok.select(*SAMPLE, F.inline(clipped_counts_of(F.col("pt"), F.col("rt"), orders)))


# ------------------------------------------------------------------ ROUGE-N
def rouge_n_per_sample(pairs: DataFrame, orders: tuple[int, ...] = (1, 2), stem: bool = False) -> DataFrame:
    """Per ``(model, sample_id, n)``: precision, recall, F1 (0 when a side is empty)."""
    j = _gram_counts(_tokenised(pairs, NG.rouge_tokens, stem), orders)
    p = F.col("match") / F.greatest(F.col("hyp"), F.lit(1))
    r = F.col("match") / F.greatest(F.col("ref"), F.lit(1))
    return j.select(*SAMPLE, "n", p.alias("precision"), r.alias("recall"), _f1(p, r).alias("f1"))


def rouge_n(pairs: DataFrame, orders: tuple[int, ...] = (1, 2), stem: bool = False) -> DataFrame:
    """Corpus mean F1 per model and order → ``(model, metric, value)``."""
    s = rouge_n_per_sample(pairs, orders, stem)
    return s.groupBy("model", "n").agg(F.avg("f1").alias("value")).select(
        "model", F.concat(F.lit("rouge_rouge"), F.col("n").cast("string")).alias("metric"), "value")


# ------------------------------------------------------------------ ROUGE-L
def rouge_l_per_sample(pairs: DataFrame, stem: bool = False) -> DataFrame:
    """LCS-based P/R/F1 per sample (LCS by the bit-parallel Arrow UDF)."""
    from chatscope.functions.lcs import lcs_udf
    tok = _tokenised(pairs, NG.rouge_tokens, stem)
    lcs = lcs_udf(F.col("rt"), F.col("pt"))
    t = tok.select(*SAMPLE, F.size("pt").alias("np"), F.size("rt").alias("nr"), lcs.alias("lcs"))
    p = F.when(F.col("np") > 0, F.col("lcs") / F.col("np")).otherwise(0.0)
    r = F.when(F.col("nr") > 0, F.col("lcs") / F.col("nr")).otherwise(0.0)
    ok = (F.col("np") > 0) & (F.col("nr") > 0)
    return t.select(*SAMPLE, "lcs", F.when(ok, p).otherwise(0.0).alias("precision"),
                    F.when(ok, r).otherwise(0.0).alias("recall"), F.when(ok, _f1(p, r)).otherwise(0.0).alias("f1"))


def rouge_l(pairs: DataFrame, stem: bool = False) -> DataFrame:
    """Corpus mean ROUGE-L F1 per model."""
    s = rouge_l_per_sample(pairs, stem)
    return s.groupBy("model").agg(F.avg("f1").alias("value")).select("model", F.lit("rouge_rougeL").alias("metric"), "value")


def rouge_lsum_per_sample(pairs: DataFrame, stem: bool = False) -> DataFrame:
    """Summary-level ROUGE-L per sample: sentences are lines, hits come from the union of their common subsequences."""
    from chatscope.functions.lcs import union_lcs_udf
    lines = lambda c: F.transform(F.split(F.coalesce(F.col(c), F.lit("")), "\n"), NG.rouge_tokens)
    t = _keyed(pairs).select(*SAMPLE, lines("prediction").alias("p"), lines("reference").alias("r"))
    sizes = lambda c: F.transform(c, lambda x: F.size(x))
    t = t.select(*SAMPLE, F.flatten("p").alias("pt"), sizes("p").alias("ps"), F.flatten("r").alias("rt"), sizes("r").alias("rs"))
    if stem:
        from chatscope.functions.porter import stem_tokens_udf
        t = t.select(*SAMPLE, stem_tokens_udf("pt").alias("pt"), "ps", stem_tokens_udf("rt").alias("rt"), "rs")
    t = t.select(*SAMPLE, F.size("pt").alias("np"), F.size("rt").alias("nr"), union_lcs_udf("rt", "rs", "pt", "ps").alias("hits"))
    share = lambda n: F.when((F.col("np") > 0) & (F.col("nr") > 0), F.col("hits") / F.col(n)).otherwise(0.0)
    return t.select(*SAMPLE, "hits", share("np").alias("precision"), share("nr").alias("recall"),
                    _f1(share("np"), share("nr")).alias("f1"))


def rouge_lsum(pairs: DataFrame, stem: bool = False) -> DataFrame:
    """Corpus mean summary-level ROUGE-L F1 per model."""
    s = rouge_lsum_per_sample(pairs, stem)
    return s.groupBy("model").agg(F.avg("f1").alias("value")).select("model", F.lit("rouge_rougeLsum").alias("metric"), "value")


# --------------------------------------------------------------------- BLEU
def bleu_stats(pairs: DataFrame, max_order: int = 4) -> DataFrame:
    """Corpus sums per model: ``match_n``, ``total_n`` (n=1..4), ``sys_len``, ``ref_len``."""
    orders = tuple(range(1, max_order + 1))
    tok = _tokenised(pairs, NG.bleu13a_tokens)
    per = _gram_counts(tok, orders).groupBy("model").agg(
        *[F.sum(F.when(F.col("n") == n, F.col("match")).otherwise(0)).alias(f"match_{n}") for n in orders],
        *[F.sum(F.when(F.col("n") == n, F.col("hyp")).otherwise(0)).alias(f"total_{n}") for n in orders],
        F.sum(F.when(F.col("n") == 1, F.col("hyp")).otherwise(0)).alias("sys_len"),
        F.sum(F.when(F.col("n") == 1, F.col("ref")).otherwise(0)).alias("ref_len"))
    return per


def bleu_from_stats(stats: DataFrame, max_order: int = 4) -> DataFrame:
    """Score from corpus sums: exponential smoothing for zero-match orders, brevity penalty."""
    orders = range(1, max_order + 1)
    any_match = F.lit(False)
    for n in orders:
        any_match = any_match | (F.col(f"match_{n}") > 0)
    log_sum = F.lit(0.0)
    zero_total = F.lit(False)
    k = F.lit(0)  # running count of zero-match orders (smoothing exponent)
    for n in orders:
        m, t = F.col(f"match_{n}"), F.col(f"total_{n}")
        k = k + F.when(m == 0, 1).otherwise(0)
        p = F.when(m > 0, m / t).otherwise(F.lit(1.0) / (F.pow(F.lit(2.0), k) * t))
        zero_total = zero_total | (t == 0)
        log_sum = log_sum + F.log(F.when(t > 0, p).otherwise(F.lit(1.0)))
    sys_len, ref_len = F.col("sys_len"), F.col("ref_len")
    bp = F.when(sys_len >= ref_len, F.lit(1.0)).when(sys_len > 0, F.exp(1 - ref_len / sys_len)).otherwise(0.0)
    score = F.when(~any_match | zero_total, F.lit(0.0)).otherwise(bp * F.exp(log_sum / max_order))
    return stats.select("model", F.lit("bleu").alias("metric"), score.alias("value"))


def bleu(pairs: DataFrame) -> DataFrame:
    """Corpus BLEU (one reference per segment), as a fraction."""
    return bleu_from_stats(bleu_stats(pairs))


# --------------------------------------------------------------------- chrF
def chrf_stats(pairs: DataFrame, order: int = 6) -> DataFrame:
    """Corpus sums per model and order: hypothesis, reference and matching char n-grams."""
    orders = tuple(range(1, order + 1))
    per = _gram_counts(_tokenised(pairs, NG.chrf_text), orders)
    # as sacreBLEU: a segment whose reference has no n-gram of an order adds no hypothesis n-grams of it
    per = per.withColumn("hyp", F.when(F.col("ref") > 0, F.col("hyp")).otherwise(F.lit(0)))
    return per.groupBy("model", "n").agg(F.sum("hyp").alias("hyp"), F.sum("ref").alias("ref"),
                                         F.sum("match").alias("match"))


def chrf_from_stats(stats: DataFrame, beta: float = 2.0) -> DataFrame:
    """Average P and R over orders where both sides have n-grams, then F-beta."""
    both = (F.col("hyp") > 0) & (F.col("ref") > 0)
    agg = stats.groupBy("model").agg(
        F.sum(F.when(both, F.col("match") / F.col("hyp")).otherwise(0.0)).alias("sp"),
        F.sum(F.when(both, F.col("match") / F.col("ref")).otherwise(0.0)).alias("sr"),
        F.sum(F.when(both, 1).otherwise(0)).alias("eff"))
    p = F.when(F.col("eff") > 0, F.col("sp") / F.col("eff")).otherwise(0.0)
    r = F.when(F.col("eff") > 0, F.col("sr") / F.col("eff")).otherwise(0.0)
    b2 = beta * beta
    f = F.when(p + r > 0, (1 + b2) * p * r / (b2 * p + r)).otherwise(0.0)
    return agg.select("model", F.lit("chrf").alias("metric"), f.alias("value"))


def chrf(pairs: DataFrame) -> DataFrame:
    """Corpus chrF (character 6-grams, beta 2), as a fraction."""
    return chrf_from_stats(chrf_stats(pairs))


# ----------------------------------------------------------- embedding match
def _packed(vectors: DataFrame, keys: list[str], chunk: int, name: str, side: str) -> DataFrame:
    """At most ``chunk`` positions of a sample per row, with the vectors of ``side``."""
    vector = F.when(F.col("_side") == side, F.struct("pos", F.col("embedding").alias("e")))
    return vectors.groupBy(*keys, F.floor(F.col("pos") / chunk).alias(f"{name}_block")).agg(F.collect_list(vector).alias(name))


def _unit_rows(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _blocks(a: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """Per row the positions and the matrix of its vectors; None where there are none."""
    flat = a.flatten()
    pos, e = pc.struct_field(flat, "pos"), pc.struct_field(flat, "e")
    if pos.null_count or e.null_count:
        raise ValueError("a token vector has no position or no numbers")
    pos, values = pos.to_numpy(zero_copy_only=False), e.flatten().to_numpy(zero_copy_only=False)
    dims = pc.list_value_length(e).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], dims.cumsum()])
    at = 0
    for n in pc.fill_null(pc.list_value_length(a), 0).to_pylist():
        if n and (dims[at:at + n] != dims[at]).any():
            raise ValueError("the token vectors of a sample differ in length")
        yield (pos[at:at + n], values[ends[at]:ends[at + n]].reshape(n, -1)) if n else None
        at += n


def _per_position(pos: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Each position's best, in order of position."""
    if (np.diff(pos) > 0).all():
        return best
    order = np.argsort(pos, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(pos[order]) > 0]))
    return np.maximum.reduceat(best[order], starts)


def _lists(found: list[np.ndarray | None]) -> pa.Array:
    # a null offset makes the row null
    at = np.concatenate([[0], np.cumsum([0 if f is None else len(f) for f in found])])
    offsets = pa.array(at, pa.int32(), mask=np.array([f is None for f in found] + [False]))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([f for f in found if f is not None] or [np.zeros(0)])))


def _block_best(left: Column, right: Column) -> Column:
    """Of two blocks of one sample: every position's largest cosine in the other block, by one matrix product."""
    @F.arrow_udf("struct<p:array<double>,r:array<double>>")
    def block_best(lefts: pa.Array, rights: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(_blocks(lefts), _blocks(rights), strict=True):
            if a is None or b is None:
                out.append((None, None))
                continue
            cos = _unit_rows(a[1]) @ _unit_rows(b[1]).T
            out.append((_per_position(a[0], cos.max(axis=1)), _per_position(b[0], cos.max(axis=0))))
        return pa.StructArray.from_arrays([_lists([x[k] for x in out]) for k in (0, 1)], names=["p", "r"])

    return block_best(left, right)


def embedding_match(vectors: DataFrame, chunk: int = 256, keys: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Greedy max-cosine matching (BERTScore without IDF or rescaling).

    ``vectors``: ``(keys..., side in {pred, ref}, pos, embedding)``; name the model in
    ``keys`` to match per model. Returns per sample ``precision`` (mean over prediction
    vectors of the best match), ``recall`` (the reverse) and ``f1``. Vectors are packed into
    blocks of at most ``chunk`` positions of a sample, so no group is larger than that and
    the join emits one row per pair of blocks, not of vectors. The vectors are computed and
    shuffled once, by sample; packing, join and sums run inside those partitions.
    """
    keys = list(keys)
    v = vectors.select(*keys, "side", "pos", F.col("embedding").cast("array<double>").alias("embedding"))
    # no filter on the side passes the fence, so both sides share one exchange
    v = fence(v.repartition(work_partitions(vectors), *keys), _side=F.col("side")).drop("side")
    is_pred = F.col("_side").eqNullSafe("pred")
    pred, ref = _packed(v.where(is_pred), keys, chunk, "_p", "pred"), _packed(v.where(~is_pred), keys, chunk, "_r", "ref")
    # the outer join keeps samples with one side only
    best = pred.join(ref, keys, "full_outer").select(*keys, "_p_block", "_r_block", _block_best(F.col("_p"), F.col("_r")).alias("m"))
    sides = best.select(*keys, F.inline(F.array(
        F.struct(F.lit("pred").alias("side"), F.col("_p_block").alias("block"), F.col("m.p").alias("best")),
        F.struct(F.lit("ref").alias("side"), F.col("_r_block").alias("block"), F.col("m.r").alias("best")))))
    blocks = sides.groupBy(*keys, "side", "block").agg(F.collect_list("best").alias("b"))  # one number a position and block met
    top = F.reduce(F.slice("b", F.lit(2), F.size("b")), F.get("b", F.lit(0)), lambda x, y: F.zip_with(x, y, lambda i, j: F.greatest(i, j)))
    sums = blocks.select(*keys, "side", top.alias("b")).select(
        *keys, "side", F.reduce("b", F.lit(0.0), lambda x, y: x + y).alias("s"), F.when(F.col("b").isNotNull(), F.size("b")).alias("n"))
    mean = lambda side: F.try_divide(F.sum(F.when(F.col("side") == side, F.col("s"))),
                                     F.sum(F.when(F.col("side") == side, F.col("n"))))
    # a sample with one side only has no match: all zero
    out = sums.groupBy(*keys).agg(mean("pred").alias("precision"), mean("ref").alias("recall")).fillna(0.0, ["precision", "recall"])
    return out.select(*keys, "precision", "recall", _f1(F.col("precision"), F.col("recall")).alias("f1"))


def embedding_match_corpus(per_sample: DataFrame) -> DataFrame:
    """Corpus means of ``embedding_match`` keyed by model → ``(model, metric, value)``."""
    means = per_sample.groupBy("model").agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")])
    return means.select("model", F.explode(F.array(*[
        F.struct(F.lit(f"bertscore_{c}").alias("metric"), F.col(c).alias("value")) for c in ("precision", "recall", "f1")
    ])).alias("m")).select("model", "m.metric", "m.value")


# --------------------------------------------------------------- J7 merge
ROUGE_KEYS = ("rouge1", "rouge2", "rougeL")


def metrics_long(pairs: DataFrame, rouge: bool = True, bleu_: bool = True, chrf_: bool = True,
                 rouge_keys: Sequence[str] = ROUGE_KEYS, stem: bool = True,
                 vectors: DataFrame | None = None) -> DataFrame:
    """Only the requested metrics, unioned to ``(model, metric, value)``.

    ROUGE is stemmed by default and limited to ``rouge_keys`` (``rougeN`` for any N, ``rougeL``, ``rougeLsum``).
    Token vectors ``(model, sample_id, side, pos, embedding)`` add BERTScore.
    The pairs are written once and shared by all metrics.
    """
    pairs = materialize(pairs.select(*SAMPLE, "prediction", "reference"))
    parts = []
    if rouge:
        unknown = [k for k in rouge_keys if k not in ("rougeL", "rougeLsum") and not re.fullmatch(r"rouge[1-9]\d*", k)]
        if unknown:
            raise ValueError(f"unknown ROUGE key {unknown[0]!r}")
        orders = tuple(int(k.removeprefix("rouge")) for k in rouge_keys if not k.startswith("rougeL"))
        if orders:
            parts.append(rouge_n(pairs, orders, stem))
        if "rougeL" in rouge_keys:
            parts.append(rouge_l(pairs, stem))
        if "rougeLsum" in rouge_keys:
            parts.append(rouge_lsum(pairs, stem))
    if bleu_:
        parts.append(bleu(pairs))
    if chrf_:
        parts.append(chrf(pairs))
    if vectors is not None:
        parts.append(embedding_match_corpus(embedding_match(vectors, keys=SAMPLE)))
    if not parts:
        raise ValueError("no metric is requested")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
