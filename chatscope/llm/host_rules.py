"""Quality rules with host verdicts.

Row-local text statistics decide a base rule per document. Rule failures are
then counted by host (map-side partial sums, so a host with a third of all
rows costs no more than any other), the failure rates are shrunk towards an
empirical beta prior fitted to all hosts by the method of moments, and the
host verdicts are joined back to the documents.

Defined results: a null text has no words and so fails the base rule; a
document with a null host gets no host verdict, only its own; without any host
the prior is the uniform beta(1, 1).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatscope.llm.common import materialize

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10  # of words, for the host statistic
MAX_DUP_LINE_PERCENT = 30  # of lines with a word, for the host statistic
MAX_HOST_RATE = 0.5

_SPACES = bytes(range(9, 14)) + b" "
_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """Words lying in a ``width``-word window that occurs at least twice in the list."""
    n = len(words)
    if n <= width:
        return 0
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    key = at[: n - width + 1]
    for k in range(1, width):
        # renumber after each step, so that keys never overflow
        key = np.unique(key * len(ids) + at[k: n - width + 1 + k], return_inverse=True)[1].reshape(-1)
    again = (np.bincount(key) > 1)[key]
    step = np.zeros(n + 1, dtype=np.int64)
    step[: n - width + 1] += again
    step[width: n + 1] -= again
    return int((np.cumsum(step[:n]) > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() cuts at exactly \x09-\x0D and \x20
    plain = raw.translate(None, _SPACES)
    symbols = len(plain) - len(plain.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACES)]
    word_chars = len(text) - (len(raw) - len(plain))
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_window_words(words), len(lines)


def stats_column() -> Column:
    @F.pandas_udf(_STATS)
    def text_rule_stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in _STATS.split(", ")]
        for s in batches:
            flat = np.fromiter(chain.from_iterable(map(text_stats, s)), dtype=np.int64, count=len(s) * len(names))
            yield pd.DataFrame(flat.reshape(-1, len(names)), columns=names)

    return text_rule_stats


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEAT_PERCENT)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """``(alpha, beta)`` by moments of the host rates ``n_failed / n_docs``, each host weighing as its rows.

    One aggregate row reaches the driver. The prior's weight lies between 2 and
    10,000 documents, so neither equal rates nor extreme spread break it.
    """
    rate = F.col("n_failed") / F.col("n_docs")
    r = hosts.agg(
        F.sum("n_failed").alias("f"), F.sum("n_docs").alias("n"), F.count("*").alias("k"),
        F.sum(F.col("n_docs") * rate * rate).alias("sq"), F.sum(F.lit(1.0) / F.col("n_docs")).alias("inv"),
    ).first()
    if not r.n:
        return 1.0, 1.0
    m = min(max(r.f / r.n, 1e-6), 1 - 1e-6)
    between = r.sq / r.n - (r.f / r.n) ** 2
    sampling = m * (1 - m) * r.k / r.n  # expected spread of the rates if all hosts were alike
    v = between - sampling
    weight = m * (1 - m) / v - 1 if v > 0 else 10_000.0
    weight = min(max(weight, 2.0), 10_000.0)
    return m * weight, (1 - m) * weight


def host_verdicts(stats: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``(host, n_docs, n_failed, shrunk_rate, host_bad)`` of rows ``(host, rule_failed)``."""
    hosts = materialize(stats.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("rule_failed").cast("long")).alias("n_failed")))
    a, b = beta_prior(hosts)
    rate = (F.col("n_failed") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
    return hosts.withColumn("shrunk_rate", rate).withColumn("host_bad", F.col("shrunk_rate") > F.lit(max_rate))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Statistics, ``base_failed``, the host's shrunk rate and ``kept``, one row per input row.

    ``rule_failed``, which the host statistic counts, holds if the base rule
    fails, symbols exceed a tenth of the words or over 30 % of lines repeat.
    The narrow statistics are written once; the host join then reads them
    directly, so Spark can split a hot host's rows over tasks.
    """
    s = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"),
                    stats_column()(F.col(text).cast("string")).alias("s")).select("doc_id", "host", "s.*")
    s = s.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    s = s.withColumn("rule_failed", F.col("base_failed")
                     | (F.col("n_symbols") * 100 > F.col("n_words") * MAX_SYMBOL_PERCENT)
                     | (F.col("n_dup_lines") * 100 > F.col("n_lines") * MAX_DUP_LINE_PERCENT))
    s = materialize(s)
    hosts = materialize(host_verdicts(s, max_host_rate).select("host", "shrunk_rate", "host_bad"))
    return s.join(hosts, "host", "left").withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce(F.col("host_bad"), F.lit(False)))
