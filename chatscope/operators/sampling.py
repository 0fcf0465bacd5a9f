"""Ordering, sampling and length budget (K1–K6).

Randomness is replaced by md5 of ``id || seed`` so results are reproducible
and engine-independent. Ranks are exact and consecutive without a
single-partition window (``consecutive_index``); top-n and arg-max use
Spark's partial top-k / partial aggregation, so only n rows (or one) per
partition ever move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatscope.functions.text import WS, col_of


def shuffle_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def consecutive_index(df: DataFrame, order: list[str] | str, name: str = "idx") -> DataFrame:
    """Exact 0..n-1 numbering by ``order`` (the caller's keys must be unique).

    Range-partition on the keys (Spark samples the bounds, so partitions are
    balanced), tag each row with its partition id and write that once to the
    shared checkpoint folder: the count pass and the numbering pass then read
    the same rows, whereas two executions of a range exchange could sample
    different bounds. Counts are one row per partition; prefix sums over that
    tiny table give offsets; positions are ``row_number`` within a partition
    ordered by the unique keys. No step sees more than one partition of data.
    """
    from chatscope.session import materialize
    order = [order] if isinstance(order, str) else list(order)
    s = materialize(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    s = s.withColumn("_pos", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_pid", F.coalesce(F.sum("_c").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # the offset table has one row per partition, so broadcasting it is bounded
    s = s.join(F.broadcast(offs), "_pid")
    return s.withColumn(name, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off")


def shuffle_seeded(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """K1: deterministic shuffle; adds ``rank`` (0-based position in shuffled order).

    Only the (unique) ids are sorted and numbered; the rows meet their ranks in a join on the id.
    """
    ranks = consecutive_index(df.select(id_col, shuffle_key(id_col, seed).alias("_k")), ["_k", id_col], "rank").drop("_k")
    return df.join(ranks, id_col)


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """K2: n pseudo-random rows (seeded top-n by md5; partial top-k per partition)."""
    return df.withColumn("_k", shuffle_key(id_col, seed)).orderBy("_k", id_col).limit(n).drop("_k")


def sample_fraction(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """K2 for very large tables: a Bernoulli sample by the hash of the id (no sort, the same rows on every run)."""
    draw = F.conv(F.substring(shuffle_key(id_col, seed), 1, 8), 16, 10).cast("bigint")
    return df.where(draw < F.lit(int(fraction * (1 << 32))))


def longest_example(df: DataFrame, id_col: str, text_cols: list[str]) -> DataFrame:
    """K3: the row with the most characters in ``concat(text_cols)``; lowest id wins ties."""
    n = sum((F.coalesce(F.length(c), F.lit(0)) for c in text_cols), F.lit(0))
    best = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(n, -F.col(id_col)))
    return df.agg(best.alias("r"), F.max(n).alias("n_chars")).select("r.*", "n_chars")


def whitespace_tokens(text: Column | str) -> Column:
    """Default token counter: runs of non-whitespace (pluggable in ``max_sequence_length``)."""
    return F.size(F.filter(F.split(F.coalesce(col_of(text), F.lit("")), WS + "+"), lambda t: t != ""))


def max_sequence_length(df: DataFrame, id_col: str, text_cols: list[str], count_tokens=whitespace_tokens,
                        margin: int = 100) -> DataFrame:
    """K4: tokens of the longest example plus a margin (default 100)."""
    row = longest_example(df, id_col, text_cols)
    n_tokens = count_tokens(F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in text_cols]))
    return row.select(id_col, "n_chars", n_tokens.alias("n_tokens"), (n_tokens + margin).alias("max_length"))


def cap_eval(df: DataFrame, id_col: str, max_samples: int | None) -> DataFrame:
    """K5: the first ``max_samples`` rows by id (``None`` keeps all)."""
    if max_samples is None:
        return df
    return df.orderBy(id_col).limit(max_samples)


def first_row(df: DataFrame, id_col: str) -> DataFrame:
    """K6: ``dataset[0]`` as the row with the smallest id."""
    return df.orderBy(id_col).limit(1)
