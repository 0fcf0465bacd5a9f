"""Connected components of an edge table by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each
round is two joins of the edges with their per-vertex minima; both sides are
read from written tables, so the skew of a large component's root is split at
run time and lost executors cost only their own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatscope.llm.common import for_rows, materialize


def _star(pairs: DataFrame, n: int, keep_above: bool) -> DataFrame:
    """``pairs(u, v)``, grouped by u: every v above (or below) u is linked to the smallest of u's neighbourhood."""
    low = materialize(for_rows(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), n))
    linked = pairs.where(F.col("v") > F.col("u")) if keep_above else pairs
    out = linked.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out if keep_above else out.union(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, n_vertices: int, max_rounds: int = 60) -> DataFrame:
    """``(v, root)`` for every vertex of ``edges(a, b)`` (any order, repeats and loops allowed).

    ``root`` is the smallest vertex of its component. Null ends are ignored.
    The table may be empty. ``n_vertices`` bounds the first round's width; each later one
    is as wide as its counted edges. Fails rather than returning unfinished components.
    """
    n = n_vertices
    e = materialize(for_rows(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), n))
    state = None
    for _ in range(max_rounds):
        new = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if state == new:
            break
        state, n = new, new.n
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(for_rows(_star(both, 2 * n, True).where("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), n))
        e = materialize(for_rows(_star(large, n, False).where("u <> v").distinct(), n))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("v"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("v"), F.col("v").alias("root")).distinct())
