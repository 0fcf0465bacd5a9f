"""Longest-common-subsequence length, bit-parallel (Allison & Dix 1986; Hyyrö 2004).

For sequences ``a`` (length m) and ``b``: one bit mask per distinct token of
``a``; for every token of ``b`` the row vector is updated with one add, one
subtract and three bit operations on m-bit integers, so the cost is
``O(len(b) * m / 64)`` word operations instead of the ``O(len(a) * len(b))``
table. Used by ROUGE-L through an Arrow-batched ``pandas_udf``: Spark ships
token arrays in batches, the loop runs in the Python worker next to the data.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a, b) -> int:
    if a is None or b is None or len(a) == 0 or len(b) == 0:
        return 0
    m = len(a)
    masks: dict = {}
    for i, tok in enumerate(a):
        masks[tok] = masks.get(tok, 0) | (1 << i)
    full = (1 << m) - 1
    v = full
    for tok in b:
        u = v & masks.get(tok, 0)
        v = ((v + u) | (v - u)) & full
    return m - bin(v).count("1")


@F.pandas_udf(T.LongType())
def lcs_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(x, y) for x, y in zip(a, b)], dtype="int64")


def lcs_places(ref, cand) -> set[int]:
    """Places in ``ref`` of one longest common subsequence: traced back from the ends, to the left where the cell there is
    larger than the one above, else up.

    The table is kept as one bit row per token of ``ref`` (of as many bits as ``cand`` has tokens); a cell is its column less the
    set bits up to it.
    """
    masks: dict = {}
    for j, tok in enumerate(cand):
        masks[tok] = masks.get(tok, 0) | (1 << j)
    full = (1 << len(cand)) - 1
    rows = [full]
    for tok in ref:
        v = rows[-1]
        u = v & masks.get(tok, 0)
        rows.append(((v + u) | (v - u)) & full)
    out, i, j = set(), len(ref), len(cand)
    while i and j:
        if masks.get(ref[i - 1], 0) >> (j - 1) & 1:
            i, j = i - 1, j - 1
            out.add(i)
        else:
            left = j - 1 - (rows[i] & ((1 << (j - 1)) - 1)).bit_count()
            up = j - (rows[i - 1] & ((1 << j) - 1)).bit_count()
            i, j = (i, j - 1) if left > up else (i - 1, j)
    return out


def _cut(tokens, sizes) -> list[list]:
    tokens, at, out = list(tokens), 0, []
    for n in sizes:
        out.append(tokens[at:at + n])
        at += n
    return out


def union_lcs_hits(ref, ref_sizes, cand, cand_sizes) -> int:
    """Tokens of the reference sentences that lie in the union of their common subsequences with all candidate sentences.

    A token counts at most as often as both texts hold it.
    """
    if ref is None or cand is None or not len(ref) or not len(cand):
        return 0
    left_r, left_c, hits = Counter(ref), Counter(cand), 0
    sentences = _cut(cand, cand_sizes)
    for r in _cut(ref, ref_sizes):
        for i in sorted(set().union(*(lcs_places(r, c) for c in sentences))):
            if left_r[r[i]] > 0 and left_c[r[i]] > 0:
                hits += 1
                left_r[r[i]] -= 1
                left_c[r[i]] -= 1
    return hits


@F.pandas_udf(T.LongType())
def union_lcs_udf(ref: pd.Series, ref_sizes: pd.Series, cand: pd.Series, cand_sizes: pd.Series) -> pd.Series:
    return pd.Series([union_lcs_hits(*row) for row in zip(ref, ref_sizes, cand, cand_sizes)], dtype="int64")
