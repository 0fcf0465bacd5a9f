"""Clipped n-gram counts of text pairs, a batch of rows at a time (ROUGE-N, BLEU, chrF).

The grams of a row are numbered, never built: a gram of order ``n`` is the number of its first ``n - 1`` items paired with the
last one, and the row is part of the first number. So a batch needs one dictionary pass per order over its items, and
memory for at most ``BLOCK_ITEMS`` of them (or one row) at once; no row per gram ever reaches a shuffle or a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_ITEMS = 1 << 19
COUNTS = "array<struct<n:int,match:bigint,hyp:bigint,ref:bigint>>"


def _lengths(a: pa.Array) -> np.ndarray:
    size = pc.utf8_length(a) if pa.types.is_string(a.type) else pc.list_value_length(a)
    return pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _items(a: pa.Array) -> pa.Array:
    """All items of the rows: the code points of texts, the elements of lists."""
    if not pa.types.is_string(a.type):
        return a.flatten()
    return pa.array(np.frombuffer("".join(x for x in a.to_pylist() if x).encode("utf-32-le"), dtype=np.uint32))


def _numbered(a: pa.Array) -> tuple[np.ndarray, int]:
    d = a.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(d.dictionary)


def _matches(pred: pa.Array, ref: pa.Array, np_: np.ndarray, nr: np.ndarray, orders: Sequence[int]) -> list[np.ndarray]:
    """Per order: how many n-grams each row's two sides share, each counted as often as both hold it."""
    rows, at_ref = len(np_), int(np_.sum())
    code, n_codes = _numbered(pa.concat_arrays([_items(pred), _items(ref)]))
    size = np.concatenate([np_, nr])
    row = np.repeat(np.concatenate([np.arange(rows)] * 2), size)
    left = np.repeat(size.cumsum(), size) - np.arange(len(code))  # items up to the end of the text, this one included
    number, found = row, {}
    for n in range(1, max(orders) + 1):
        at = np.flatnonzero(left >= n)
        if not len(at):
            break
        ids, many = _numbered(pa.array(number[at] * n_codes + code[at + n - 1]))
        number = np.zeros(len(code), dtype=np.int64)
        number[at] = ids
        if n in orders:
            in_pred = at < at_ref
            shared = np.minimum(np.bincount(ids[in_pred], minlength=many), np.bincount(ids[~in_pred], minlength=many))
            row_of = np.empty(many, dtype=np.int64)
            row_of[ids] = row[at]
            found[n] = np.bincount(row_of, weights=shared, minlength=rows).astype(np.int64)
    return [found.get(n, np.zeros(rows, dtype=np.int64)) for n in orders]


def clipped_counts(pred: pa.Array, ref: pa.Array, orders: Sequence[int]) -> pa.Array:
    """Per row and order: shared n-grams, those of the prediction and those of the reference."""
    np_, nr = _lengths(pred), _lengths(ref)
    ends = (np_ + nr).cumsum()
    match = [[] for _ in orders]
    a = 0
    while a < len(ends):
        b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK_ITEMS, side="right")), a + 1)
        for out, m in zip(match, _matches(pred.slice(a, b - a), ref.slice(a, b - a), np_[a:b], nr[a:b], orders), strict=True):
            out.append(m)
        a = b
    k, rows = len(orders), len(ends)
    table = np.zeros((rows, k, 4), dtype=np.int64)
    for j, n in enumerate(orders):
        table[:, j, 0] = n
        if rows:
            table[:, j, 1] = np.concatenate(match[j])
        table[:, j, 2], table[:, j, 3] = np.maximum(np_ - n + 1, 0), np.maximum(nr - n + 1, 0)
    flat = table.reshape(-1, 4)
    fields = [pa.array(flat[:, 0].astype(np.int32))] + [pa.array(np.ascontiguousarray(flat[:, i])) for i in (1, 2, 3)]
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * k),
                                    pa.StructArray.from_arrays(fields, names=["n", "match", "hyp", "ref"]))


def clipped_counts_of(pred: Column, ref: Column, orders: Sequence[int]) -> Column:
    """``clipped_counts`` of two columns of texts (code point n-grams) or of token lists."""
    @F.arrow_udf(COUNTS)
    def counts(p: pa.Array, r: pa.Array) -> pa.Array:
        return clipped_counts(p, r, orders)

    return counts(pred, ref)
