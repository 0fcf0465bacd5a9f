"""Texts to token vectors for the embedding match.

The caller's encoder is a factory ``make_encoder() -> (tokenize, encode)``: ``tokenize(text) -> list[str]`` and
``encode(list of token lists) -> list of arrays (tokens x dimensions)``, one row per token. It runs once per Python worker. A text longer
than ``window`` tokens is encoded in windows that overlap by ``overlap``; a token takes its vector from the window in which
it lies farthest from the window's ends, so it has at least ``overlap // 2`` neighbours on a side where the text goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatscope.operators.inference import _model_for

Encoder = tuple[Callable[[str], list[str]], Callable[[list[list[str]]], list[np.ndarray]]]
WINDOW, OVERLAP = 512, 128
_OUT_ROWS = 20_000


def windows(n: int, window: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """``(start, end, first, last)`` of the windows over ``n`` tokens; each gives the vectors of ``[first, last)``."""
    if n <= window:
        return [(0, n, 0, n)] if n else []
    step = window - overlap
    starts = [*range(0, n - window, step), n - window]
    # two neighbours meet in the middle of what they share
    cuts = [0] + [(a + window + b) // 2 for a, b in zip(starts, starts[1:])] + [n]
    return [(a, a + window, cuts[k], cuts[k + 1]) for k, a in enumerate(starts)]


def encode_tokens(pairs: DataFrame, make_encoder: Callable[[], Encoder], keys: tuple[str, ...] = ("model", "sample_id"),
                  window: int = WINDOW, overlap: int = OVERLAP, batch: int = 32) -> DataFrame:
    """``(keys..., side, pos, embedding)``: a row per token of every prediction (``pred``) and reference (``ref``).

    Null and empty texts, and texts without a token, have no rows. ``batch`` windows go to the encoder at once.
    """
    if not 0 <= overlap < window:
        raise ValueError("overlap must be smaller than the window")
    sides = pairs.select(*keys, F.explode(F.array(
        F.struct(F.lit("pred").alias("side"), F.col("prediction").alias("text")),
        F.struct(F.lit("ref").alias("side"), F.col("reference").alias("text")))).alias("s")).select(*keys, "s.side", "s.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize, encode = _model_for(make_encoder)
        for b in batches:
            if not b.num_rows:
                continue
            names = [*keys, "side"]
            held: list[tuple[int, list[str], int, int, int]] = []  # row, tokens, start, first, last
            rows: list[np.ndarray] = []
            pos: list[np.ndarray] = []
            vectors: list[np.ndarray] = []  # a matrix for each window
            n = 0

            def flush() -> None:
                nonlocal n
                for (row, _, start, first, last), got in zip(held, encode([h[1] for h in held]), strict=True):
                    rows.append(np.full(last - first, row))
                    pos.append(np.arange(first, last))
                    vectors.append(np.asarray(got, dtype=np.float64)[first - start:last - start])
                    n += last - first
                held.clear()

            def out() -> pa.RecordBatch:
                nonlocal n
                widths = np.concatenate([np.full(len(m), m.shape[1]) for m in vectors])
                flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], widths.cumsum()]), pa.int32()),
                                                pa.array(np.concatenate([m.ravel() for m in vectors])))
                at = pa.array(np.concatenate(rows), pa.int64())
                made = pa.RecordBatch.from_arrays([b.column(k).take(at) for k in range(len(names))]
                                                  + [pa.array(np.concatenate(pos), pa.int64()), flat], names=[*names, "pos", "embedding"])
                rows.clear()
                pos.clear()
                vectors.clear()
                n = 0
                return made

            for row, text in enumerate(b.column(len(names)).to_pylist()):
                tokens = tokenize(text) if text else []
                for start, end, first, last in windows(len(tokens), window, overlap):
                    held.append((row, tokens[start:end], start, first, last))
                    if len(held) >= batch:
                        flush()
                    if n >= _OUT_ROWS:
                        yield out()
            flush()
            if n:
                yield out()

    types = ", ".join(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys)
    return sides.mapInArrow(run, f"{types}, side string, pos bigint, embedding array<double>")


def make_hash_encoder(dims: int = 8) -> Encoder:
    """A deterministic stand-in: bytes of the token's md5 and, half as much, of the token before it in the window."""
    import hashlib

    def of(tokens: list[str]) -> np.ndarray:
        raw = b"".join(hashlib.md5(x.encode()).digest()[:dims] for x in tokens)
        return np.frombuffer(raw, dtype=np.uint8).reshape(len(tokens), -1) / 127.5 - 1

    def encode(lists: list[list[str]]) -> list[np.ndarray]:
        own = [of(tokens) for tokens in lists]
        return [v + 0.5 * np.concatenate([np.zeros((1, dims)), v[:-1]]) for v in own]

    return str.split, encode
