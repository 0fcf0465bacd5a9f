"""SimHash near-duplicates: tiled exact comparison of fingerprints in numpy.

Fingerprints are 64-bit SimHashes of word shingles (XXH64, seed 42). Equal
fingerprints collapse to one row first, so a group of exact copies, however
large, costs one row. Two distinct fingerprints within ``radius`` bits agree
on at least ``BLOCKS - radius`` of their ``BLOCKS`` bit blocks; each fingerprint
therefore goes once to every choice of that many blocks, and within such a
group all fingerprints share those bits. With eight blocks and radius 2, a group has 48
bits fixed and cannot exceed 65,536 distinct fingerprints, whatever the data:
no group needs a cap. Groups are sorted by population count, cut into tiles, and
compared tile by tile with exclusive-or and bit counts; tile pairs whose
population counts differ by more than the radius are skipped.

Each group emits the edges of a spanning forest of its links, not all its
pairs; components of these are the components of all links.

Defined results: null and empty texts, and texts without a word, have
fingerprint zero and are linked like any other. Null ids are never the id of
a component unless it has no other. Texts are fingerprinted whole, whatever their length;
repeated rows are equal fingerprints of one component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatscope.llm.common import for_rows, free_name, materialize, shuffle_width
from chatscope.llm.components import components

SEED = 42
BLOCKS = 8
TILE = 1024
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the A-Z-lower-cased words' shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters, ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), _CHUNK):
        bits = np.unpackbits(h[at:at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprint_column(shingle: int = 3) -> Column:
    """A column function text -> fingerprint as a (signed) long with the same bits."""
    @F.pandas_udf("long")
    def simhash64(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], dtype=np.uint64).view(np.int64))

    return simhash64


def block_masks(radius: int, blocks: int = BLOCKS) -> list[int]:
    """Bit masks of every choice of ``blocks - radius`` blocks."""
    if not 0 <= radius < blocks:
        raise ValueError(f"radius must lie in 0..{blocks - 1}")
    edges = [64 * k // blocks for k in range(blocks + 1)]
    one = [((1 << edges[k + 1]) - 1) & ~((1 << edges[k]) - 1) for k in range(blocks)]
    return [sum(one[k] for k in c) for c in combinations(range(blocks), blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link_forest(fps: np.ndarray, radius: int, tile: int = TILE) -> list[tuple[int, int]]:
    """Spanning-forest edges (positions) of the graph that links fingerprints within ``radius`` bits."""
    order = np.argsort(np.bitwise_count(fps), kind="stable")
    f = fps[order]
    pop = np.bitwise_count(f).astype(np.int64)
    root = np.arange(len(f))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in range(0, len(f), tile):
        a = f[i:i + tile]
        for j in range(i, len(f), tile):
            if pop[j] - pop[min(i + tile, len(f)) - 1] > radius:
                break  # sorted: all later tiles lie farther
            near = np.bitwise_count(a[:, None] ^ f[None, j:j + tile]) <= radius
            x, y = np.nonzero(np.triu(near, 1) if i == j else near)
            for p, q in zip((x + i).tolist(), (y + j).tolist(), strict=True):
                rp, rq = find(p), find(q)
                if rp != rq:
                    root[max(rp, rq)] = min(rp, rq)
                    out.append((int(order[p]), int(order[q])))
    return out


def _near_pairs(key: np.ndarray, choice: np.ndarray, fp: np.ndarray, radius: int, small: int = 32):
    """Edges among rows sorted by (choice, key), where runs of equal (choice, key) are whole groups."""
    new = np.ones(len(fp), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (choice[1:] != choice[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(fp)))
    member = np.repeat(sizes, sizes)
    group = np.repeat(np.arange(len(starts)), sizes)
    rows = np.flatnonzero((member > 1) & (member <= small))
    for d in range(1, small):  # small groups of the whole batch at once
        rows = rows[rows + d < len(fp)]
        rows = rows[group[rows] == group[rows + d]]
        if not len(rows):
            break
        near = rows[np.bitwise_count(fp[rows] ^ fp[rows + d]) <= radius]
        if len(near):
            yield fp[near], fp[near + d]
    for s, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist(), strict=True):
        own = fp[s:s + n]
        if edges := link_forest(own, radius):
            at = np.array(edges)
            yield own[at[:, 0]], own[at[:, 1]]


def links(fps: DataFrame, radius: int = 2, blocks: int = BLOCKS) -> DataFrame:
    """Edges ``(a, b)`` connecting distinct fingerprints ``fp`` that lie within ``radius`` bits.

    Small groups give their linked pairs (at most 31 per member), large ones a spanning forest.
    """
    spark = fps.sparkSession
    masks = [F.struct(F.lit(k).cast("short").alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
             for k, m in enumerate(block_masks(radius, blocks))]
    rows = (fps.select("fp", F.explode(F.array(*masks)).alias("g")).select("g.choice", "g.key", "fp")
            .repartition(shuffle_width(spark), "choice", "key")
            .sortWithinPartitions("choice", "key", F.bit_count("fp"), "fp"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int16), np.empty(0, np.int64), np.empty(0, np.uint64)]

        def emit(c, k, f):
            for a, b in _near_pairs(k, c, f, radius):
                yield pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            got = [np.asarray(batch.column(i)) for i in range(3)]
            got[2] = got[2].view(np.uint64)
            held = [np.concatenate(x) for x in zip(held, got, strict=True)]
            c, k, f = held
            if not len(f):
                continue
            last = np.flatnonzero((c != c[-1]) | (k != k[-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last group may go on in the next batch
            if cut:
                yield from emit(c[:cut], k[:cut], f[:cut])
                held = [x[cut:] for x in held]
        if len(held[2]):
            yield from emit(*held)

    return rows.mapInArrow(compare, "a bigint, b bigint")


def _classes(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Written tables ``(doc_id, fp)`` of all rows and ``(fp, root, component_id)`` of all distinct fingerprints."""
    rows = materialize(docs.select(F.col(doc_id).alias("doc_id"),
                                   fingerprint_column(shingle)(F.col(text).cast("string")).alias("fp")))
    n = rows.count()
    distinct = materialize(for_rows(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), n))
    n = distinct.count()
    roots = components(links(distinct.select("fp"), radius), n)
    # every fingerprint with its root: those without a link are their own
    classes = materialize(for_rows(distinct.join(roots.withColumnRenamed("v", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")), n))
    ids = materialize(for_rows(classes.groupBy("root").agg(F.min("first_id").alias("component_id")), n))
    return rows, materialize(for_rows(classes.select("fp", "root").join(ids, "root").select("fp", "root", "component_id"), n))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    radius: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` is the
    smallest id reachable over links of at most ``radius`` differing bits.
    """
    rows, classes = _classes(docs, doc_id, text, shingle, radius)
    return rows.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                           "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
             radius: int = 2) -> DataFrame:
    """One row of ``docs`` (all columns) per component: that with the component's id.

    Where several rows of a component have its id, the one with the smallest text stays, then the
    smallest hash of the other columns; rows of other components do not count, whatever their id.
    A component whose rows all lack an id keeps one of them by the same order.
    """
    rows, classes = _classes(docs, doc_id, text, shingle, radius)
    key, rank, tag, fp, kept_fp, root = (
        free_name(docs, x) for x in ("_keep", "_rank", "_tag", "_fp", "_kept_fp", "_root"))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text)]
    tagged = docs.withColumn(tag, F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0))
    prints = fingerprint_column(shingle)(F.col(text).cast("string"))

    def first_of(df: DataFrame) -> DataFrame:
        order = Window.partitionBy(root).orderBy(F.col(text), F.col(tag))
        return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*docs.columns)

    keepers = classes.where("component_id IS NOT NULL").select(
        F.col("component_id").alias(key), F.col("fp").alias(kept_fp), F.col("root").alias(root))
    # an id that one row has decides by itself, on narrow rows; only texts of repeated ids are looked at again
    repeated = materialize(rows.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    ids = keepers.select(key).distinct()
    kept = docs.join(ids.join(repeated, F.col(key) == repeated["doc_id"], "left_anti"), docs[doc_id] == F.col(key), "left_semi")
    if not repeated.isEmpty():
        again = keepers.join(repeated, F.col(key) == repeated["doc_id"], "left_semi")
        # ids first, so that only rows that may stay are fingerprinted again
        maybe = tagged.join(again.select(key).distinct(), tagged[doc_id] == F.col(key), "left_semi").withColumn(fp, prints)
        kept = kept.unionByName(first_of(maybe.join(again, (maybe[doc_id] == F.col(key)) & (maybe[fp] == F.col(kept_fp)))))
    if not rows.where("doc_id IS NULL").isEmpty():
        no_id = classes.where("component_id IS NULL").select(F.col("fp").alias(fp), F.col("root").alias(root))
        kept = kept.unionByName(first_of(tagged.where(F.col(doc_id).isNull()).withColumn(fp, prints).join(no_id, fp)))
    return kept
