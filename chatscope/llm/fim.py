"""Fill-in-the-middle: texts cut at two ranks of units, found in an indexable skip list.

A unit is a run of ASCII letters or one other code point. The units of a text form a
skip list: the lowest lane links every unit to the next, and a lane above links only the
nodes of taller towers (heights are drawn from a hash of the unit's number, one node in
``FAN`` rises a lane). Each link carries two widths, the units and the code points that it passes, which are
the sums over the links below it. A rank is found from the head of the topmost lane: go
forward while the link's unit width still fits, else down a lane; the code points passed are where
the text is cut. The lists of a batch of texts are built and descended together.

Form and cut ranks depend only on the id's hash, so the result does not depend on partitioning.

Defined results: a null text counts as empty; empty texts and texts that contain a marker stay plain.
A null id hashes as the empty string. Repeated rows each get a row, equal ids the same
ranks; an empty table gives no rows; further columns are ignored. A text of any length is cut exactly; it needs
some 40 bytes of memory a code point while it is worked on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The markers before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
FAN = 8
GROUP_CHARS = 1 << 21  # code points of texts handled together


@dataclass
class Lane:
    """The links of one lane, text after text; node ``k`` is where link ``k`` starts."""
    units: np.ndarray  # units that a link passes
    chars: np.ndarray  # code points that it passes
    below: np.ndarray  # the same node in the lane below (the lowest lane: the unit's number)


def unit_starts(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where units start in the code points of some joined texts that begin at ``heads``."""
    letter = ((points | 32) - np.uint32(97)) < 26
    start = np.ones(len(points), dtype=bool)
    start[1:] = ~(letter[1:] & letter[:-1])
    start[heads] = True
    return np.flatnonzero(start)


def towers(n: int) -> np.ndarray:
    """How many lanes above the lowest each of ``n`` nodes rises: geometric, from a hash of its number."""
    x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    height, mask = np.zeros(n, dtype=np.int8), np.uint64(FAN - 1)
    left = np.arange(n)
    while len(left := left[(x[left] & mask) == 0]) and height[left[0]] < 18:
        height[left] += 1
        x[left] >>= np.uint64(3)
    return height


class SkipLists:
    """Indexable skip lists over the units of some non-empty texts."""

    def __init__(self, texts: Sequence[str]) -> None:
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        heads = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(texts) else np.empty(0, np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        at = unit_starts(points, heads)
        first = np.searchsorted(at, heads)  # the unit that each text starts with
        self.n = np.diff(np.append(first, len(at)))
        height = towers(len(at))
        height[first] = 127  # every text's head is in every lane
        self.lanes = [Lane(np.ones(len(at), np.int64), np.diff(np.append(at, len(points))), np.arange(len(at)))]
        node = np.arange(len(at))  # the units that are nodes of the topmost lane so far
        while len(node) > len(first):
            rises = np.flatnonzero(height[node] >= len(self.lanes))
            if len(rises) == len(node):
                break
            low = self.lanes[-1]
            self.lanes.append(Lane(np.add.reduceat(low.units, rises), np.add.reduceat(low.chars, rises), rises))
            node = node[rises]
        self.first = np.searchsorted(node, first)  # heads in the topmost lane

    def chars_before(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Code points before the unit of rank ``rank`` (0 to n) of text ``text``, for many queries at once."""
        node, left, passed = self.first[text], rank.astype(np.int64), np.zeros(len(text), np.int64)
        for k, lane in reversed(list(enumerate(self.lanes))):
            going = np.arange(len(text))
            while len(going):
                # a finished query has nothing left, and no link passes fewer than one unit
                going = going[left[going] > 0]
                going = going[lane.units[node[going]] <= left[going]]
                at = node[going]
                left[going] -= lane.units[at]
                passed[going] += lane.chars[at]
                node[going] = at + 1
            if k:  # a node past the end of the lane has nothing left to go
                node = lane.below[np.minimum(node, len(lane.below) - 1)]
        return passed


def _groups(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    at, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= limit:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _transformed(markers: tuple[str, str, str], group_chars: int):
    pre, suf, mid = markers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            draws = [np.asarray(b.column(k)) for k in range(2, 6)]
            for a, z in _groups(texts, group_chars):
                some = texts[a:z]
                h1, h2, h3, h4 = (h[a:z] for h in draws)
                full = np.flatnonzero([len(t) > 0 for t in some])
                lists = SkipLists([some[i] for i in full])
                n = np.zeros(len(some), np.int64)
                n[full] = lists.n
                cut = np.flatnonzero([h < 90 and bool(t) and not any(m in t for m in markers)
                                      for h, t in zip((h3 % 100).tolist(), some, strict=True)])
                one, two = h1[cut] % (n[cut] + 1), h2[cut] % (n[cut] + 1)
                own = np.searchsorted(full, cut)
                ends = lists.chars_before(np.concatenate([own, own]),
                                          np.concatenate([np.minimum(one, two), np.maximum(one, two)]))
                spm = h4[cut] % 100 < 20
                form, out = ["plain"] * len(some), list(some)
                head, body = [None] * len(some), [None] * len(some)
                for i, lo, hi, swap in zip(cut.tolist(), ends[:len(cut)].tolist(), ends[len(cut):].tolist(),
                                           spm.tolist(), strict=True):
                    t = some[i]
                    p, m, s = t[:lo], t[lo:hi], t[hi:]
                    form[i], head[i], body[i] = "spm" if swap else "psm", lo, hi - lo
                    out[i] = f"{suf}{s}{pre}{p}{mid}{m}" if swap else f"{pre}{p}{suf}{s}{mid}{m}"
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), pa.array(n), pa.array(form), pa.array(head, pa.int64()),
                     pa.array(body, pa.int64()), pa.array(out, pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = "1:",
              markers: tuple[str, str, str] = MARKERS, group_chars: int = GROUP_CHARS) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, one row per input row.

    Nine texts in ten are cut: prefix, middle and suffix end after the smaller and the larger of two
    ranks among 0 to ``n`` units. A fifth of them are ``spm`` (suffix first), the others ``psm``. Every
    marker must begin with a character that occurs nowhere else in the markers, so that
    ``restored`` can undo the cut whatever the text.
    """
    if len(set(markers)) < 3 or any(m[0] in n[1:] for m in markers for n in markers):
        raise ValueError("markers must differ, and none may hold the first character of one behind its own first")
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        *[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k}") for k in range(4)])
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_transformed(markers, group_chars), f"doc_id {id_type}, n bigint, form string, "
                           "prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``transform`` made ``output`` of."""
    part = F.split(output, "|".join(rf"\Q{m}\E" for m in markers), -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The digests of ``transform``'s output and of the text rebuilt from it."""
    out = transform(docs, doc_id, text)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                      sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
