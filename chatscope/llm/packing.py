"""Best-fit packing of token sequences with dominance reduction.

Token lengths are whole numbers up to the capacity, so a packing instance of
any size is a histogram of at most ``capacity`` counts, and that is all the
driver ever sees. On the histogram:

1. *Dominance reduction* (after Martello and Toth): for each length, longest
   first, look for a set that dominates every other way to fill a sequence
   holding it: alone if nothing fits beside it; with its exact complement; or
   with the longest fitting partner, if no two remaining items fit together in
   the rest. Dominating sets are fixed for as many sequences as they recur and
   the instance shrinks, until no set can be proved to dominate.
2. *Best fit* of the remainder, longest first, whole classes of equal open
   sequences at a time.

The resulting patterns say, for each length, which ranks go to which sequence
and offset. Ranks within a length come from per-partition counts and prefix
sums, so no length is ever gathered in one task.

Defined results: null and empty texts are documents of the terminator alone;
repeated rows are packed separately; no documents give no pieces. Texts of any length
are encoded whole, with runs of millions of white-space characters too, and cut into pieces of the capacity.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatscope.llm.common import materialize

CAPACITY = 2048
TERMINATOR = 0


@dataclass
class Pattern:
    """``count`` sequences that each hold ``items`` (length, multiplicity), in this order."""
    items: list[tuple[int, int]]
    count: int

    @property
    def used(self) -> int:
        return sum(s * m for s, m in self.items)


def _dominating(left: np.ndarray, j: int, capacity: int) -> int | None:
    """The one partner whose set with an item of length ``j`` dominates all others; 0: none fits; None: no proof."""
    others = left.copy()
    others[j] -= 1
    room = capacity - j
    fits = np.flatnonzero(others[: room + 1])
    if not len(fits):
        return 0
    partner = int(fits[-1])
    if partner == room:
        return partner  # exact: whatever else could go here weighs no more than the partner
    least = int(fits[0])
    second = least if others[least] > 1 else int(fits[1]) if len(fits) > 1 else capacity
    return partner if least + second > room else None  # only one item fits, so the longest that fits is best


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> tuple[list[Pattern], np.ndarray]:
    """Fix provably dominating sets; returns their patterns and the counts that remain.

    ``counts[s]`` is the number of items of length ``s``. Removing items only
    ever makes more sets dominate, so passes go on until one fixes nothing.
    """
    left = counts.astype(np.int64).copy()
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(left)[::-1].tolist():
            while left[j]:
                partner = _dominating(left, j, capacity)
                if partner is None:
                    break
                if partner == 0:
                    n, items = int(left[j]), [(j, 1)]
                elif partner == j:
                    n, items = int(left[j]) // 2, [(j, 2)]
                else:
                    n, items = int(min(left[j], left[partner])), [(max(j, partner), 1), (min(j, partner), 1)]
                for s, m in items:
                    left[s] -= m * n
                fixed.append(Pattern(items, n))
                changed = True
    return fixed, left


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram; equal open sequences move as one class."""
    open_by_room: dict[int, list[Pattern]] = {}
    rooms = np.zeros(capacity + 1, dtype=bool)

    def put(room: int, p: Pattern) -> None:
        if p.count:
            open_by_room.setdefault(room, []).append(p)
            rooms[room] = True

    for s in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[s])
        while n:
            at = np.flatnonzero(rooms[s:])
            if not len(at):
                break
            room = int(at[0]) + s
            cls = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms[room] = False
            each = room // s  # best fit keeps filling the tightest sequence
            whole = min(cls.count, n // each)
            put(room - each * s, Pattern(cls.items + [(s, each)], whole))
            n -= whole * each
            rest = cls.count - whole
            if rest and n:  # n < each: one sequence takes what is left
                put(room - n * s, Pattern(cls.items + [(s, n)], 1))
                n, rest = 0, rest - 1
            put(room, Pattern(cls.items, rest))
        if n:
            each = capacity // s
            put(capacity - each * s, Pattern([(s, each)], n // each))
            if n % each:
                put(capacity - (n % each) * s, Pattern([(s, n % each)], 1))
    return [p for v in open_by_room.values() for p in v]


def pack_histogram(counts: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every item of the histogram ``counts[0..capacity]``."""
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


_RANKS = 1 << 48  # ranks within a length lie below this


@dataclass
class Slots:
    """Runs of ranks of one length that go to consecutive sequences, ordered by (length, first rank)."""
    key: np.ndarray  # length * _RANKS + the run's first rank
    per: np.ndarray  # items of this length in each sequence of the run
    seq: np.ndarray  # the run's first sequence number
    offset: np.ndarray  # where the first item of this length lies

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence number and offset of the items with these lengths and ranks within their lengths."""
        at = length * _RANKS + rank
        run = np.searchsorted(self.key, at, side="right") - 1
        k = at - self.key[run]
        return self.seq[run] + k // self.per[run], self.offset[run] + (k % self.per[run]) * length


def slots(patterns: list[Pattern], capacity: int) -> Slots:
    runs = []
    filled = [0] * (capacity + 1)
    seq = 0
    for p in patterns:
        offset = 0
        for s, m in p.items:
            runs.append((s * _RANKS + filled[s], m, seq, offset))
            filled[s] += m * p.count
            offset += s * m
        seq += p.count
    return Slots(*np.array(sorted(runs), dtype=np.int64).reshape(-1, 4).T)


def pieces(docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]], doc_id: str = "doc_id",
           text: str = "text", capacity: int = CAPACITY, terminator: int = TERMINATOR, keep_ids: bool = False) -> DataFrame:
    """Tokenise and cut: ``(doc_id, piece, start, length, ids_crc32, part, local)``, and with ``keep_ids`` the ``ids``.

    ``encoder()`` is called once per task and returns ``text -> uint32 ids``.
    A document is its ids and the terminator; one longer than the capacity is cut
    into pieces of the capacity, of which the first may be shorter. ``local``
    numbers the pieces of one length within ``part``.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            took, out, kept = [], [], []
            for row, t in enumerate(b.column(1)):
                ids = np.append(encode(t.as_py() or ""), np.uint32(terminator)).astype("<u4")
                head = len(ids) % capacity or capacity
                ends = range(min(head, len(ids)), len(ids) + 1, capacity)
                begin = 0
                for k, end in enumerate(ends):
                    n = end - begin
                    own = ids[begin:end].tobytes()
                    out.append((k, begin, n, zlib.crc32(own), part, seen[n]))
                    if keep_ids:
                        kept.append(own)
                    seen[n] += 1
                    begin = end
                took.extend([row] * len(ends))
            cols = np.array(out, dtype=np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(took, pa.int64())),
                 pa.array(cols[:, 0], pa.int32())] + [pa.array(cols[:, k]) for k in range(1, 4)]
                + [pa.array(cols[:, 4], pa.int32()), pa.array(cols[:, 5])] + [pa.array(kept, pa.binary())] * keep_ids,
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"] + ["ids"] * keep_ids)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                "part int, local bigint" + ", ids binary" * keep_ids)


def pack(docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]], doc_id: str = "doc_id",
         text: str = "text", capacity: int = CAPACITY, terminator: int = TERMINATOR, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    With ``keep_ids`` a last column ``ids`` holds the piece's ids (little-endian
    unsigned 32-bit numbers), to be laid into the sequences (``sequences``).

    The narrow pieces are written once. Their histogram (at most ``capacity``
    rows) is packed on the driver; the ranks' offsets stay in Spark.
    """
    rows = materialize(pieces(docs, encoder, doc_id, text, capacity, terminator, keep_ids))
    by_part = materialize(rows.groupBy("part", "length").agg(F.count("*").alias("n")))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r.length] = r.n
    shared = docs.sparkSession.sparkContext.broadcast(slots(pack_histogram(counts, capacity), capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(by_part.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"))
    ranked = rows.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("rank"), *["ids"] * keep_ids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            seq, off = table.place(np.asarray(b.column("length")), np.asarray(b.column("rank")))
            names = b.schema.names
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(5)] + [pa.array(seq), pa.array(off)] + [b.column(k) for k in range(6, len(names))],
                names=names[:5] + ["sequence_id", "offset"] + names[6:])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                    "sequence_id bigint, offset bigint" + ", ids binary" * keep_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_pieces, length, ids)`` of a packing with ids; a sequence is bounded by the capacity."""
    joined = packed.groupBy("sequence_id").agg(
        F.count("*").alias("n_pieces"), F.sum("length").alias("length"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return joined.select("sequence_id", "n_pieces", "length", F.aggregate(
        "p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))
