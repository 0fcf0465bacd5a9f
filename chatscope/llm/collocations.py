"""Phrase collocations from weighted acyclic automata.

1. *Shards.* Every task numbers the words of its texts, counts the phrases of one to three words, sorts them and
   builds count transducers: automata whose arcs are words and whose arc weights are the counts of the phrases
   that end there. The transducers are built from the sorted phrases in chunks of finished first words; states
   with equal arcs are shared. There is one transducer per language and *prefix range*, an interval of the
   sorted phrases; the bounds come from a sample and only balance the load.
2. *Union.* One task per prefix range merges all shards' transducers, adding up weights. Phrases below
   ``min_count`` go (no part of a candidate is rarer than the candidate); the rest is written.
3. *Composition.* The parts of a range's candidates form an acceptor, cut by the same bounds. Each piece is composed with the
   transducer of its range, and the weights go back to the range that asked. A part is asked for once
   per range however many candidates share it, so frequent words make no hot keys.
4. Scores, the test against longer phrases and the ranking are DataFrame expressions; the arithmetic is decimal.

Memory: a task holds ``SHARD_WORDS`` words, or one text if that is longer, and one prefix range.
Exact for counts below 10^16.

Defined results: null texts are empty, a null language is ``und``. Repeated rows count as often as they
occur. An empty table gives no rows. Ids and other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatscope.llm.bpe import pack_numbers, unpack_numbers
from chatscope.llm.common import materialize, shuffle_width

MIN_COUNT, TOP = 10, 2000
SHARD_WORDS, SHARD_VOCABULARY = 4_000_000, 1 << 20
CHUNK = 1 << 17  # sorted phrases added to a transducer at once
BITS = 21  # of a word's label in a phrase's key
MASK = (1 << BITS) - 1
SAMPLE_ONE_IN, SAMPLE_PER_TEXT, SAMPLE_PER_RANGE = 64, 256, 64
BOUND_BYTES = 64
_SALTS = 64
# What ends a piece, what separates words, and the byte that stands for a piece's end (no UTF-8 text has it).
PIECE_ENDS, TAB, BREAK = b".,;:!?\x0a\x0b\x0c\x0d", b"\x09", b"\xff"
_TABLE = bytes.maketrans(PIECE_ENDS + TAB, b"\n" * len(PIECE_ENDS) + b" ")
_CUT = 1 << 20


class _Numbers(dict):
    """Words numbered in the order they are first seen; a piece's end is 0."""

    def __init__(self) -> None:
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_numbers(text: bytes, numbers: _Numbers) -> Iterator[np.ndarray]:
    """The numbers of the words of a text and of its pieces' ends."""
    text = text.lower().translate(_TABLE)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + _CUT) if len(text) - at > _CUT else -1
        end = len(text) if end < 0 else end
        words = text[at:end].replace(b"\n", b" \xff ").split()  # spaces are all white space that is left
        yield np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))
        at = end


# ------------------------------------------------------------------ sorted phrases
Phrases = tuple[list[bytes], np.ndarray, np.ndarray]  # sorted words, sorted keys, counts


def key_of(a, b=0, c=0):
    """A phrase's key: labels (from 1; 0: no word) of its words, first word highest."""
    return (a << 2 * BITS) | (b << BITS) | c


def labels(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return keys >> 2 * BITS, keys >> BITS & MASK, keys & MASK


def count_phrases(numbers: _Numbers, stream: np.ndarray) -> Phrases:
    """All phrases of one to three words of a stream of word numbers."""
    names = sorted(w for w in numbers if w != BREAK)
    rank = np.zeros(len(numbers), dtype=np.int64)
    rank[np.fromiter(map(numbers.__getitem__, names), dtype=np.int64, count=len(names))] = np.arange(1, len(names) + 1)
    r = rank[stream]
    one = np.bincount(r, minlength=len(names) + 1)[1:]
    a, b, c = r[:-1], r[1:], np.append(r[2:], 0)
    two = (a > 0) & (b > 0)
    three = two & (c[:len(two)] > 0)
    keys = np.concatenate([key_of(a[two], b[two]), key_of(a[three], b[three], c[:len(three)][three])])
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, n = keys[first], np.diff(np.append(first, len(keys)))
    single = key_of(np.arange(1, len(names) + 1, dtype=np.int64))
    keys, n = np.concatenate([single, keys]), np.concatenate([one, n])
    order = np.argsort(keys, kind="stable")
    return names, keys[order], n[order]


def cut_points(names: list[bytes], keys: np.ndarray, bounds: list[tuple[bytes, bytes, bytes]]) -> np.ndarray:
    """Where each bound lies in the sorted keys."""
    at = []
    for bound in bounds:
        key = 0
        for k, w in enumerate(bound):
            if not w:
                break
            i = bisect_left(names, w)
            key |= (i + 1) << BITS * (2 - k)
            if i == len(names) or names[i] != w:
                break
        at.append(key)
    return np.searchsorted(keys, np.array(at, dtype=np.int64))


def by_range(names: list[bytes], keys: np.ndarray, lang: str, bounds: list) -> Iterator[tuple[int, slice]]:
    """The non-empty slices of the sorted keys by prefix range; ``bounds`` are sorted ``(lang, word, word, word)``."""
    lo, hi = bisect_left(bounds, (lang,)), bisect_left(bounds, (lang + "\0",))
    cuts = np.concatenate([[0], cut_points(names, keys, [b[1:] for b in bounds[lo:hi]]), [len(keys)]])
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        yield lo + k, slice(int(cuts[k]), int(cuts[k + 1]))


def narrowed(phrases: Phrases, part: slice) -> Phrases:
    """A slice of the phrases with the words it uses."""
    names, keys, n = phrases
    abc = labels(keys[part])
    used = np.zeros(len(names) + 1, dtype=bool)
    for x in abc:
        used[x] = True
    used[0] = False
    new = np.cumsum(used)
    new[0] = 0
    return [names[i - 1] for i in np.flatnonzero(used).tolist()], key_of(*(new[x] for x in abc)), n[part]


# ------------------------------------------------------------------ transducers
class CountTransducer:
    """A minimal acyclic automaton over words (labels from 1); state 0 has no arcs.

    The arcs of state ``s`` are ``first[s]`` to ``first[s + 1]``, by rising label; an arc's weight is the count of
    the phrase that ends with it (0: no such phrase here).
    """

    def __init__(self, names: list[bytes], first: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray,
                 root: int) -> None:
        self.names, self.first, self.label, self.weight, self.target, self.root = names, first, label, weight, target, root

    def phrases(self) -> Phrases:
        """All phrases with a weight, sorted."""
        key, state, keys, weights = np.zeros(1, np.int64), np.array([self.root]), [], []
        for shift in (2 * BITS, BITS, 0):
            n = self.first[state + 1] - self.first[state]
            arc = np.repeat(self.first[state] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            key, state = np.repeat(key, n) | self.label[arc] << shift, self.target[arc]
            keys.append(key)
            weights.append(self.weight[arc])
        key, weight = np.concatenate(keys), np.concatenate(weights)
        order = np.argsort(key, kind="stable")
        order = order[weight[order] > 0]
        return self.names, key[order], weight[order]

    def compose(self, asked: Phrases) -> np.ndarray:
        """Weights of the phrases of an acceptor: both automata are walked together, word by word."""
        where = {w: k + 1 for k, w in enumerate(self.names)}
        own = np.array([0] + [where.get(w, 0) for w in asked[0]], dtype=np.int64)
        state_of = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        arcs = state_of << BITS + 1 | self.label  # sorted, as arcs are
        state, out = np.full(len(asked[1]), self.root), np.zeros(len(asked[1]), np.int64)
        alive = np.ones(len(out), dtype=bool)
        for x in labels(asked[1]):
            go = np.flatnonzero((x > 0) & alive)
            want = state[go] << BITS + 1 | own[x[go]]
            at = np.minimum(np.searchsorted(arcs, want), max(len(arcs) - 1, 0))
            hit = (arcs[at] == want) if len(arcs) else np.zeros(len(go), dtype=bool)
            alive[go[~hit]] = False
            out[go[~hit]] = 0
            state[go[hit]], out[go[hit]] = self.target[at[hit]], self.weight[at[hit]]
        return out

    def to_bytes(self) -> bytes:
        heads = [b" ".join(self.names), pack_numbers(np.diff(self.first)), pack_numbers(self.label),
                 pack_numbers(self.weight), pack_numbers(self.target)]
        raw = b"".join([np.array([self.root, *map(len, heads)], dtype="<i8").tobytes(), *heads])
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountTransducer:
        raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
        root, *sizes = np.frombuffer(raw[:48], "<i8").tolist()
        parts, at = [], 48
        for n in sizes:
            parts.append(raw[at:at + n])
            at += n
        arcs = [unpack_numbers(x) for x in parts[1:]]
        return cls(parts[0].split(b" ") if parts[0] else [], np.concatenate([[0], np.cumsum(arcs[0])]).astype(np.int64),
                   *arcs[1:], root)


class Builder:
    """Builds a transducer from phrases that come in sorted order.

    ``add`` takes all phrases of some first words; what lies below these is finished, so
    its states are frozen: looked up among the frozen states, and kept if new. Only the root stays open.
    """

    def __init__(self, names: list[bytes]) -> None:
        self.names, self.known = names, {b"": 0}
        self.sizes: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.arcs: list[np.ndarray] = []  # rows of label, weight, target
        self.root: list[np.ndarray] = []

    def _freeze(self, arcs: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Numbers of the states whose arcs start at the given rows of ``arcs``."""
        if not len(start):
            return np.empty(0, np.int64)
        n = np.diff(np.append(start, len(arcs)))
        mixed = arcs.astype(np.uint64) * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
        h = (mixed[:, 0] ^ mixed[:, 1] >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93) + mixed[:, 2] ^ mixed[:, 1]
        sign = np.add.reduceat(h ^ h >> np.uint64(31), start) + n.astype(np.uint64)
        _, rep, group = np.unique(sign, return_index=True, return_inverse=True)
        # equal signatures are only a hint: every state is compared with the one that stands for it
        within = np.arange(len(arcs)) - np.repeat(start, n)
        like = np.repeat(start[rep[group]], n) + within
        if (n != n[rep[group]]).any() or (arcs != arcs[np.minimum(like, len(arcs) - 1)]).any():
            rep = group = np.arange(len(start))
        number, fresh = np.empty(len(rep), np.int64), []
        for k, (a, m) in enumerate(zip(start[rep].tolist(), n[rep].tolist(), strict=True)):
            key = arcs[a:a + m].tobytes()
            got = self.known.get(key)
            if got is None:
                self.known[key] = got = len(self.known)
                fresh.append(k)
            number[k] = got
        if fresh:
            a, m = start[rep[fresh]], n[rep[fresh]]
            rows = np.repeat(a - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            self.sizes.append(m)
            self.arcs.append(arcs[rows])
        return number[group]

    def _level(self, path: np.ndarray, weight: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefixes and numbers of the states that the arcs of a level leave, from sorted paths (keys cut behind it)."""
        arcs = np.stack([path & MASK, weight, target], axis=1)
        up = path >> BITS
        start = np.flatnonzero(np.diff(up, prepend=-1))
        return up[start], self._freeze(arcs, start)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        a, b, c = labels(keys)
        size = 1 + (b > 0) + (c > 0)
        path, state = np.empty(0, np.int64), np.empty(0, np.int64)
        for level, shift in ((3, 0), (2, BITS), (1, 2 * BITS)):
            own = np.flatnonzero(size == level)
            here = keys[own] >> shift
            both = np.union1d(here, path)  # prefixes of longer phrases need an arc too
            weight, target = np.zeros(len(both), np.int64), np.zeros(len(both), np.int64)
            weight[np.searchsorted(both, here)] = counts[own]
            target[np.searchsorted(both, path)] = state
            if level == 1:
                self.root.append(np.stack([both, weight, target], axis=1))
            else:
                path, state = self._level(both, weight, target)

    def done(self) -> CountTransducer:
        root = np.concatenate([np.empty((0, 3), np.int64), *self.root])
        sizes = np.concatenate([*self.sizes, [len(root)]])
        arcs = np.concatenate([*self.arcs, root])
        return CountTransducer(self.names, np.concatenate([[0], np.cumsum(sizes)]), arcs[:, 0], arcs[:, 1], arcs[:, 2],
                               len(sizes) - 1)


def build(phrases: Phrases) -> CountTransducer:
    names, keys, n = phrases
    out = Builder(names)
    heads = keys >> 2 * BITS
    at = 0
    while at < len(keys):
        end = int(np.searchsorted(heads, heads[min(at + CHUNK, len(keys)) - 1], side="right"))
        out.add(keys[at:end], n[at:end])
        at = end
    return out.done()


def united(parts: list[Phrases]) -> Phrases:
    """The union of the phrases of several transducers, weights added."""
    if len(parts) == 1:
        return parts[0]
    names = sorted(set().union(*(p[0] for p in parts)))
    if len(names) > MASK:
        raise RuntimeError("a prefix range holds more words than labels: raise spark.sql.shuffle.partitions")
    where = {w: k + 1 for k, w in enumerate(names)}
    keys = []
    for own, k, _ in parts:
        new = np.array([0, *map(where.__getitem__, own)], dtype=np.int64)
        keys.append(key_of(*(new[x] for x in labels(k))))
    key, n = np.concatenate(keys), np.concatenate([p[2] for p in parts])
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return names, key[first], np.add.reduceat(n[order], first) if len(first) else n


# ------------------------------------------------------------------ tasks
def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
                                      schema=schema)


_PIECES = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("automaton", pa.binary())])


def _shards(bounds: list, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        words = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in sorted(held):
                numbers, streams = held.pop(lang)
                all_ = count_phrases(numbers, np.concatenate(streams))
                for k, part in by_range(all_[0], all_[1], lang, bounds):
                    yield _batch([(k, lang, build(narrowed(all_, part)).to_bytes())], _PIECES)

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                numbers, streams = held.setdefault(lang, (_Numbers(), []))
                for x in word_numbers(text.as_py(), numbers):
                    streams.append(x)
                    words += len(x)
                streams.append(np.zeros(1, np.int32))
                if words >= shard_words or len(numbers) >= SHARD_VOCABULARY:
                    yield from flush()
                    words = 0
        yield from flush()
    return run


_PENDING = 6_000_000


def _union(min_count: int):
    schema = pa.schema([*_PIECES, ("n_words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def finish() -> pa.RecordBatch:
            names, keys, n = united(held)
            words = int(n[keys & key_of(0, MASK, MASK) == 0].sum())
            all_ = names, keys[n >= min_count], n[n >= min_count]
            return _batch([(*at, build(narrowed(all_, slice(None))).to_bytes(), words)], schema)

        for b in batches:
            for r, lang, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (r, lang) != at:
                    if held:
                        yield finish()
                    at, held = (r, lang), []
                held.append(CountTransducer.from_bytes(blob).phrases())
                if sum(len(p[1]) for p in held) > max(_PENDING, 2 * len(held[0][1])):
                    held = [united(held)]
        if held:
            yield finish()
    return run


def asked_parts(keys: np.ndarray) -> np.ndarray:
    """Keys of all parts of the candidates among ``keys``, sorted, each once."""
    a, b, c = labels(keys)
    two, three = (b > 0) & (c == 0), c > 0
    return np.unique(np.concatenate([key_of(a[two]), key_of(b[two]), key_of(a[three]), key_of(b[three], c[three]),
                                     key_of(a[three], b[three]), key_of(c[three])]))


_ASKED = pa.schema([("range", pa.int32()), ("asker", pa.int32()), ("lang", pa.string()), ("automaton", pa.binary())])


def _ask(bounds: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, lang, blob in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                names, keys, _ = CountTransducer.from_bytes(blob).phrases()
                parts = asked_parts(keys)
                all_ = names, parts, np.ones(len(parts), np.int64)
                for k, part in by_range(names, parts, lang, bounds):
                    yield _batch([(k, r, lang, build(narrowed(all_, part)).to_bytes())], _ASKED)
    return run


_ANSWERS = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("answerer", pa.int32()), ("weights", pa.binary())])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Composes the acceptors of a range with its transducers; these come first (no asker)."""
    at, own = None, {}
    for b in batches:
        for r, asker, lang, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if r != at:
                at, own = r, {}
            automaton = CountTransducer.from_bytes(blob)
            if asker is None:
                own[lang] = automaton
            else:
                yield _batch([(asker, lang, r, pack_numbers(own[lang].compose(automaton.phrases())))], _ANSWERS)


_CANDIDATES = ("lang string, phrase string, a bigint, l1 bigint, r1 bigint, l2 bigint, r2 bigint")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates with the counts of their parts: a range's transducer, then the answers by answering range."""
    at, own, got = None, None, []

    def finish() -> Iterator[pa.RecordBatch]:
        names, keys, n = own.phrases()
        parts, counts = asked_parts(keys), np.concatenate([np.empty(0, np.int64), *got])
        if len(parts) != len(counts):
            raise RuntimeError("answers are missing")
        of = lambda k: counts[np.searchsorted(parts, k)]
        for lo in range(0, len(keys), CHUNK):
            key, count = keys[lo:lo + CHUNK], n[lo:lo + CHUNK]
            a, b, c = labels(key)
            two, three = (b > 0) & (c == 0), c > 0
            out = np.zeros((4, len(key)), np.int64)
            out[0][two | three] = of(key_of(a[two | three]))
            out[1][two], out[1][three] = of(key_of(b[two])), of(key_of(b[three], c[three]))
            out[2][three], out[3][three] = of(key_of(a[three], b[three])), of(key_of(c[three]))
            rows = np.flatnonzero(two | three)
            phrase = [b" ".join([names[i - 1] for i in abc if i]) for abc in
                      zip(a[rows].tolist(), b[rows].tolist(), c[rows].tolist(), strict=True)]
            none = pa.array(~three[rows])
            cols = [pa.array(o[rows]) for o in out]
            cols[2:] = [pa.array(o[rows], mask=np.asarray(none)) for o in out[2:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([at[1]] * len(rows), pa.string()), pa.array(phrase, pa.binary()).cast(pa.string()),
                 pa.array(count[rows]), *cols], names=["lang", "phrase", "a", "l1", "r1", "l2", "r2"])

    for b in batches:
        for r, lang, answerer, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if answerer is None:
                if own is not None:
                    yield from finish()
                at, own, got = (r, lang), CountTransducer.from_bytes(blob), []
            else:
                got.append(unpack_numbers(blob))
    if own is not None:
        yield from finish()


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
            words = text.as_py().lower().translate(_TABLE).split()
            step = -(-len(words) // SAMPLE_PER_TEXT) or 1
            rows += [(lang, *([w[:BOUND_BYTES] for w in words[k:k + 3]] + [b"", b""])[:3]) for k in range(0, len(words), step)]
        if rows:
            yield _batch(rows, pa.schema([("lang", pa.string())] + [(f"w{k}", pa.binary()) for k in range(3)]))


def range_bounds(rows: DataFrame, ranges: int) -> list[tuple[str, bytes, bytes, bytes]]:
    """At most ``ranges - 1`` sorted bounds of the prefix ranges, from at most ``SAMPLE_PER_RANGE`` phrases a range."""
    some = rows.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_ONE_IN)) == 0).mapInArrow(
        _sampled, "lang string, w0 binary, w1 binary, w2 binary").distinct()
    picked = some.orderBy(F.xxhash64("lang", "w0", "w1", "w2")).limit(ranges * SAMPLE_PER_RANGE).collect()
    got = sorted((r.lang, *(bytes(w) for w in r[1:])) for r in picked)
    return sorted({got[len(got) * k // ranges] for k in range(1, ranges)}) if got else []


def _with_scores(df: DataFrame) -> DataFrame:
    """The lower-scoring cut's ``l``, ``r`` and ``score`` (ties: the first cut)."""
    def score(left: str, right: str) -> Column:
        return F.expr(f"CAST(a AS DECIMAL(16,0)) * a * 1000000 div (CAST({left} AS DECIMAL(16,0)) * CAST({right} AS DECIMAL(16,0)))")

    second = F.col("s2") < F.col("s1")
    return df.withColumns({"s1": score("l1", "r1"), "s2": score("l2", "r2")}).withColumns({
        k: F.when(F.coalesce(second, F.lit(False)), F.col(two)).otherwise(F.col(one))
        for k, one, two in (("l", "l1", "l2"), ("r", "r1", "r2"), ("score", "s1", "s2"))})


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP,
         ranges: int | None = None, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best phrases of two or three words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts at its lower-scoring cut, ``n`` the language's words;
    ``score`` is floor(10^6 a^2 / (l r)). A phrase that lies in a longer candidate of at least half its count is left out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    width = shuffle_width(spark)
    bounds = range_bounds(rows, ranges or 2 * width)  # at most 2 * width bounds of some 200 bytes
    sorted_by = lambda df, *order: df.repartition(width, "range").sortWithinPartitions("range", *order)
    pieces = rows.mapInArrow(_shards(bounds, shard_words), "range int, lang string, automaton binary")
    counts = materialize(sorted_by(pieces, "lang").mapInArrow(
        _union(min_count), "range int, lang string, automaton binary, n_words bigint"))
    none = F.lit(None).cast("int")
    asked = counts.mapInArrow(_ask(bounds), "range int, asker int, lang string, automaton binary")
    own = counts.select("range", none.alias("asker"), "lang", "automaton")
    answers = sorted_by(own.unionByName(asked), F.asc_nulls_first("asker")).mapInArrow(
        _answer, "range int, lang string, answerer int, weights binary")
    own = counts.select("range", "lang", none.alias("answerer"), F.col("automaton").alias("weights"))
    scored = materialize(_with_scores(sorted_by(own.unionByName(answers), "lang", F.asc_nulls_first("answerer")).mapInArrow(
        _candidates, _CANDIDATES)))
    longer = scored.where("l2 IS NOT NULL")
    inside = longer.where("100 * a >= 50 * l2").select("lang", F.substring_index("phrase", " ", 2).alias("phrase")).unionByName(
        longer.where("100 * a >= 50 * r1").select("lang", F.substring_index("phrase", " ", -2).alias("phrase")))
    left = scored.join(inside, ["lang", "phrase"], "left_anti")
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    best = left.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(
        F.col("_rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(
        F.col("rank") <= top)
    total = counts.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
