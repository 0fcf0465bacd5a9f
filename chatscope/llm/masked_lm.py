"""Masked pseudo-likelihood: a bidirectional window network scores every token from both sides.

Tokens are A-Z-lower-cased words between ASCII white space. The most frequent words
of the whole corpus (counted in Spark) have an id each; the rest share hashed ids by
their last three bytes. The network looks up embeddings of the two words on
either side of a position, passes them through one tanh layer and predicts the
masked word by a two-level softmax (class, then member), so one prediction costs twice
the root of the vocabulary. A document's score is the sum of the log-probabilities of all its words, each given
its neighbours; ``mean_log_prob`` is per word.

Training. A bounded sample (``WARM_DOCS`` documents of at most ``WARM_CHARS``
characters, smallest id hashes) gives all shards the same start. Then every partition of the corpus
trains on all its words, and the weights are averaged, weighted by words, in rounds
of ``FAN_IN`` until few enough to send to the driver: what is gathered grows with the
corpus, what one task or the driver holds does not.

Defined results: null and empty texts, and texts without a word, have no words,
sum 0.0 and a null mean. An empty corpus leaves the untrained network, which
is then asked nothing. Repeated rows are scored separately.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatscope.llm.common import materialize

SIDE = 32  # classes, and members of a class
VOCAB = SIDE * SIDE
FREQUENT = 24 * SIDE  # words with an id of their own
PAD = VOCAB
REACH = 2  # words on either side
DIM, HIDDEN = 8, 32
WARM_DOCS, WARM_CHARS = 2000, 50_000
FAN_IN = 64
BATCH = 1 << 15
_REMEMBERED = 400_000  # words whose ids a task remembers
BLOCK_WORDS, BLOCK_TOKENS = 400_000, 8_000_000  # distinct words and occurrences after which a block of texts ends
_COUNT_LIMIT = 400_000  # distinct words a counting task holds before it hands on partial sums


def split_words(text: str | bytes | None) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return raw.lower().split()


class _Endings(dict):
    """Last three bytes of a word -> shared id."""

    def __missing__(self, ending: bytes) -> int:
        self[ending] = i = FREQUENT + zlib.crc32(ending) % (VOCAB - FREQUENT)
        return i


class _Ids(dict):
    """word -> id; remembers what it is asked for."""

    def __init__(self, own: dict) -> None:
        super().__init__(own)
        self.endings = _Endings()

    def __missing__(self, word: bytes) -> int:
        self[word] = i = self.endings[word[-3:]]
        return i


class Vocabulary(dict):
    """word -> id of the frequent words; any other word has the id of its ending."""

    def ids(self, text: str | bytes | None) -> np.ndarray:
        words, known = split_words(text), self.__dict__.get("known")
        if known is None or len(known) > _REMEMBERED:
            known = self.__dict__["known"] = _Ids(self)
        return np.fromiter(map(known.__getitem__, words), dtype=np.int32, count=len(words))


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)`` over all texts; tasks add up before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.binary()),
                                               "n": pa.array(list(held.values()), pa.int64())})
        for b in batches:
            for t in b.column(0).cast(pa.binary()).to_pylist():
                held.update(split_words(t))
                if len(held) > _COUNT_LIMIT:
                    yield out()
                    held.clear()
        yield out()

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "word binary, n bigint").groupBy(
        "word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, text: str = "text") -> Vocabulary:
    top = word_counts(docs, text).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()  # FREQUENT rows at most
    return Vocabulary((bytes(r.word), k) for k, r in enumerate(top))


# ------------------------------------------------------------------ the network
SHAPES = {"emb": (VOCAB + 1, DIM), "w1": (2 * REACH * DIM, HIDDEN), "b1": (HIDDEN,), "wc": (HIDDEN, SIDE),
          "bc": (SIDE,), "ww": (SIDE, HIDDEN, SIDE), "bw": (SIDE, SIDE)}
_SIZES = {k: int(np.prod(s)) for k, s in SHAPES.items()}
N_WEIGHTS = sum(_SIZES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        out[k] = flat[at:at + _SIZES[k]].reshape(s)
        at += _SIZES[k]
    return out


def untrained(seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    flat = np.zeros(N_WEIGHTS, dtype=np.float32)
    v = views(flat)
    v["emb"][:] = rng.normal(0, 0.3, v["emb"].shape)
    for k in ("w1", "wc", "ww"):
        v[k][:] = rng.normal(0, SHAPES[k][-2] ** -0.5, v[k].shape)
    return flat


@dataclass
class Windows:
    """The masked words of some texts, their neighbours, and the text of each."""
    context: np.ndarray  # (n, 2 * REACH)
    target: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, texts: list[np.ndarray]) -> Windows:
        gap = np.full(REACH, PAD, dtype=np.int32)
        line = np.concatenate([gap] + [x for t in texts for x in (t, gap)])
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        at = np.arange(int(sizes.sum())) + REACH * (owner + 1)
        ctx = np.stack([line[at + o] for o in range(-REACH, REACH + 1) if o], axis=1)
        return cls(ctx, line[at], owner)


_ONES = np.ones(SIDE, dtype=np.float32)


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of the logits (clipped in place to +-40, so that no maximum need be taken) and their row sums."""
    e = np.exp(np.clip(logits, -40, 40, out=logits))
    return e, e @ _ONES.astype(e.dtype, copy=False)


def _class_slices(cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The order that sorts by class, and where each class then lies."""
    order = np.argsort(cls.astype(np.uint8), kind="stable")  # a radix sort
    cuts = np.searchsorted(cls[order], np.arange(SIDE + 1))
    return order, [(c, slice(cuts[c], cuts[c + 1])) for c in range(SIDE) if cuts[c] < cuts[c + 1]]


def _hidden(v: dict, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.take(v["emb"], context, axis=0).reshape(len(context), -1)
    z = x @ v["w1"]
    z += v["b1"]
    return x, np.tanh(z, out=z)


def _member_logits(v: dict, h: np.ndarray, slices: list[tuple[int, slice]]) -> np.ndarray:
    """Logits of the members of each row's class, for rows sorted by class."""
    out = np.empty((len(h), SIDE), dtype=h.dtype)
    for c, s in slices:
        np.matmul(h[s], v["ww"][c], out=out[s])
        out[s] += v["bw"][c]
    return out


def _picked(table: np.ndarray, k: np.ndarray) -> np.ndarray:
    """``table[i, k[i]]`` of every row."""
    return table.ravel().take(np.arange(len(k)) * SIDE + k)


def log_probs(flat: np.ndarray, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    v = views(flat)
    order, slices = _class_slices(target // SIDE)
    _, h = _hidden(v, np.take(context, order, axis=0))
    cls, member = target[order] // SIDE, target[order] % SIDE

    def of(logits, k):
        _, total = _exponentials(logits)
        return _picked(logits, k) - np.log(total)

    by_class = of(h @ v["wc"] + v["bc"], cls).astype(np.float64)
    by_class += of(_member_logits(v, h, slices), member)
    out = np.empty_like(by_class)
    out[order] = by_class
    return out


def _residual(logits: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Derivative of the log-probability of ``k`` by the logits."""
    e, total = _exponentials(logits)
    e *= (-1 / total)[:, None]
    e[np.arange(len(k)), k] += 1
    return e


def gradient(flat: np.ndarray, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Mean gradient of the log-probability with respect to all weights."""
    v, g = views(flat), np.zeros(N_WEIGHTS, dtype=np.float32)
    d = views(g)
    n = len(target)
    order, slices = _class_slices(target // SIDE)
    context, target = np.take(context, order, axis=0), target[order]
    x, h = _hidden(v, context)
    cls, member = target // SIDE, target % SIDE
    e = _residual(h @ v["wc"] + v["bc"], cls)
    d["wc"][:], d["bc"][:] = h.T @ e, e.sum(axis=0)
    dh = e @ v["wc"].T
    e = _residual(_member_logits(v, h, slices), member)
    d["bw"][[c for c, _ in slices]] = np.add.reduceat(e, [s.start for _, s in slices], axis=0)
    for c, s in slices:
        d["ww"][c] = h[s].T @ e[s]
        dh[s] += e[s] @ v["ww"][c].T
    dz = dh * (1 - h * h)
    d["w1"][:], d["b1"][:] = x.T @ dz, dz.sum(axis=0)
    dx = (dz @ v["w1"].T).reshape(-1, DIM)
    at = context.reshape(-1)
    for k in range(DIM):
        d["emb"][:, k] = np.bincount(at, weights=dx[:, k], minlength=VOCAB + 1)
    return g / n


class Trainer:
    """AdaGrad over minibatches of windows."""

    def __init__(self, flat: np.ndarray, rate: float, batch: int) -> None:
        self.flat, self.rate, self.batch = flat.astype(np.float32).copy(), rate, batch
        self.seen = np.full(N_WEIGHTS, 1e-6, dtype=np.float32)
        self.words = 0
        self._texts: list[np.ndarray] = []
        self._held = 0

    def add(self, ids: np.ndarray) -> None:
        for at in range(0, max(1, len(ids)), 4 * self.batch):  # a very long text in pieces
            part = ids[at:at + 4 * self.batch]
            self._texts.append(part)
            self._held += len(part)
            if self._held >= self.batch:
                self.flush()

    def flush(self) -> None:
        if self._held:
            w = Windows.of(self._texts)
            for at in range(0, len(w.target), self.batch):
                g = gradient(self.flat, w.context[at:at + self.batch], w.target[at:at + self.batch])
                self.seen += g * g
                self.flat += self.rate * g / np.sqrt(self.seen)
            self.words += self._held
        self._texts, self._held = [], 0


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, words, shard = np.zeros(N_WEIGHTS), 0, 0
    for b in batches:
        for s, n, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            total += np.frombuffer(w.as_py(), "<f4") * n
            words, shard = words + n, s
    if words:
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "words": pa.array([words], pa.int64()),
                                          "weights": pa.array([(total / words).astype("<f4").tobytes()], pa.binary())})


_SHARD = "shard bigint, words bigint, weights binary"


def train(docs: DataFrame, vocab: Vocabulary, doc_id: str = "doc_id", text: str = "text", warm_docs: int = WARM_DOCS,
          warm_chars: int = WARM_CHARS, warm_passes: int = 3, rate: float = 0.05) -> np.ndarray:
    """Weights after the shared start and one pass of every partition over all its words."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    words = spark.sparkContext.broadcast(vocab)
    id_type = rows.schema["id"].dataType.simpleString()

    def ids_of(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(
                [words.value.ids(t.as_py()).astype("<i4").tobytes() for t in b.column(1)], pa.binary())], names=["id", "ids"])

    sample = rows.where(F.length("text") <= warm_chars).select("id").orderBy(F.xxhash64("id"), "id").limit(warm_docs)
    # the sample's ids are warm_docs numbers at most
    picked = rows.where(F.length("text") <= warm_chars).join(F.broadcast(sample.distinct()), "id").limit(warm_docs)
    got = picked.mapInArrow(ids_of, f"id {id_type}, ids binary").toArrow().sort_by([("id", "ascending"), ("ids", "ascending")])
    warm = Trainer(untrained(), rate, 1 << 10)
    for _ in range(warm_passes):
        for x in got["ids"]:
            warm.add(np.frombuffer(x.as_py(), "<i4"))
        warm.flush()
    start = spark.sparkContext.broadcast(warm.flat)

    def shard(batches):
        t, part = Trainer(start.value, rate / 5, BATCH // 4), 0
        for b in batches:
            part = b.column(1)[0].as_py() if b.num_rows else part
            for x in b.column(0).cast(pa.binary()).to_pylist():
                t.add(words.value.ids(x))
        t.flush()
        if t.words:
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([part], pa.int64()), "words": pa.array([t.words], pa.int64()),
                "weights": pa.array([t.flat.astype("<f4").tobytes()], pa.binary())})

    shards = materialize(rows.select("text", F.spark_partition_id().cast("bigint").alias("part")).mapInArrow(shard, _SHARD))
    n = shards.count()
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        shards = materialize(shards.repartition(n).mapInArrow(_average, _SHARD))
    last = shards.collect()  # FAN_IN rows at most
    if not last:
        return warm.flat
    share = np.array([r.words for r in last], dtype=np.float64)
    return (np.stack([np.frombuffer(r.weights, "<f4") for r in last]).T @ (share / share.sum())).astype(np.float32)


def score_texts(flat: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Sum of the log-probabilities of each text's words."""
    if not texts:
        return np.empty(0)
    w = Windows.of(texts)
    p = np.concatenate([np.empty(0)] + [log_probs(flat, w.context[a:a + BATCH], w.target[a:a + BATCH])
                                       for a in range(0, len(w.target), BATCH)])
    return np.bincount(w.owner, weights=p, minlength=len(texts)).astype(np.float64)  # whole numbers if no word


def _score_batch(flat: np.ndarray, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and the ids' log-probability of some texts."""
    sums, held, at = [], 0, 0
    for k in range(len(ids)):
        held += len(ids[k])
        if held >= 4 * BATCH or k == len(ids) - 1:
            sums.append(score_texts(flat, ids[at:k + 1]))
            at, held = k + 1, 0
    return np.array([len(x) for x in ids], dtype=np.int64), np.concatenate(sums) if sums else np.empty(0)


_BLOCK_NAMES = ["block", "doc_id", "n_words", "log_prob", "numbers", "words", "counts", "ids", "totals"]


def score(docs: DataFrame, vocab: Vocabulary, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, log_prob, mean_log_prob)`` of the texts' ids, one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast((vocab, weights))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def scored(batches):
        words, flat = shared.value
        for b in batches:
            n, total = _score_batch(flat, [words.ids(t) for t in b.column(1).cast(pa.binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(total)],
                                             names=["doc_id", "n_words", "log_prob"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return _with_mean(rows.mapInArrow(scored, f"doc_id {id_type}, n_words bigint, log_prob double"))


def _with_mean(df: DataFrame) -> DataFrame:
    return df.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))


# ------------------------------------------------------------------ words that share an id
class _Block(dict):
    """word -> id of a frequent word, or FREQUENT and the word's number within the block, in order of first use."""

    def __init__(self, vocab: Vocabulary) -> None:
        super().__init__(vocab)
        self.words: list[bytes] = []
        self.shared: list[int] = []  # the words' ids
        self.endings = _Endings()

    def __missing__(self, word: bytes) -> int:
        self[word] = i = FREQUENT + len(self.words)
        self.words.append(word)
        self.shared.append(self.endings[word[-3:]])
        return i

    def codes(self, text: bytes | None) -> np.ndarray:
        words = split_words(text)
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def ids(self, codes: list[np.ndarray]) -> list[np.ndarray]:
        table = np.concatenate([np.arange(FREQUENT), np.array(self.shared, dtype=np.int64)]).astype(np.int32)
        return [table[c] for c in codes]


def _pack(numbers: np.ndarray | list[int]) -> bytes:
    """Sorted numbers, byte plane by byte plane: the upper planes compress to little."""
    return np.sort(np.asarray(numbers, dtype="<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def score_words(docs: DataFrame, vocab: Vocabulary, weights: np.ndarray, doc_id: str = "doc_id",
                text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """As ``score``, but of the words themselves: log P(id | neighbours) + log P(word | id).

    Word counts are those of ``docs``.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocab, weights))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.spark_partition_id().cast("bigint").alias("part"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    base = (f"block bigint, doc_id {id_type}, n_words bigint, log_prob double, numbers binary, "
            "words array<binary>, counts array<bigint>, ids binary, totals array<bigint>")

    def blocks(batches):
        vocab, flat = shared.value
        numbers, used, serial, part, held = _Block(vocab), [], 0, 0, 0
        doc_type = None

        def close():
            n = np.bincount(np.concatenate(used), minlength=len(numbers.words))
            ids = np.array(numbers.shared, dtype=np.int64) - FREQUENT
            totals = np.bincount(ids, weights=n, minlength=VOCAB - FREQUENT).astype(np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([block()], pa.int64()), pa.nulls(1, doc_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()),
                pa.nulls(1, pa.binary()), pa.array([numbers.words], pa.list_(pa.binary())),
                pa.array([n], pa.list_(pa.int64())), pa.array([ids.astype(np.uint8).tobytes()], pa.binary()),
                pa.array([totals], pa.list_(pa.int64()))], names=_BLOCK_NAMES)

        def block():
            return (part << 32) + serial  # the partition and the block's number in it

        def scored(ids: pa.Array, codes: list[np.ndarray]):
            n, total = _score_batch(flat, numbers.ids(codes))
            own = [c[c >= FREQUENT] - FREQUENT for c in codes]
            used.extend(own)
            m = len(codes)
            return pa.RecordBatch.from_arrays([
                pa.array([block()] * m, pa.int64()), ids, pa.array(n), pa.array(total),
                pa.array([_pack(x) for x in own], pa.binary()), pa.nulls(m, pa.list_(pa.binary())),
                pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.binary()), pa.nulls(m, pa.list_(pa.int64()))],
                names=_BLOCK_NAMES)

        for b in batches:
            if not b.num_rows:
                continue
            part, doc_type = b.column(2)[0].as_py(), b.schema.field(0).type
            at, codes = 0, []
            for k, t in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                codes.append(numbers.codes(t))
                held += int(np.count_nonzero(codes[-1] >= FREQUENT))
                full = len(numbers.words) >= block_words or held >= BLOCK_TOKENS
                if full or k == b.num_rows - 1:
                    yield scored(b.column(0).slice(at, k + 1 - at), codes)
                    at, codes = k + 1, []
                if full:
                    if numbers.words:
                        yield close()
                    numbers, used = _Block(vocab), []
                    serial, held = serial + 1, 0
        if numbers.words:
            yield close()

    made = materialize(rows.mapInArrow(blocks, base))
    listed = made.where(F.col("words").isNotNull())
    totals = np.ones(VOCAB - FREQUENT)
    for r in listed.select(F.posexplode("totals").alias("id", "n")).groupBy("id").agg(F.sum("n").alias("n")).collect():
        totals[r.id] = max(r.n, 1)  # one row per shared id
    each = listed.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        "block", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counted = each.select("block", "at", F.sum("n").over(Window.partitionBy("word")).alias("n"))
    all_of = spark.sparkContext.broadcast(np.log(totals))

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        is_block = np.asarray(left["ids"].is_valid())
        log_share = np.zeros(right.num_rows)
        if right.num_rows:
            (ids,) = left["ids"].filter(pa.array(is_block)).to_pylist()
            log_share[np.asarray(right["at"])] = np.log(np.asarray(right["n"]))
            log_share -= all_of.value[np.frombuffer(ids, np.uint8)]
        left = left.filter(pa.array(~is_block))
        extra = np.array([log_share[_unpack(x.as_py())].sum() for x in left["numbers"]], dtype=np.float64)
        return pa.table({"doc_id": left["doc_id"], "n_words": left["n_words"],
                         "log_prob": pa.array(np.asarray(left["log_prob"]) + extra, pa.float64())})

    texts = made.select("block", "doc_id", "n_words", "log_prob", "numbers", "ids")
    done = texts.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        add, f"doc_id {id_type}, n_words bigint, log_prob double")
    return _with_mean(done)
