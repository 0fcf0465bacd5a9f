"""BPE encoding and decoding through a table of distinct words.

Texts are cut into words at single spaces between non-space characters: byte-level
BPE never merges across such a point, and the space belongs to the word after it.
Work runs in blocks of consecutive rows of a scan:

1. Each block lists its distinct words once, most frequent first, dealt into
   hash buckets.
2. One task sees all listings of its buckets, so each distinct word of the whole
   corpus is encoded exactly once, and its ids go back to the listing blocks.
3. Each block's texts, written as positions in its word list, meet the block's
   ids again and are put together by position. Ids turn back into bytes through
   the id-to-piece table (bounded by the vocabulary, sent to every task).

A block's texts never travel as text, only as word numbers of one to three bytes.
Memory is bounded by ``block_bytes`` and by the distinct words of a bucket. The
block lists and the word numbers come from two runs over the same scan;
a checksum per block fails the job should the two ever differ.

Defined results: null texts count as empty (no ids, the empty text decoded);
repeated rows each get a row; an empty table gives no rows. Very long texts are encoded whole; a run of white
space of any length is one word's piece (``cut_long_runs``).
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatscope.llm.common import materialize, shuffle_width

BLOCK_BYTES = 32 << 20
# white space other than the plain space and \n (in Python's or in Unicode's sense)
_RARE_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def byte_table() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for U+0100 onwards."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def piece_table(tok) -> list[bytes]:
    """id -> bytes of the piece (special tokens: their text)."""
    table, special = byte_table(), {k for k, v in tok.get_added_tokens_decoder().items()}
    out = [b""] * tok.get_vocab_size(with_added_tokens=True)
    for s, i in tok.get_vocab(with_added_tokens=True).items():
        out[i] = s.encode() if i in special else bytes(table[c] for c in s)
    return out


@lru_cache(maxsize=4)
def _pieces_and_decimals(path: str) -> tuple[list[bytes], list[bytes]]:
    pieces = piece_table(load_tokenizer(path))
    return pieces, [str(i).encode() for i in range(len(pieces))]


def split_words(text: str) -> list[str]:
    """Pieces whose BPE ids, joined, are the text's: all but the first have lost the single space before them."""
    if not text:
        return []
    if ("  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " "
            or _RARE_SPACE.search(text)):
        return _CUT.split(text)
    return text.split(" ")  # no white space meets white space: every space is a cut


# The split pattern of byte-level BPE, and its white space.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)  # once per Python worker, not per task
def _encoders(path: str) -> tuple[Callable[[str], list[int]], Callable[[str], np.ndarray]]:
    """``text -> ids`` as a list and as an array."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = {k: v for k, v in model.get("vocab", {}).items() if k not in added}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
    plain = (spec["normalizer"] is None and model["type"] == "BPE" and pre.get("type") == "ByteLevel"
             and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not model.get("dropout")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
             and not model.get("ignore_merges") and len(vocab) == 256 + len(merges)
             and [vocab.get(a + b) for a, b in merges] == list(range(256, 256 + len(merges)))
             and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]))
    if not plain:
        tok = load_tokenizer(path)
        ids_of = lambda text: tok.encode(text, add_special_tokens=False).ids
        return ids_of, lambda text: np.array(ids_of(text), dtype=np.uint32)
    import tiktoken
    table = byte_table()
    ranks = {bytes(table[c] for c in k): v for k, v in vocab.items()}
    enc = tiktoken.Encoding("file", pat_str=SPLIT_PATTERN, special_tokens=added, mergeable_ranks=ranks)
    spaces = tiktoken.Encoding("spaces", pat_str=r"\s+", special_tokens={}, mergeable_ranks=ranks)

    def in_parts(text: str) -> list[int]:
        out: list[int] = []
        for part, is_run in cut_long_runs(text, tuple(added)):
            out += spaces.encode_ordinary(part) if is_run else enc.encode(part, allowed_special="all")
        return out

    def as_list(text: str) -> list[int]:
        try:
            return enc.encode(text, allowed_special="all")
        except ValueError:  # the pattern's look-ahead gives up on runs of about a million spaces
            return in_parts(text)

    def as_array(text: str) -> np.ndarray:
        try:
            return enc.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(in_parts(text), dtype=np.uint32)

    return as_list, as_array


def load_encoder(path: str) -> Callable[[str], list[int]]:
    """``text -> ids`` as the tokenizers library gives them for the file at ``path``, without special tokens added.

    Where the file is plain byte-level BPE whose ids follow the order of its merges, the same
    vocabulary runs in tiktoken, which is several times faster per text;
    any other file runs in the tokenizers library itself.
    """
    return _encoders(path)[0]


def cut_long_runs(text: str, specials: tuple[str, ...] = (), least: int = 1 << 12) -> Iterator[tuple[str, bool]]:
    """``text`` in parts that are encoded apart; flagged ones are white space and one piece of the split pattern.

    By the pattern a run of white space is one piece without its last character, or as a whole
    where the text ends behind it or a special token follows.
    """
    at = 0
    for run in re.finditer(f"[{_SPACE}]{{{least},}}", text):
        end = run.end()
        if end < len(text) and not text.startswith(specials, end):
            end -= 1
        if run.start() > at:
            yield text[at:run.start()], False
        yield text[run.start():end], True
        at = end
    if at < len(text):
        yield text[at:], False


def encoder(name: str = "byte_bpe_50k.json") -> Callable[[str], np.ndarray]:
    """``text -> uint32 ids`` for a public vocabulary file, loaded where it is called."""
    return _encoders(vocabulary_file(name))[1]


def pack_numbers(v: np.ndarray) -> bytes:
    """Non-negative numbers, seven bits a byte, the top bit set on all but a number's last byte."""
    v = v.astype(np.int64)
    size = np.ones(len(v), dtype=np.int64)
    for bits in range(7, 63, 7):
        more = v >> bits > 0
        if not more.any():
            break
        size += more
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(v) else 0, dtype=np.uint8)
    for k in range(int(size.max()) if len(v) else 0):
        m = size > k
        out[(end - size)[m] + k] = ((v[m] >> (7 * k)) & 127) | np.where(size[m] > k + 1, 128, 0)
    return out.tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.int64)
    last = raw < 128
    start = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    k = np.arange(len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * k), start)


class _Numbers(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        return n


class _Block:
    """Distinct words of consecutive texts, numbered by falling frequency (ties: first seen)."""

    def __init__(self) -> None:
        self.ids: list = []
        self.seqs: list[np.ndarray] = []
        self.words = _Numbers()  # a text's first word, which has no space before it, is a one-tuple
        self.size = 0

    def add(self, doc_id, text: str) -> None:
        words = split_words(text)
        if words:
            words[0] = (words[0],)
        self.seqs.append(np.fromiter(map(self.words.__getitem__, words), dtype=np.int32, count=len(words)))
        self.ids.append(doc_id)
        self.size += len(text) + 64

    def ranked(self) -> tuple[list[str], np.ndarray]:
        """Words by rank, and rank by first-seen number."""
        freq = np.bincount(np.concatenate(self.seqs), minlength=len(self.words))
        order = np.argsort(-freq, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        names = [" " + k if type(k) is str else k[0] for k in self.words]
        return [names[i] for i in order.tolist()], rank


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[int, _Block]]:
    """Numbered blocks of a partition's rows ``(doc_id, text, part)``; the numbers are unique over partitions."""
    part, made, block = 0, 0, _Block()
    for b in batches:
        part = b.column(2)[0].as_py() if b.num_rows else part
        for d, t in zip(b.column(0), b.column(1), strict=True):
            block.add(d, t.as_py() or "")
            if block.size >= block_bytes:
                yield (part << 24) + made, block
                made, block = made + 1, _Block()
    if block.ids:
        yield (part << 24) + made, block


def _bucket_of(words: list[str], n: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words), dtype=np.int64, count=len(words)) % n


def _checksum(words: list[str]) -> int:
    return zlib.crc32("\0".join(words).encode())


def word_lists(docs: DataFrame, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(block, bucket, words)``: each block's distinct words of a bucket, by rank."""
    def listed(batches):
        for number, block in _blocks(batches, block_bytes):
            names, _ = block.ranked()
            at = _bucket_of(names, buckets)
            order = np.argsort(at, kind="stable")
            cuts = np.searchsorted(at[order], np.arange(buckets + 1))
            hit = np.flatnonzero(np.diff(cuts))
            order = order.tolist()
            for some in np.array_split(hit, max(1, len(hit) // 64)):
                words = [[names[i] for i in order[cuts[k]:cuts[k + 1]]] for k in some]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([number] * len(some), pa.int64()), "bucket": pa.array(some, pa.int32()),
                    "words": pa.array(words, pa.list_(pa.string()))})
    return docs.mapInArrow(listed, "block bigint, bucket int, words array<string>")


def encode_lists(lists: DataFrame, tokenizer_path: Callable[[], str], width: int) -> DataFrame:
    """``(block, bucket, ids)``: the ids of each listed word; every distinct word is encoded once."""
    def encode(batches):
        encode_word, known = load_encoder(tokenizer_path()), {}
        for b in batches:
            for k in range(b.num_rows):
                words = b.column(2)[k].as_py()
                new = [w for w in words if w not in known]
                known.update(zip(new, map(encode_word, new), strict=True))
                ids = [known[w] for w in words]
                n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
                flat = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(n.sum()))
                # lengths, then 16-bit halves low and (where any is needed) high
                wide = bool((flat >> 16).any())
                data = [pack_numbers(n), (flat & 0xFFFF).astype("<u2").tobytes()]
                yield pa.RecordBatch.from_pydict({
                    "block": b.column(0).slice(k, 1), "bucket": b.column(1).slice(k, 1),
                    "sizes": pa.array([data[0]], pa.binary()), "low": pa.array([data[1]], pa.binary()),
                    "high": pa.array([(flat >> 16).astype("<u2").tobytes() if wide else b""], pa.binary())})

    return (lists.repartition(width, "bucket")
            .mapInArrow(encode, "block bigint, bucket int, sizes binary, low binary, high binary"))


def word_numbers(docs: DataFrame, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each text as its words' ranks in its block: ``(block, doc_id, seq)``, and per block the ranks' buckets."""
    id_type = docs.schema[0].dataType.simpleString()

    def numbered(batches):
        for number, block in _blocks(batches, block_bytes):
            names, rank = block.ranked()
            head = pack_numbers(_bucket_of(names, buckets))
            rows = [(None, head, _checksum(names))] + [
                (d.as_py(), pack_numbers(rank[s]), 0) for d, s in zip(block.ids, block.seqs, strict=True)]
            for at in range(0, len(rows), 1024):
                some = rows[at:at + 1024]
                yield pa.RecordBatch.from_arrays([
                    pa.array([number] * len(some), pa.int64()),
                    pa.array([1 if at == i == 0 else 2 for i in range(len(some))], pa.int32()),
                    pa.array([r[0] for r in some], block.ids[0].type),
                    pa.array([r[1] for r in some], pa.binary()), pa.array([r[2] for r in some], pa.int64())],
                    names=["block", "kind", "doc_id", "seq", "check"])

    return docs.mapInArrow(numbered, f"block bigint, kind int, doc_id {id_type}, seq binary, check bigint")


def _rebuild(tokenizer_path: Callable[[], str], id_type: pa.DataType, columns: Sequence[str]):
    def rebuild(batches):
        makers, tables = [_OUTPUTS[c][2] for c in columns], None
        block, lists, sizes, texts, raw = None, {}, None, [], []
        for b in batches:
            out = []
            for row in b.to_pylist():
                if row["block"] != block:
                    block, lists, raw = row["block"], {}, []
                if row["kind"] == 0:
                    high = np.frombuffer(row["high"], "<u2").astype(np.uint32) << 16 if row["high"] else np.uint32(0)
                    lists[row["bucket"]] = (unpack_numbers(row["seq"]), np.frombuffer(row["low"], "<u2") + high)
                elif row["kind"] == 1:
                    tables = tables or _pieces_and_decimals(tokenizer_path())
                    sizes, texts, raw = _word_table(unpack_numbers(row["seq"]), lists, *tables)
                    if zlib.crc32(b"\0".join(raw)) != row["check"]:
                        raise RuntimeError(f"block {block}: word list and word numbers come from different rows")
                    lists = {}
                else:
                    at = unpack_numbers(row["seq"])
                    where = at.tolist()
                    out.append((row["doc_id"], *[make(at, where, sizes, texts, raw) for make in makers]))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, [id_type, *[_OUTPUTS[c][1] for c in columns]], strict=True)],
                    names=["doc_id", *columns])
    return rebuild


def _decoded(raw: list[bytes], where: list[int]) -> str:
    return b"".join([raw[i] for i in where]).decode("utf-8", "replace")


# column -> SQL type, Arrow type, and how a text's word ranks give it
_OUTPUTS = {
    "n_tokens": ("bigint", pa.int64(), lambda at, where, sizes, texts, raw: int(sizes[at].sum()) if where else 0),
    "ids": ("array<int>", pa.list_(pa.int32()), lambda at, where, sizes, texts, raw: [
        int(x) for i in where for x in texts[i].split(b",")]),
    "text": ("string", pa.string(), lambda at, where, sizes, texts, raw: _decoded(raw, where)),
    "ids_sha256": ("string", pa.string(), lambda at, where, sizes, texts, raw: hashlib.sha256(
        b",".join([texts[i] for i in where])).hexdigest()),
    "decoded_sha256": ("string", pa.string(), lambda at, where, sizes, texts, raw: hashlib.sha256(
        _decoded(raw, where).encode()).hexdigest()),
}


def _word_table(buckets: np.ndarray, lists: dict, pieces: list[bytes], decimal: list[bytes]):
    """Token counts, comma-joined decimal ids and decoded bytes of a block's words, by rank."""
    sizes = np.zeros(len(buckets), dtype=np.int64)
    texts, raw = [b""] * len(buckets), [b""] * len(buckets)
    order = np.argsort(buckets, kind="stable")
    cuts = np.searchsorted(buckets[order], np.arange(int(buckets.max()) + 2)) if len(buckets) else [0]
    for k, (n, flat) in lists.items():
        ranks = order[cuts[k]:cuts[k + 1]]
        if len(ranks) != len(n):
            raise RuntimeError("a block's word list has lost rows")
        sizes[ranks] = n
        ids, at = flat.tolist(), 0
        for r, m in zip(ranks.tolist(), n.tolist(), strict=True):
            own = ids[at:at + m]
            texts[r] = b",".join([decimal[i] for i in own])
            raw[r] = b"".join([pieces[i] for i in own])
            at += m
    return sizes, texts, raw


def encode_and_decode(docs: DataFrame, tokenizer_path: Callable[[], str] = vocabulary_file, doc_id: str = "doc_id",
                      text: str = "text", block_bytes: int = BLOCK_BYTES, is_scan: bool = False,
                      columns: Sequence[str] = ("n_tokens", "ids", "text")) -> DataFrame:
    """``doc_id`` and the chosen columns, one row per input row.

    ``ids`` are the token ids and ``text`` what they decode to; ``ids_sha256`` hashes the decimal ids
    joined by commas, ``decoded_sha256`` the decoded text, for those who need no more. Set ``is_scan`` if ``docs`` reads a table
    directly, so that two runs see the same rows in the same tasks; anything
    else is written to the shared folder first.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    if not is_scan:
        rows = materialize(rows)
    # the scan's own partition number: a task's number would depend on the stage around the scan
    rows = rows.withColumn("part", F.spark_partition_id())
    width = shuffle_width(docs.sparkSession)
    buckets = 4 * width
    encoded = encode_lists(word_lists(rows, buckets, block_bytes), tokenizer_path, width)
    numbers = word_numbers(rows, buckets, block_bytes)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    none = F.lit(None).cast
    both = encoded.select(
        "block", F.lit(0).alias("kind"), none(id_type).alias("doc_id"), F.col("sizes").alias("seq"),
        F.lit(0).cast("bigint").alias("check"), "bucket", "low", "high",
    ).unionByName(numbers.withColumns({"bucket": none("int"), "low": none("binary"), "high": none("binary")}))
    # blocks are few and large: more partitions than blocks, so that few tasks get two
    sorted_ = both.repartition(4 * width, "block").sortWithinPartitions("block", "kind")
    from pyspark.sql.pandas.types import to_arrow_type
    return sorted_.mapInArrow(_rebuild(tokenizer_path, to_arrow_type(rows.schema["doc_id"].dataType), tuple(columns)),
                              f"doc_id {id_type}, " + ", ".join(f"{c} {_OUTPUTS[c][0]}" for c in columns))
