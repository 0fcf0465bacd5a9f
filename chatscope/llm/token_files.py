"""Token ids in binary files: frequency-ranked ids, variable-length bytes, control bytes apart.

*Format.* A file is a run of blocks, each readable on its own: the documents' ids (Arrow IPC), their token
counts, the block's token ids by falling frequency (ties: smaller id first), the control bytes and the data
bytes. A token is its rank in one to four little-endian data bytes; the control bytes hold
these lengths, two bits a token, four tokens a byte. The most frequent 256 ids of a block so take one byte
each. A checksum closes a block. ``_manifest.json`` lists the files in order, with their blocks.

*Writing* goes through Spark: documents are range-partitioned and sorted by id, tokenised in order, and a
Python data source writes one file per partition. Every attempt of a task has a file of its own and only the committed
ones enter the manifest, so lost executors leave nothing behind that is read.

*Reading* plans partitions of whole blocks from the manifest. Control bytes give the lengths by a table of 256
rows, cumulative sums the places, and the block's table the ids.

Memory is bounded by ``BLOCK_TOKENS`` and by the longest document (a document is never cut).

Defined results: null texts count as empty (only the end id). Null ids come first; rows that share an id follow
in the order of their text's hash and text. Repeated rows each get a row; an empty table gives none.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from chatscope.llm.bpe import pack_numbers, unpack_numbers
from chatscope.llm.common import shuffle_width

BLOCK_TOKENS = 2 << 20
PARTITION_BYTES = 32 << 20
_OUT_TOKENS = 1 << 20
_DENSE = 1 << 22  # ids below this are counted in an array
MANIFEST = "_manifest.json"
# Fixed values of the format: a block's opening bytes, and its head (five section lengths).
MAGIC = b"TKB1"
_HEAD = struct.Struct("<4s5Q")

# control byte -> the lengths of its four values
SIZES = (np.arange(256, dtype=np.uint8)[:, None] >> np.array([0, 2, 4, 6], dtype=np.uint8) & 3) + 1


# ------------------------------------------------------------------ coding
def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    code[:len(ranks)] = more
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    raw = ranks.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) <= more[:, None]].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    start = np.cumsum(size, dtype=np.int64) - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[start].astype(np.uint32)
    for k in (1, 2, 3):
        long = np.flatnonzero(size > k)
        if not len(long):
            break
        out[long] |= raw[start[long] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encode_block(doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    if len(ids) and int(ids.max()) < _DENSE:  # ids number themselves
        count = np.bincount(ids)
        present, at = np.flatnonzero(count), ids
        order = np.argsort(-count[present], kind="stable")
        rank = np.zeros(len(count), dtype=np.uint32)
        rank[present[order]] = np.arange(len(order), dtype=np.uint32)
    else:
        present, at, count = np.unique(ids, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
    control, data = encode_ranks(rank[at])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("doc_id", doc_ids.type)])) as w:
        w.write_batch(pa.RecordBatch.from_arrays([doc_ids], names=["doc_id"]))
    parts = [sink.getvalue().to_pybytes(), pack_numbers(sizes), present[order].astype("<u4").tobytes(), control, data]
    block = _HEAD.pack(MAGIC, *map(len, parts)) + b"".join(parts)
    return block + struct.pack("<I", zlib.crc32(block))


def decode_block(block: bytes, where: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Document ids, token counts and token ids of a block."""
    magic, *lengths = _HEAD.unpack_from(block)
    if magic != MAGIC or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError(f"{where}: damaged block")
    parts, at = [], _HEAD.size
    for n in lengths:
        parts.append(block[at:at + n])
        at += n
    with pa.ipc.open_stream(parts[0]) as r:
        doc_ids = r.read_all().column(0).combine_chunks()
    sizes = unpack_numbers(parts[1])
    ranks = decode_ranks(parts[3], parts[4], int(sizes.sum()))
    return doc_ids, sizes, np.frombuffer(parts[2], "<u4")[ranks]


# ------------------------------------------------------------------ the data source
def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths in ids and the joined ids of a binary column of little-endian 32-bit ids."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data else np.empty(0, np.uint8)
    return np.diff(off) // 4, raw.copy().view("<u4")


@dataclass
class Written(ds.WriterCommitMessage):
    partition: int
    file: str
    blocks: list[tuple[int, int, int, int]]  # offset, bytes, documents, tokens


class TokenWriter(ds.DataSourceArrowWriter):
    def __init__(self, path: str, id_type: str, block_tokens: int) -> None:
        self.path, self.id_type, self.block_tokens = path, id_type, block_tokens

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok"
        blocks, at = [], 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        with fs.open_output_stream(f"{root}/{name}") as f:
            def close() -> None:
                nonlocal at
                ids = pa.concat_arrays([h[0] for h in held])
                sizes = np.concatenate([h[1] for h in held])
                block = encode_block(ids, sizes, np.concatenate([h[2] for h in held]))
                f.write(block)
                blocks.append((at, len(block), len(ids), int(sizes.sum())))
                at += len(block)
                held.clear()

            room = self.block_tokens
            for b in iterator:
                sizes, flat = _flat(b.column(1))
                ends, row = np.cumsum(sizes), 0
                while row < b.num_rows:
                    done = int(ends[row - 1]) if row else 0
                    stop = min(int(np.searchsorted(ends, done + room)) + 1, b.num_rows)
                    held.append((b.column(0).slice(row, stop - row), sizes[row:stop], flat[done:int(ends[stop - 1])]))
                    room -= int(ends[stop - 1]) - done
                    row = stop
                    if room <= 0:
                        close()
                        room = self.block_tokens
            if held:
                close()
        return Written(part, name, blocks)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        files = [{"file": m.file, "blocks": m.blocks} for m in sorted((m for m in messages if m), key=lambda m: m.partition)]
        with fs.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps({"doc_id": self.id_type, "files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            if m:
                fs.delete_file(f"{root}/{m.file}")


class Blocks(ds.InputPartition):
    def __init__(self, blocks: list[tuple[str, int, int, int]]) -> None:
        super().__init__(blocks)
        self.blocks = blocks  # file, offset, bytes, tokens before


class TokenReader(ds.DataSourceReader):
    def __init__(self, path: str, partition_bytes: int) -> None:
        self.path, self.partition_bytes = path, partition_bytes

    def partitions(self) -> list[Blocks]:
        out, held, before = [[]], 0, 0
        for f in _manifest(self.path)["files"]:
            for offset, size, _, tokens in f["blocks"]:
                if out[-1] and held + size > self.partition_bytes:
                    out.append([])
                    held = 0
                out[-1].append((f["file"], offset, size, before))
                held, before = held + size, before + tokens
        return [Blocks(x) for x in out]

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for name, offset, size, before in partition.blocks:
            with fs.open_input_file(f"{root}/{name}") as f:
                f.seek(offset)
                doc_ids, sizes, ids = decode_block(f.read(size), f"{name} at {offset}")
            ends, row = np.cumsum(sizes), 0
            while row < len(sizes):
                done = int(ends[row - 1]) if row else 0
                stop = min(int(np.searchsorted(ends, done + _OUT_TOKENS)) + 1, len(sizes))
                own = pa.py_buffer(ids[done:int(ends[stop - 1])].astype("<u4").tobytes())
                offs = np.concatenate([[0], ends[row:stop] - done]).astype(np.int64) * 4
                values = pa.Array.from_buffers(pa.large_binary(), stop - row, [None, pa.py_buffer(offs.tobytes()), own])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(row, stop - row), pa.array(before + ends[row:stop] - sizes[row:stop]),
                     pa.array(sizes[row:stop]), values.cast(pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
                row = stop


def _manifest(path: str) -> dict:
    fs, root = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


class TokenFiles(ds.DataSource):
    """``format("token_files")``: writes ``(doc_id, ids)`` in the order of the partitions, reads ``(doc_id, start,
    n_tokens, ids)``; ``ids`` are little-endian unsigned 32-bit numbers. Options ``path``, ``block_tokens``, ``partition_bytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return f"doc_id {_manifest(self.options['path'])['doc_id']}, start bigint, n_tokens bigint, ids binary"

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options["path"], int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        fs, root = pafs.FileSystem.from_uri(self.options["path"])
        if not overwrite and fs.get_file_info(f"{root}/{MANIFEST}").type != pafs.FileType.NotFound:
            raise ValueError(f"{self.options['path']} already holds token files")
        return TokenWriter(self.options["path"], schema["doc_id"].dataType.simpleString(),
                           int(self.options.get("block_tokens", BLOCK_TOKENS)))


# ------------------------------------------------------------------ jobs
def in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, text)`` in ascending order of the ids over the partitions and within them.

    Rows that share an id are dealt by their text's hash, and equal rows by their place in the scan.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
    return rows.repartitionByRange(shuffle_width(docs.sparkSession), "doc_id", "_hash", "_place").sortWithinPartitions(
        "doc_id", "_hash", "text").select("doc_id", "text")


def token_ids(rows: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]], end_id: int | None) -> DataFrame:
    """``(doc_id, ids)`` of ``(doc_id, text)`` in the same order, each document closed by ``end_id``."""
    end = np.array([] if end_id is None else [end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encoder()
        for b in batches:
            out, held, at = [], 0, 0
            for k, t in enumerate(b.column(1)):
                out.append(run(t.as_py()).astype("<u4").tobytes() + end)
                held += len(out[-1])
                if held >= 4 * _OUT_TOKENS or k == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, k + 1 - at), pa.array(out, pa.binary())],
                                                     names=["doc_id", "ids"])
                    out, held, at = [], 0, k + 1
    return rows.mapInArrow(encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def write_tokens(docs: DataFrame, path: str, encoder: Callable[[], Callable[[str], np.ndarray]], end_id: int | None = 2,
                 doc_id: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Tokenises ``docs`` and writes the ids under ``path`` in ascending order of the document ids."""
    docs.sparkSession.dataSource.register(TokenFiles)
    token_ids(in_order(docs, doc_id, text), encoder, end_id).write.format("token_files").option(
        "block_tokens", block_tokens).mode("append").save(path)


def read_tokens(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``: every document written, ``start`` counting the ids of all before it."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").option("partition_bytes", partition_bytes).load(path)


def round_trip(docs: DataFrame, path: str, encoder: Callable[[], Callable[[str], np.ndarray]], end_id: int = 2,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of the documents as read back from the files written under ``path``."""
    write_tokens(docs, path, encoder, end_id, doc_id, text)
    return read_tokens(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
