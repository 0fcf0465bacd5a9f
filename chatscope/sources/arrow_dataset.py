"""Folders of Arrow shards, as dataset libraries save them (A3, B1): a source and a sink.

A saved dataset is a folder with ``state.json``, which lists its shards, and Arrow IPC files; a saved set of splits has
``dataset_dict.json`` and a folder per split. ``read_arrow_dataset`` and ``write_arrow_dataset`` go through a Python
data source:

* *Planning* looks at file sizes and one schema only. A partition is a byte range of a shard.
* *Reading.* A task walks the message headers of its shard, seeks past the bodies that are not its own, and reads the
  record batches that begin in its range, plus the dictionaries they need. Columns that were not asked for are not decoded.
* *Writing.* One shard per partition; only committed shards enter ``state.json``, which is written last, so a failed or
  repeated task leaves nothing that is read.

Unsigned integers become the next wider type, half floats become floats, and dictionary columns their values.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

PARTITION_BYTES = 128 << 20
BATCH_ROWS = 10_000  # a written batch; the unit in which a shard can be split
# Fixed values of the formats.
FILE_MAGIC, CONTINUATION = b"ARROW1", 0xFFFFFFFF
SCHEMA_MESSAGE, DICTIONARY_MESSAGE, BATCH_MESSAGE = 1, 2, 3
_WIDER = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(), pa.uint64(): pa.decimal128(20, 0),
          pa.float16(): pa.float32()}


# ------------------------------------------------------------------ folders
def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    fs, root = pafs.FileSystem.from_uri(path)
    return fs, root.rstrip("/")


def _read_json(fs: pafs.FileSystem, path: str) -> dict | None:
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def shards(path: str) -> list[tuple[str, int]]:
    """The shards of a saved dataset in order, with their sizes; a folder without ``state.json`` counts all its .arrow files."""
    fs, root = _fs(path)
    if fs.get_file_info(root).type != pafs.FileType.Directory:
        raise FileNotFoundError(f"no saved dataset at {path}")
    state = _read_json(fs, f"{root}/state.json")
    if state is not None:
        infos = fs.get_file_info([f"{root}/{f['filename']}" for f in state["_data_files"]])
        lost = [i.path for i in infos if i.type != pafs.FileType.File]
        if lost:
            raise FileNotFoundError(f"{path} has lost {lost[0]}")
    else:
        splits = _read_json(fs, f"{root}/dataset_dict.json")
        if splits is not None:
            raise ValueError(f"{path} holds the splits {splits['splits']}: name one")
        infos = sorted((i for i in fs.get_file_info(pafs.FileSelector(root)) if i.path.endswith(".arrow")), key=lambda i: i.path)
    return [(i.path, i.size) for i in infos]


# ------------------------------------------------------------------ Arrow files
def _plain(kind: pa.DataType) -> pa.DataType:
    return _plain(kind.value_type) if pa.types.is_dictionary(kind) else _WIDER.get(kind, kind)


def _chosen(schema: pa.Schema, columns: list[str] | None) -> pa.Schema:
    names = schema.names if columns is None else columns
    missing = [n for n in names if n not in schema.names]
    if missing:
        raise ValueError(f"no column {missing[0]!r} among {schema.names}")
    return pa.schema([pa.field(n, _plain(schema.field(n).type)) for n in names])


def _is_file_format(f: pa.NativeFile) -> bool:
    f.seek(0)
    found = f.read(6) == FILE_MAGIC
    f.seek(0)
    return found


def _schema(fs: pafs.FileSystem, path: str) -> pa.Schema:
    with fs.open_input_file(path) as f:
        return (pa.ipc.open_file(f) if _is_file_format(f) else pa.ipc.open_stream(f)).schema


def _kind_and_body(header: bytes) -> tuple[int, int]:
    """A message's kind and the length of its body, from its metadata (a flat buffer: fields 1 and 3 of the root table)."""
    (root,) = struct.unpack_from("<I", header)
    (back,) = struct.unpack_from("<i", header, root)
    table = root - back
    (size,) = struct.unpack_from("<H", header, table)

    def place(field: int) -> int:
        return struct.unpack_from("<H", header, table + 4 + 2 * field)[0] if 4 + 2 * field < size else 0

    kind = header[root + place(1)] if place(1) else 0
    return kind, struct.unpack_from("<q", header, root + place(3))[0] if place(3) else 0


def messages(f: pa.NativeFile) -> Iterator[tuple[int, int, int]]:
    """``(kind, offset, length)`` of the messages of a stream; bodies are not read."""
    at, end = 0, f.size()
    while at < end:
        f.seek(at)
        head = f.read(8)
        if len(head) < 4:
            return
        mark, size = struct.unpack("<II", head.ljust(8, b"\0"))
        start = 8
        if mark != CONTINUATION:  # the older framing has no continuation mark
            size, start = mark, 4
            f.seek(at + 4)
        if size == 0:
            return
        header = f.read(size)
        if len(header) < size:
            raise ValueError(f"the message at byte {at} is cut off")
        kind, body = _kind_and_body(header)
        length = start + size + body
        if at + length > end:
            raise ValueError(f"the message at byte {at} is cut off")
        yield kind, at, length
        at += length


class _Segments(io.RawIOBase):
    """Some byte ranges of a file, read as one stream."""

    def __init__(self, f: pa.NativeFile, ranges: list[tuple[int, int]]) -> None:
        self.f, self.ranges = f, list(reversed(ranges))

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        if not self.ranges:
            return 0
        at, left = self.ranges.pop()
        self.f.seek(at)
        got = self.f.read(min(left, len(buffer)))
        buffer[:len(got)] = got
        if left > len(got):
            if not got:
                raise EOFError("the file has become shorter")
            self.ranges.append((at + len(got), left - len(got)))
        return len(got)


def read_range(fs: pafs.FileSystem, path: str, start: int, end: int, columns: list[str] | None) -> Iterator[pa.RecordBatch]:
    """The record batches of a shard that begin in ``[start, end)``."""
    with fs.open_input_file(path) as f:
        if _is_file_format(f):
            size = max(f.size(), 1)
            r = pa.ipc.open_file(f)
            out = _chosen(r.schema, columns)
            r = pa.ipc.open_file(f, options=_only(r.schema, columns))
            n = r.num_record_batches
            for k in range(n):  # no offsets are known: batches count as equally long
                if start <= k * size // n < end:
                    yield _cast(r.get_batch(k), out)
            return
        ranges, own, pending = [], False, []
        for kind, at, length in messages(f):
            if at >= end and kind == BATCH_MESSAGE:
                break
            if kind == BATCH_MESSAGE and at < start:
                continue
            pending.append((at, length))
            if kind == BATCH_MESSAGE:
                own = True
                ranges, pending = ranges + pending, []
        if not own:
            return
        schema = pa.ipc.read_schema(_prefix(f, ranges[0]))
        out = _chosen(schema, columns)
        with pa.ipc.open_stream(pa.PythonFile(_Segments(f, ranges), mode="r"), options=_only(schema, columns)) as r:
            for b in r:
                yield _cast(b, out)


def _prefix(f: pa.NativeFile, part: tuple[int, int]) -> pa.BufferReader:
    f.seek(part[0])
    return pa.BufferReader(f.read(part[1]))


def _only(schema: pa.Schema, columns: list[str] | None) -> pa.ipc.IpcReadOptions:
    if columns is None:
        return pa.ipc.IpcReadOptions()
    return pa.ipc.IpcReadOptions(included_fields=sorted(schema.get_field_index(c) for c in columns))


def _cast(b: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    cols = []
    for f in schema:
        c = b.column(b.schema.get_field_index(f.name))
        c = c.dictionary_decode() if pa.types.is_dictionary(c.type) else c
        cols.append(c if c.type == f.type else c.cast(f.type))
    return pa.RecordBatch.from_arrays(cols, schema=schema)


# ------------------------------------------------------------------ the data source
class Ranges(ds.InputPartition):
    def __init__(self, ranges: list[tuple[str, int, int]]) -> None:
        super().__init__(ranges)
        self.ranges = ranges  # shard, first byte, byte behind the last


class ArrowReader(ds.DataSourceReader):
    def __init__(self, path: str, columns: list[str] | None, partition_bytes: int) -> None:
        self.path, self.columns, self.partition_bytes = path, columns, partition_bytes

    def partitions(self) -> list[Ranges]:
        out = []
        for path, size in shards(self.path):
            n = max(1, -(-size // self.partition_bytes))
            cuts = [size * k // n for k in range(n)] + [size + 1]
            out += [Ranges([(path, a, b)]) for a, b in zip(cuts, cuts[1:])]
        return out or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        fs, _ = _fs(self.path)
        for path, start, end in partition.ranges:
            for b in read_range(fs, path, start, end, self.columns):
                for at in range(0, b.num_rows, BATCH_ROWS):
                    yield b.slice(at, BATCH_ROWS)


@dataclass
class Shard(ds.WriterCommitMessage):
    partition: int
    file: str | None
    rows: int


class ArrowWriter(ds.DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, split: str | None) -> None:
        self.path, self.schema, self.split = path, to_arrow_schema(schema), split

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shard:
        fs, root = _fs(self.path)
        part, rows, sink = TaskContext.get().partitionId(), 0, None
        name = f"data-{part:05d}-{uuid.uuid4().hex}.arrow"
        writer = None
        try:
            for b in iterator:
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(f"{root}/{name}")
                    writer = pa.ipc.new_stream(sink, self.schema)
                b = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, self.schema, strict=True)],
                                               schema=self.schema)
                for at in range(0, b.num_rows, BATCH_ROWS):
                    writer.write_batch(b.slice(at, BATCH_ROWS))
                rows += b.num_rows
        finally:
            if writer is not None:
                writer.close()
                sink.close()
        return Shard(part, name if writer is not None else None, rows)

    def commit(self, messages: list[Shard | None]) -> None:
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        done = sorted((m for m in messages if m and m.file), key=lambda m: m.partition)
        if not done:  # an empty table keeps its schema
            done = [Shard(0, f"data-00000-{uuid.uuid4().hex}.arrow", 0)]
            with fs.open_output_stream(f"{root}/{done[0].file}") as f, pa.ipc.new_stream(f, self.schema):
                pass
        state = {"_data_files": [{"filename": m.file} for m in done], "_fingerprint": uuid.uuid4().hex[:16],
                 "_format_columns": None, "_format_kwargs": {}, "_format_type": None, "_output_all_columns": False,
                 "_split": self.split}
        for name, content in (("dataset_info.json", {}), ("state.json", state)):  # readers look for the last
            with fs.open_output_stream(f"{root}/{name}") as f:
                f.write(json.dumps(content, indent=2).encode())

    def abort(self, messages: list[Shard | None]) -> None:
        fs, root = _fs(self.path)
        for m in messages:
            if m and m.file:
                fs.delete_file(f"{root}/{m.file}")


class ArrowDataset(ds.DataSource):
    """``format("arrow_dataset")``; options ``path``, ``columns`` (a JSON list), ``partition_bytes``, ``split`` (when writing)."""

    @classmethod
    def name(cls) -> str:
        return "arrow_dataset"

    def _columns(self) -> list[str] | None:
        return json.loads(self.options["columns"]) if "columns" in self.options else None

    def schema(self) -> StructType:
        fs, _ = _fs(self.options["path"])
        found = shards(self.options["path"])
        if not found:
            raise ValueError(f"{self.options['path']} has no shards")
        return from_arrow_schema(_chosen(_schema(fs, found[0][0]), self._columns()))

    def reader(self, schema: StructType) -> ArrowReader:
        return ArrowReader(self.options["path"], self._columns(), int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> ArrowWriter:
        fs, root = _fs(self.options["path"])
        if fs.get_file_info(f"{root}/state.json").type != pafs.FileType.NotFound:
            raise FileExistsError(f"{self.options['path']} already holds a dataset")
        return ArrowWriter(self.options["path"], schema, self.options.get("split"))


def read_arrow_dataset(spark: SparkSession, path: str, columns: list[str] | None = None, split: str | None = None,
                       partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The rows of a saved dataset, or of one split of a saved set of splits; only ``columns`` are decoded if given."""
    spark.dataSource.register(ArrowDataset)
    r = spark.read.format("arrow_dataset").option("partition_bytes", partition_bytes)
    if columns is not None:
        r = r.option("columns", json.dumps(list(columns)))
    return r.load(path if split is None else f"{path.rstrip('/')}/{split}")


def write_arrow_dataset(df: DataFrame, path: str, split: str | None = None) -> None:
    """Saves ``df`` as a dataset folder, a shard per non-empty partition; an existing dataset is never overwritten."""
    df.sparkSession.dataSource.register(ArrowDataset)
    w = df.write.format("arrow_dataset").mode("append")
    (w.option("split", split) if split else w).save(path)
