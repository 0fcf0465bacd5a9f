"""WARC archives: written by Spark's own text writer, read by a Python data source.

*Writing.* A record is one string (headers, blank line, block), and records end
with two CRLFs, which is the text writer's line separator; so Spark's commit
protocol and file systems apply. Of equal payloads of at least ``min_bytes``, the
record with the largest id is the response; the others are revisits that
refer to it and store no payload.

*Reading.* ``WarcDataSource`` plans partitions of whole files (small files
together, up to ``partition_bytes``), parses a record's headers first, tests the
pushed predicates on them, and seeks past the block of a record that is not wanted or whose
payload was not asked for. Files may be plain or gzip. Filters on header columns are
pushed down by Spark where ``spark.sql.python.filterPushdown.enabled`` is on;
``read_warc`` also takes them as arguments.

Defined results: a null payload is empty; a null id gives a record without a
number (``page_id`` null), never referred to unless no equal payload has an id; rows
repeating both the id and the payload of a response are responses too. A null URL leaves
out the header. A malformed record fails the read with its file and offset. An
empty table writes and reads no records.
"""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from chatscope.llm.common import materialize

MIN_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 50_000
PARTITION_BYTES = 64 << 20
BROADCAST_ROWS = 200_000  # of about 100 bytes
_BATCH_BYTES = 8 << 20
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


# ------------------------------------------------------------------ writing
def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line breaks in a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Adds ``digest``, ``bytes``, ``record_type`` and ``refers_to`` to ``(page_id, url, payload)``.

    Only digests that occur more than once take part in the join. Their table
    is broadcast if it was counted to be small; otherwise both sides are shuffled.
    """
    rows = pages.withColumns({"digest": F.sha1(F.col("payload").cast("binary")), "bytes": F.octet_length("payload").cast("long")})
    groups = materialize(rows.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(
        F.max("page_id").alias("winner"), F.count("*").alias("n")).where("n > 1").drop("n"))
    small = groups.count() <= broadcast_rows
    joined = rows.join(F.broadcast(groups) if small else groups, ["digest", "bytes"], "left")
    again = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return joined.withColumns({
        "record_type": F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        "refers_to": F.when(again, F.col("winner"))}).drop("winner")


def records(rows: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One string column ``value``: the WARC record of each row, without its closing CRLFs."""
    revisit = F.col("record_type") == "revisit"
    head = F.concat(F.lit(HTTP_HEAD), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(head, F.col("payload")))
    length = F.when(revisit, F.lit(0)).otherwise(F.octet_length(head) + F.col("bytes"))
    return rows.select(F.concat(
        F.lit(f"{VERSION}\r\n"), _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"))), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")), _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("X-Payload-Length", F.col("bytes").cast("string")),
        _header("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", length.cast("string")), F.lit("\r\n"), block).alias("value"))


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
               min_bytes: int = MIN_REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    records(with_revisits(rows, min_bytes)).write.option("lineSep", END).option(
        "maxRecordsPerFile", records_per_file).text(path)


# ------------------------------------------------------------------ reading
_COLUMNS = {  # column -> header (lower case)
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type",
    "payload_length": "x-payload-length", "content_length": "content-length"}
_NUMBERS = ("payload_length", "content_length")
SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, refers_to string, "
          "content_type string, payload_length bigint, content_length bigint, headers map<string,string>, "
          "payload binary, file string, offset bigint")
_ARROW = pa.schema([(c, pa.int64() if c in _NUMBERS else pa.string()) for c in _COLUMNS] + [
    ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("file", pa.string()),
    ("offset", pa.int64())])


@dataclass(frozen=True)
class Test:
    """A predicate on one header column; a missing header fulfils none but ``isnull``."""
    column: str
    kind: str
    value: object = None

    def holds(self, row: dict) -> bool:
        v = row.get(self.column)
        if self.kind == "isnull":
            return v is None
        if v is None:
            return False
        return {"eq": lambda: v == self.value, "in": lambda: v in self.value, "notnull": lambda: True,
                "prefix": lambda: v.startswith(self.value), "ge": lambda: v >= self.value, "gt": lambda: v > self.value,
                "le": lambda: v <= self.value, "lt": lambda: v < self.value}[self.kind]()


_KINDS = {ds.EqualTo: "eq", ds.In: "in", ds.StringStartsWith: "prefix", ds.GreaterThanOrEqual: "ge",
          ds.GreaterThan: "gt", ds.LessThanOrEqual: "le", ds.LessThan: "lt", ds.IsNotNull: "notnull", ds.IsNull: "isnull"}


@dataclass
class Files(ds.InputPartition):
    paths: list[str] = field(default_factory=list)

    def __init__(self, paths: list[str]) -> None:
        super().__init__(paths)
        self.paths = paths


class WarcReader(ds.DataSourceReader):
    def __init__(self, path: str, tests: list[Test], payload: bool, partition_bytes: int) -> None:
        self.path, self.tests, self.payload, self.partition_bytes = path, tests, payload, partition_bytes

    def partitions(self) -> list[Files]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "_.")
        out, total = [], 0
        for p, size in files:
            if not out or total + size > self.partition_bytes:
                out.append([])
                total = 0
            out[-1].append(p)
            total += size
        return [Files(x) for x in out] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        for p in partition.paths:
            with fs.open_input_file(p) as raw:
                packed = raw.read(2) == b"\x1f\x8b"
                raw.seek(0)
                f = gzip.GzipFile(fileobj=raw) if packed else raw
                for row in parse_records(io.BufferedReader(f, 1 << 20), p, self.tests, self.payload):
                    rows.append(row)
                    size += 500 + len(row["payload"] or b"")
                    if size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class PushingWarcReader(WarcReader):
    def pushFilters(self, filters: list[ds.Filter]):
        """Takes the filters on header columns; yields the others back to Spark."""
        for f in filters:
            kind = _KINDS.get(type(f))
            if kind and len(f.attribute) == 1 and f.attribute[0] in _COLUMNS:
                self.tests.append(Test(f.attribute[0], kind, getattr(f, "value", None)))
            else:
                yield f


class WarcDataSource(ds.DataSource):
    """``spark.read.format("warc")``; options ``path``, ``payload``, ``partition_bytes``, ``pushdown`` and
    ``is.<column>`` (a JSON list of the values that a header column may have)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        o = {k.lower(): v for k, v in self.options.items()}
        tests = [Test(c, "in", tuple(json.loads(o[f"is.{c}"]))) for c in _COLUMNS if f"is.{c}" in o]
        kind = PushingWarcReader if o.get("pushdown") == "true" else WarcReader
        return kind(o["path"], tests, o.get("payload", "true") == "true",
                    int(o.get("partition_bytes", PARTITION_BYTES)))


def _line(f: io.BufferedReader, where: str) -> bytes:
    line = f.readline()
    if not line.endswith(b"\n"):
        raise ValueError(f"{where}: the record's headers are cut off")
    return line.rstrip(b"\r\n")


def parse_records(f: io.BufferedReader, name: str, tests: list[Test], payload: bool) -> Iterator[dict]:
    """Records passing all tests; blocks are read only for those, and only if ``payload`` is asked for."""
    while True:
        at = f.tell()
        first = f.readline()
        if not first:
            return
        where = f"{name} at {at}"
        if first in (b"\r\n", b"\n"):
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError(f"{where}: no WARC record")
        headers: dict[str, str] = {}
        while line := _line(f, where):
            key, colon, value = line.decode("utf-8", "replace").partition(":")
            if not colon:
                raise ValueError(f"{where}: header without a colon")
            headers[key.strip().lower()] = value.strip()
        try:
            row = {c: headers.get(h) if c not in _NUMBERS or h not in headers else int(headers[h])
                   for c, h in _COLUMNS.items()}
            size = int(headers["content-length"])
        except (KeyError, ValueError) as e:
            raise ValueError(f"{where}: bad or missing length") from e
        start = f.tell()
        wanted = all(t.holds(row) for t in tests)
        row |= {"headers": list(headers.items()), "payload": None, "file": name, "offset": at}
        if wanted and payload:
            block = f.read(size)
            if len(block) < size:
                raise ValueError(f"{where}: the block is cut off")
            http = (row["content_type"] or "").startswith("application/http")
            row["payload"] = block.partition(END.encode())[2] if http else block
        else:
            f.seek(start + size)
        if wanted:
            yield row


def read_warc(spark: SparkSession, path: str, payload: bool = True, partition_bytes: int = PARTITION_BYTES,
              **is_one_of: list[str]) -> DataFrame:
    """The records under ``path`` (columns of ``SCHEMA``) whose header columns have one of the given values.

    Without ``payload`` no block is read. Further filters on header columns
    are pushed down if the session has ``spark.sql.python.filterPushdown.enabled`` on.
    """
    spark.dataSource.register(WarcDataSource)
    r = spark.read.format("warc").option("payload", str(payload).lower()).option("partition_bytes", partition_bytes)
    r = r.option("pushdown", str(spark.conf.get(PUSHDOWN_CONF, "false")).lower())
    for column, values in is_one_of.items():
        if column not in _COLUMNS:
            raise ValueError(f"{column} is no header column")
        r = r.option(f"is.{column}", json.dumps(list(values)))
    return r.load(path)


def page_number(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def round_trip(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
               min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` as WARC under ``path``, read it back: one row per record.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``. Length
    and digest of responses come from the payload read back, those of
    revisits from their headers, whose blocks are never read.
    """
    spark = pages.sparkSession
    write_warc(pages, path, page_id, url, payload, min_bytes)
    got = read_warc(spark, path, record_type=["response"])
    again = read_warc(spark, path, payload=False, record_type=["revisit"])
    number = page_number(F.col("record_id")).alias("page_id")
    return got.select(
        number, F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", F.lit(None).cast("bigint").alias("refers_to"),
    ).unionByName(again.select(
        number, F.col("payload_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
        page_number(F.col("refers_to")).alias("refers_to")))
