"""WARC archives as a Python data source for Spark: ``spark.read.format("warc")``.

Writing: each task writes its records into files of at most about ``maxFileBytes`` in the
target folder, under names of its own; the job's commit writes ``_manifest`` with the
files of the tasks that count. Each record is a gzip member of its own, whose extra field
``sl`` holds its compressed and full length. Reading takes the files that manifests name
(or all ``*.warc.gz`` and ``*.warc`` where there is none), so files of failed or repeated
attempts are never read.

Reading: one partition per file (small files together). Filters of the form column =
value and column IN (values) on ``record_type`` and the header columns are pushed down:
a record's header is parsed first, and the block of a record that fails a predicate, or
whose payload is not wanted (option ``payload`` = ``false``), is skipped by a seek,
neither read nor decoded. (Members without ``sl``, as others write them, can only be
skipped by inflating them.)

Columns: record_type, record_id, page_id, target_uri, warc_date, refers_to,
payload_digest (bare hex SHA-256), payload_bytes (of the full payload, also where a
revisit leaves it out), payload (binary; null for revisits and unread payloads).

Cases: null columns are left out of a record's header and read back as null; a null
payload of a response is empty. Line breaks in header values are percent-encoded. Payloads
may hold any bytes, also ``WARC/1.1``. Repeated rows give repeated records. A table
without rows gives archives without records.
"""
from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)

SCHEMA = ("record_type string, record_id string, page_id string, target_uri string, warc_date string, "
          "refers_to string, payload_digest string, payload_bytes long, payload binary")
#: Header field of each column; the fields on pages are extensions, which WARC allows.
FIELDS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "page_id": "WARC-Page-ID", "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "WARC-Payload-Length",
}
_COLUMN = {v.lower(): k for k, v in FIELDS.items()}
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 4 << 20
_BLOCK = 256 << 10
#: Bytes of a member inflated at a time in search of the end of the record's header.
_HEAD = 1024
#: Start of a gzip member with an extra field of 12 bytes: ``sl``, 8, and two lengths.
_GZIP = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H2sH", 12, b"sl", 8)
_GZIP_SIZE = len(_GZIP) + 8


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[5:])


def _quote(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def render(row: dict) -> bytes:
    """One record: header, block (HTTP header and payload), two line ends."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    head = [VERSION.decode()]
    for column, field in FIELDS.items():
        value = row[column]
        if value is None:
            continue
        value = _quote(str(value))
        if column == "payload_digest":
            value = f"sha256:{value}"
        elif column in ("record_id", "refers_to"):
            value = f"<{value}>"
        head.append(f"{field}: {value}")
    if revisit:
        head.append(f"WARC-Profile: {PROFILE}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """The record as a gzip member that states its lengths."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    lengths = struct.pack("<II", _GZIP_SIZE + len(body) + 8, len(record))
    return _GZIP + lengths + body + struct.pack("<II", zlib.crc32(record), len(record))


@dataclass
class _Files(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, limit: int, overwrite: bool):
        self.path, self.limit, self.overwrite = path, limit, overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Files:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        for b in batches:
            for row in b.to_pylist():
                if out is None or size >= self.limit:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = system.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                record = member(render(row))
                out.write(record)
                size += len(record)
        if out is not None:
            out.close()
        return _Files(names)

    def commit(self, messages: list[_Files | None]) -> None:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        if self.overwrite:
            for name, _ in _manifests(system, root):
                system.delete_file(name)
        with system.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}") as f:
            f.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages: list[_Files | None]) -> None:
        system, root = _open(self.path)
        for m in messages:
            for n in m.names if m else []:
                system.delete_file(f"{root}/{n}")


def _manifests(system: fs.FileSystem, root: str) -> list[tuple[str, list[str]]]:
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    out = []
    for f in found:
        if f.base_name.startswith("_manifest-"):
            with system.open_input_stream(f.path) as s:
                out.append((f.path, json.loads(s.read())))
    return out


@dataclass
class _Part(InputPartition):
    files: list[str]


class _Bytes:
    """Lines and blocks of a file; skipping a block seeks over it."""

    def __init__(self, file):
        self.file, self.size, self.at = file, file.size(), 0  # at: file position after the buffer
        self.buffer, self.pos = b"", 0

    def _fill(self, least: int) -> None:
        want = max(least - (len(self.buffer) - self.pos), _BLOCK)
        got = self.file.read_at(min(want, self.size - self.at), self.at)
        self.at += len(got)
        self.buffer, self.pos = self.buffer[self.pos:] + got, 0

    def head(self) -> bytes | None:
        """Up to the next empty line, or None at the end."""
        while True:
            end = self.buffer.find(b"\r\n\r\n", self.pos)
            if end >= 0:
                out = self.buffer[self.pos:end]
                self.pos = end + 4
                return out
            if self.at >= self.size:
                if self.buffer[self.pos:].strip():
                    raise ValueError("a record's header does not end")
                return None
            self._fill(len(self.buffer) - self.pos + 1)

    def take(self, n: int) -> bytes:
        if len(self.buffer) - self.pos < n:
            self._fill(n)
        out = self.buffer[self.pos:self.pos + n]
        if len(out) < n:
            raise ValueError("a record ends before its Content-Length")
        self.pos += n
        return out

    def peek(self, n: int) -> bytes:
        """Up to ``n`` of the next bytes, which stay."""
        if len(self.buffer) - self.pos < n and self.at < self.size:
            self._fill(n)
        return self.buffer[self.pos:self.pos + n]

    def back(self, n: int) -> None:
        """Return the last ``n`` bytes of the last ``take``."""
        self.pos -= n

    def skip(self, n: int) -> None:
        left = len(self.buffer) - self.pos
        if n <= left:
            self.pos += n
        else:
            self.at += n - left
            self.buffer, self.pos = b"", 0


class _Members:
    """The same of a file of gzip members, one record each: ``skip`` goes to the next."""

    def __init__(self, file):
        self.data, self.inflate, self.left, self.out = _Bytes(file), None, None, bytearray()

    def _more(self, n: int) -> None:
        n = len(self.data.peek(n)) if self.left is None else min(n, self.left)
        if n == 0 or self.inflate.eof:
            raise ValueError("a gzip member ends before its record")
        self.out += self.inflate.decompress(self.data.take(n))
        if self.left is None:
            self.data.back(len(self.inflate.unused_data))
        else:
            self.left -= n

    def head(self) -> bytes | None:
        start = self.data.peek(_GZIP_SIZE)
        if not start:
            return None
        sized = len(start) == _GZIP_SIZE and start[10:16] == _GZIP[10:]
        self.left = struct.unpack("<I", start[16:20])[0] if sized else None
        self.inflate, self.out = zlib.decompressobj(31), bytearray()
        while (end := self.out.find(b"\r\n\r\n")) < 0:
            self._more(_HEAD)
        head = bytes(self.out[:end])
        del self.out[:end + 4]
        return head

    def take(self, n: int) -> bytes:
        while len(self.out) < n:
            self._more(_BLOCK)
        return bytes(self.out[:n])

    def skip(self, n: int) -> None:
        if self.left is not None:
            self.data.skip(self.left)
            return
        while not self.inflate.eof:
            self.out.clear()
            self._more(_BLOCK)


def parse_head(head: bytes) -> tuple[dict, int, bool]:
    """(columns, Content-Length, whether the block is an HTTP message)."""
    lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record begins here: {lines[0][:60]!r}")
    row, length, http = {}, 0, False
    for line in lines[1:]:
        name, _, value = line.partition(":")
        name, value = name.strip().lower(), value.strip()
        if name == "content-length":
            length = int(value)
        elif name == "content-type":
            http = value.startswith("application/http")
        elif name in _COLUMN:
            column = _COLUMN[name]
            if column in ("record_id", "refers_to"):
                value = value.removeprefix("<").removesuffix(">")
            elif column == "payload_digest":
                value = value.removeprefix("sha256:")
            row[column] = int(value) if column == "payload_bytes" else unquote(value) if "%" in value else value
    return row, length, http


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, group: int):
        self.path, self.payload, self.group = path, payload, group
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if column in FIELDS and values is not None:
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self) -> list[_Part]:
        system, root = _open(self.path)
        manifests = _manifests(system, root)
        listed = {n for _, names in manifests for n in names}
        files = [f for f in system.get_file_info(fs.FileSelector(root)) if f.base_name.endswith((".warc", ".warc.gz")) and (f.base_name in listed or not manifests)]
        parts, size = [], self.group
        for f in sorted(files, key=lambda f: f.base_name):
            if size >= self.group:
                parts.append(_Part([]))
                size = 0
            parts[-1].files.append(f.path)
            size += f.size
        return parts or [_Part([])]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        system, _ = _open(self.path)
        schema = pa.schema([(c, pa.int64() if c == "payload_bytes" else pa.string()) for c in FIELDS] + [("payload", pa.binary())])
        rows, size = [], 0
        for path in partition.files:
            with system.open_input_file(path) as f:
                for row, length in self._records(_Members(f) if path.endswith(".gz") else _Bytes(f)):
                    rows.append(row)
                    size += length + 500
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def _records(self, data: _Bytes | _Members) -> Iterator[tuple[dict, int]]:
        wanted = self.wanted.items()
        while (head := data.head()) is not None:
            row, length, http = parse_head(head)
            if any(row.get(c) not in values for c, values in wanted):
                data.skip(length + 4)
                continue
            if self.payload and row.get("record_type") in ("response", "resource"):
                block = data.take(length)
                row["payload"] = block.partition(b"\r\n\r\n")[2] if http else block
                data.skip(4)
                yield row, length
            else:
                data.skip(length + 4)
                yield row, 0


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false", int(self.options.get("groupBytes", 64 << 20)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("maxFileBytes", 256 << 20)), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


#: Smaller payloads are always written out.
LEAST_REVISIT = 100


def records(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as WARC records. Of equal payloads of at least ``LEAST_REVISIT`` bytes the
    page with the smallest id is the response, the others revisit it; rows that repeat
    that page are responses too. Null ids come last; where all are null, all are
    responses."""
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    page = pages.select(F.col(id).alias("__id"), F.col(url).cast("string").alias("target_uri"), body.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    first = page.filter(F.col("payload_bytes") >= LEAST_REVISIT).groupBy(F.col("payload_digest").alias("__digest")).agg(F.min("__id").alias("__first"))
    j = page.join(first, F.col("payload_digest") == F.col("__digest"), "left")
    revisit = F.col("__first").isNotNull() & ~F.col("__id").eqNullSafe(F.col("__first"))
    urn = lambda c: F.concat(F.lit("urn:page:"), c.cast("string"))
    return j.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn(F.col("__id")).alias("record_id"),
        F.col("__id").cast("string").alias("page_id"), "target_uri", F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
        F.when(revisit, urn(F.col("__first"))).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))


def write(pages: DataFrame, path: str, **names: str) -> None:
    """Write the pages' archives into the folder ``path``."""
    register(pages.sparkSession)
    records(pages, **names).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
