"""WARC archives as a data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading. Files become partitions of about ``partition_bytes``. Of each record only the headers
are decoded at first; filters on the header columns, the record type above all, are pushed down
and decided there. The payload of a record that is not wanted, or of any record under the
option ``payload=false``, is not decoded: compressed records written here carry their length
in the gzip header (the ``sl`` field of the WARC format), plain ones in ``Content-Length``, and
the reader goes straight to the next one. Compressed records without that field are inflated
piece by piece and dropped.

Writing. Each task writes its own files, a new one after ``file_bytes``, every record a gzip
member of its own. Only when all tasks are done a list of their files is written, and readers
go by that list, so files of failed or repeated attempts are never read.

Archives of others. A block whose ``Content-Type`` is ``application/http`` is an HTTP message:
its header is no part of the payload, nor of ``payload_length`` unless the record tells that
itself; chunked or compressed bodies stay as they are. Where ``Content-Length`` is no number
the length and the payload are null, and reading goes on at the next gzip member, or in a
plain file at the next line that opens a record.

Paths go through ``pyarrow.fs``, so any store that it reaches will do; nothing is read or
written beside the path. Line breaks in header values are percent-encoded, null values are left out
and read as null. An empty table gives an archive without records.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import IO, Any
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from tributary.llm.tables import pick, stored

#: Header of each column that has one.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
}
SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_length bigint, payload binary"
)
_NAMES = [*HEADERS, "payload"]
_MANIFEST = "_files.json"
_BRACKETED = ("record_id", "refers_to")
_END = b"\r\n\r\n"


# What is written of a payload, and why a revisit holds none.
CONTENT_TYPE = "text/html; charset=utf-8"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Media type of blocks that hold an HTTP message; their payload is its body.
_HTTP = "application/http"
#: Most bytes of a block that are searched for the end of an HTTP header.
_HTTP_HEAD = 1 << 20


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def encode(record: dict[str, Any], date: str) -> bytes:
    """Headers and payload of one record."""
    payload = record["payload"] or b""
    lines = ["WARC/1.1", f"WARC-Date: {date}"]
    for name, header in HEADERS.items():
        value = record[name]
        if value is not None:
            value = str(value).replace("\r", "%0D").replace("\n", "%0A")
            lines.append(f"{header}: <{value}>" if name in _BRACKETED else f"{header}: {value}")
    if record["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    else:
        lines.append(f"Content-Type: {CONTENT_TYPE}")
    lines.append(f"Content-Length: {len(payload)}")
    return b"".join(["\r\n".join(lines).encode(), _END, payload, _END])


def gzip_member(data: bytes, level: int) -> bytes:
    """A gzip member that states its own length, if that fits the field."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    whole = 10 + 14 + len(body) + len(tail)
    if whole >= 1 << 32 or len(data) >= 1 << 32:
        return struct.pack("<BBBBIBB", 31, 139, 8, 0, 0, 0, 255) + body + tail
    head = struct.pack("<BBBBIBB", 31, 139, 8, 4, 0, 0, 255)
    return head + struct.pack("<H2sHII", 12, b"sl", 8, whole, len(data)) + body + tail


def decode(head: bytes) -> dict[str, Any]:
    """Columns of the headers, the length of the block as ``content``, None if the header
    does not tell it, and whether the block is an HTTP message as ``http``."""
    found: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    out: dict[str, Any] = {name: found.get(header.lower()) for name, header in HEADERS.items()}
    for name in _BRACKETED:
        value = out[name]
        if value and value[0] == "<" and value[-1] == ">":
            out[name] = value[1:-1]
    out["content"] = _number(found.get("content-length", "0"))
    out["http"] = found.get("content-type", "").lower().startswith(_HTTP)
    told = _number(out["payload_length"] or "")
    out["payload_length"] = out["content"] if told is None else told
    # Who told the payload's length did not count an HTTP header.
    out["told"] = told is not None
    return out


def _number(text: str) -> int | None:
    return int(text) if text.isascii() and text.isdigit() else None


def _past_http(row: dict[str, Any], read: Callable[[int], bytes]) -> int:
    """Length of the HTTP header at the start of a block, which is no part of the payload;
    ``read(n)`` gives the first n bytes of the block or all there are."""
    if not row["http"] or row["content"] is None:
        return 0
    most = min(row["content"], _HTTP_HEAD)
    asked = min(4096, most)
    while (end := (head := read(asked)).find(_END)) < 0 and asked < most and len(head) >= asked:
        asked = min(2 * asked, most)
    skip = end + len(_END) if end >= 0 else 0
    if not row["told"]:
        row["payload_length"] = row["content"] - skip
    return skip


def accepts(filters: list[Filter], row: dict[str, Any]) -> bool:
    return all(_holds(f, row) is True for f in filters)


def _holds(f: Filter, row: dict[str, Any]) -> bool | None:
    """What the filter says, None for unknown."""
    if isinstance(f, Not):
        inner = _holds(f.child, row)
        return None if inner is None else not inner
    value = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None or getattr(f, "value", 0) is None:
        return None
    if isinstance(f, In):
        return True if value in f.value else None if None in f.value else False
    return _COMPARE[type(f)](value, f.value)


_COMPARE = {
    EqualTo: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    StringStartsWith: lambda a, b: a.startswith(b),
    StringEndsWith: lambda a, b: a.endswith(b),
    StringContains: lambda a, b: b in a,
}
_KNOWN = (*_COMPARE, IsNull, IsNotNull, EqualNullSafe, In)


def _can_push(f: Filter) -> bool:
    if isinstance(f, Not):
        return _can_push(f.child)
    return isinstance(f, _KNOWN) and len(f.attribute) == 1 and f.attribute[0] in HEADERS


class _Member:
    """One gzip member of a file, inflated only as far as asked."""

    def __init__(self, file: IO[bytes], start: int) -> None:
        self.file, self.start = file, start
        file.seek(start)
        fixed = file.read(10)
        self.exists = len(fixed) == 10
        if not self.exists:
            return
        if fixed[:3] != b"\x1f\x8b\x08" or fixed[3] & ~4:
            raise ValueError(f"no gzip member of a record at byte {start}")
        self.length: int | None = None
        self.at = start + 10
        if fixed[3] & 4:
            (size,) = struct.unpack("<H", file.read(2))
            extra = file.read(size)
            self.at += 2 + size
            while len(extra) >= 4:
                kind, n = struct.unpack_from("<2sH", extra)
                if kind == b"sl" and n == 8:
                    (self.length,) = struct.unpack_from("<I", extra, 4)
                extra = extra[4 + n :]
        self.inflate = zlib.decompressobj(-15)

    def read(self, chunk: int) -> bytes:
        """The next inflated bytes, empty at the end."""
        out = b""
        while not out and not self.inflate.eof:
            self.file.seek(self.at)
            raw = self.file.read(chunk)
            if not raw:
                raise ValueError(f"the record at byte {self.start} is cut off")
            self.at += len(raw)
            out = self.inflate.decompress(raw)
        return out

    def end(self) -> int:
        if self.length is not None:
            return self.start + self.length
        while self.read(1 << 16):
            pass
        return self.at - len(self.inflate.unused_data) + 8


def _gzip_records(
    file: IO[bytes], filters: list[Filter], payload: bool
) -> Iterator[dict[str, Any]]:
    start = 0
    while (member := _Member(file, start)).exists:
        data = b""
        while _END not in data and (more := member.read(2048)):
            data += more
        head, _, body = data.partition(_END)
        row = decode(head)
        parts = [body]

        def first(n: int, member=member, parts=parts) -> bytes:
            while sum(map(len, parts)) < n and (more := member.read(1 << 16)):
                parts.append(more)
            return b"".join(parts)[:n]

        skip = _past_http(row, first)
        if accepts(filters, row):
            # A record of unknown length has no payload; the member tells where it ends.
            if payload and row["content"] is not None:
                size = sum(map(len, parts))
                while size < row["content"] and (more := member.read(1 << 16)):
                    parts.append(more)
                    size += len(more)
                row["payload"] = b"".join(parts)[skip : row["content"]]
            yield row
        start = member.end()


def _plain_records(
    file: IO[bytes], filters: list[Filter], payload: bool
) -> Iterator[dict[str, Any]]:
    start = 0
    while True:
        file.seek(start)
        data = b""
        while _END not in data and (more := file.read(2048)):
            data += more
        if not data.strip():
            return
        head, _, _ = data.partition(_END)
        row = decode(head)
        begin = start + len(head) + len(_END)

        def first(n: int, begin=begin) -> bytes:
            file.seek(begin)
            return file.read(n)

        skip = _past_http(row, first)
        if accepts(filters, row):
            if payload and row["content"] is not None:
                file.seek(begin + skip)
                row["payload"] = file.read(row["content"] - skip)
            yield row
        if row["content"] is None:
            start = _next_record(file, begin)
        else:
            start = begin + row["content"] + len(_END)


def _next_record(file: IO[bytes], start: int) -> int:
    """Where the next line begins that opens a record, after one of unknown length."""
    file.seek(start)
    kept = b""
    while more := file.read(1 << 16):
        data = kept + more
        at = data.find(b"\nWARC/")
        if at >= 0:
            return start + at + 1
        kept = data[-5:]
        start += len(data) - len(kept)
    return start + len(kept)


@dataclass
class _Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if _can_push(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        files, place = filesystem(self.path)
        manifest = f"{place}/{_MANIFEST}"
        if files.get_file_info(manifest).type == pafs.FileType.File:
            with files.open_input_stream(manifest) as file:
                found = [(f"{place}/{name}", size) for name, size in json.loads(file.read())]
        elif files.get_file_info(place).type == pafs.FileType.File:
            found = [(place, 0)]
        else:
            listed = files.get_file_info(pafs.FileSelector(place))
            found = sorted(
                (x.path, x.size) for x in listed if x.path.endswith((".warc", ".warc.gz"))
            )
        out: list[InputPartition] = []
        room = 0
        for path, size in found:
            if not out or size > room:
                out.append(_Files([]))
                room = self.partition_bytes
            out[-1].paths.append(path)
            room -= size
        return out

    def read(self, partition: _Files) -> Iterator[tuple]:
        files, _ = filesystem(self.path)
        for path in partition.paths if partition else []:
            records = _gzip_records if path.endswith(".gz") else _plain_records
            with files.open_input_file(path) as file:
                for row in records(file, self.filters, self.payload):
                    yield tuple(row.get(name) for name in _NAMES)


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path = options["path"]
        self.overwrite = overwrite
        self.file_bytes = int(options.get("file_bytes", 32 << 20))
        self.level = int(options.get("level", 3))
        self.date = options.get("date", "2000-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, place = filesystem(self.path)
        files.create_dir(place, recursive=True)
        task = f"part-{TaskContext.get().partitionId():05d}-{uuid4().hex}"
        done: list[tuple[str, int]] = []
        out, size = None, 0
        for batch in iterator:
            columns = [batch.column(name) for name in _NAMES]
            for i in range(batch.num_rows):
                record = {n: c[i].as_py() for n, c in zip(_NAMES, columns, strict=True)}
                if out is None:
                    name, size = f"{task}-{len(done)}.warc.gz", 0
                    out = files.open_output_stream(f"{place}/{name}", compression=None)
                data = gzip_member(encode(record, self.date), self.level)
                out.write(data)
                size += len(data)
                if size >= self.file_bytes:
                    out.close()
                    done.append((name, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size))
        return _Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, place = filesystem(self.path)
        files.create_dir(place, recursive=True)
        manifest = f"{place}/{_MANIFEST}"
        old = []
        if not self.overwrite and files.get_file_info(manifest).type == pafs.FileType.File:
            with files.open_input_stream(manifest) as file:
                old = json.loads(file.read())
        new = sorted(tuple(f) for m in messages if m is not None for f in m.files)
        with files.open_output_stream(manifest, compression=None) as file:
            file.write(json.dumps([*old, *new]).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, place = filesystem(self.path)
        for message in messages:
            for name, _ in message.files if message is not None else []:
                files.delete_file(f"{place}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, with filters pushed down to Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


#: Payloads below this are always written out.
LEAST_SHARED = 100


def page_records(pages: DataFrame) -> DataFrame:
    """Pages as records; of equal payloads that of the smallest page is stored, the others
    revisit it.

    A null html is an empty payload. Rows without a page id revisit a page that has one, and
    are all responses if none has; rows that repeat the response's id and payload are
    responses too.

    Digests that repeat are written to a table first. While that is below Spark's limit for
    broadcasts, payloads stay where they were read; beyond, they are joined by a shuffle.
    """
    rows = pick(pages, page_id="bigint", url="string", html="string").select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256))).withColumn(
        "length", F.octet_length("payload").cast("bigint")
    )
    shared = (
        rows.where(F.col("length") >= LEAST_SHARED)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    rows = rows.join(stored(shared, "shared"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda column: F.concat(F.lit("urn:page:"), F.col(column).cast("string"))
    return rows.select(
        urn("page_id").alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(again, urn("first")).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.lower(F.hex("digest"))).alias("payload_digest"),
        F.col("length").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.select(*_NAMES).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
