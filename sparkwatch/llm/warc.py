"""WARC archives: a writer with revisit records and a splittable reader.

The writer makes one gzip member of each record, as the format asks for. Members are written by
Spark's text writer, so files appear only when their task is committed, wherever Spark
can write. That writer ends every row with a separator; it is set to the zero byte with which
each member ends (the upper byte of its length), and the member is handed over without it.

The reader is a data source. Its tasks get byte ranges of archives. A task looks for the gzip magic
in its range, takes each place as a candidate, and keeps those where a member can be opened and
begins with the header of a WARC record. A record belongs to the task in whose range
its member starts, and is read to its end even if that lies beyond the range. So one large
archive is read by many tasks, and no record is read twice or left out.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sparkwatch.llm.text import bounded_batches
from sparkwatch.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
_READ = 1 << 20
#: Bytes of an archive that one task scans.
SPLIT_BYTES = 16 << 20
SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
    "payload_length long, payload binary, file string, offset long"
)


def digest(payload: bytes) -> str:
    """SHA-1 in base 32, as WARC headers show it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes) -> bytes:
    """One gzip member, always ending with a zero byte."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    return out if out[-1] == 0 else out + member(b"")


def _uri(text: str) -> str:
    """A header value on one line."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(
    record_id: str,
    payload: bytes,
    length: int,
    payload_digest: str,
    target: str | None,
    refers_to: str | None = None,
) -> bytes:
    """A response record, or a revisit of ``refers_to`` without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"Content-Length: {len(block)}",
    ]
    if target is not None:
        head.append(f"WARC-Target-URI: {_uri(target)}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict | None:
    """The fields of a record, or None where the bytes are not one."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/"):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    try:
        block = rest[: int(fields["content-length"])]
    except (KeyError, ValueError):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    length = None
    for line in http.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            length = int(value)
    bare = lambda name: fields[name].strip("<>") if name in fields else None
    kind = fields.get("warc-type")
    return {
        "record_id": bare("warc-record-id"),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": bare("warc-refers-to"),
        "payload_digest": (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
        "payload_length": length,
        "payload": payload if kind != "revisit" else None,
    }


def members(file, start: int, end: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Offset and contents of the members that start in [start, end) and hold a WARC record.

    ``file`` has seek and read. After a member the search goes on at its end, so a magic inside
    of its data is not even tried.
    """
    at, window, base = start, b"", start
    while at < end:
        if not base <= at < base + len(window) - 2:
            file.seek(at)
            window, base = file.read(min(_READ, size - at)), at
            if len(window) < 3:
                return
        place = window.find(MAGIC, at - base)
        if place < 0:
            at = base + len(window) - 2
            continue
        at = base + place
        if at >= end:
            return
        data, used = _opened(file, at, size)
        if data is None:
            at += 1
        else:
            if data.startswith(b"WARC/"):
                yield at, data
            at += used


def _opened(file, at: int, size: int) -> tuple[bytes | None, int]:
    """The member at ``at`` and its length in the file, or None if there is none."""
    engine, parts, read, first = zlib.decompressobj(31), [], 0, True
    file.seek(at)
    try:
        while not engine.eof and at + read < size:
            chunk = file.read(min(_READ if not first else 1 << 14, size - at - read))
            if not chunk:
                break
            read += len(chunk)
            parts.append(engine.decompress(chunk))
            head = parts[0]
            # A long member is given up at once if it does not begin as a record does.
            if first and head and not b"WARC/".startswith(head[:5]) and not head.startswith(b"WARC/"):
                return None, 0
            first = False
    except zlib.error:
        return None, 0
    return (b"".join(parts), read - len(engine.unused_data)) if engine.eof else (None, 0)


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, size: int):
        self.path, self.start, self.end, self.size = path, start, end, size


def _opened_system(path: str):
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pa.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith(("s3a://", "s3n://")):
        path = "s3://" + path.split("://", 1)[1]
    return pa.fs.FileSystem.from_uri(path)


class WarcReader(DataSourceReader):
    """Byte ranges of all archives below the path."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[_Range]:
        system, inner = _opened_system(self.path)
        found = system.get_file_info(inner)
        if found.type == pa.fs.FileType.Directory:
            infos = system.get_file_info(pa.fs.FileSelector(inner, recursive=True))
        elif found.type == pa.fs.FileType.File:
            infos = [found]
        else:
            raise FileNotFoundError(self.path)
        out = []
        for info in sorted(infos, key=lambda i: i.path):
            if info.is_file and info.size and not info.base_name.startswith(("_", ".")):
                for start in range(0, info.size, self.split):
                    out.append(_Range(info.path, start, min(start + self.split, info.size), info.size))
        return out or [_Range("", 0, 0, 0)]

    def read(self, part: _Range) -> Iterator[tuple]:
        if part.start >= part.end:
            return
        system, _ = _opened_system(self.path)
        with system.open_input_file(part.path) as file:
            for at, data in members(file, part.start, part.end, part.size):
                fields = parsed(data)
                if fields is not None:
                    yield (*fields.values(), part.path, at)


class Warc(DataSource):
    """``spark.read.format("warc").load(path)``; the option ``splitBytes`` sizes the ranges."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of all archives below ``path``; a damaged member gives no row."""
    spark.dataSource.register(Warc)
    return spark.read.format("warc").option("splitBytes", split_bytes).load(path)


def _packed(batches):
    """Digest, length and a finished response member of each page."""
    for batch in batches:
        ids, urls, pages = (c.to_pylist() for c in batch.columns)
        sums = [digest(p or b"") for p in pages]
        out = [
            member(record(f"urn:page:{i}", p or b"", len(p or b""), d, u))
            for i, u, p, d in zip(ids, urls, pages, sums, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(sums), pa.array([len(p or b"") for p in pages], pa.int64()),
                pa.array([o[:-1] for o in out], pa.binary()),
            ],
            names=["page_id", "url", "digest", "size", "member"],
        )


def _lines(batches):
    """The members to write: the response as it is, or a revisit in its place."""
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        out = []
        for page_id, url, sha, size, done, first in rows:
            if first is not None and page_id is not None and first != page_id:
                done = member(record(f"urn:page:{page_id}", b"", size, sha, url, f"urn:page:{first}"))[:-1]
            out.append(done)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the smallest page_id
    is a response and the others revisit it. A null html is an empty payload, a null url gives no
    target. Pages without page_id are always responses; rows that repeat a page_id and its
    payload are responses if that page is. Other columns are not read.

    Pages are compressed before they are shuffled, and what is looked up for each payload is one
    row, aggregated before the shuffle. So a payload that a third of the pages share is no
    hot group there, and on the join's other side Spark splits it.
    """
    wanted = bounded_batches(pages).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").cast("binary").alias("html"),
    )
    rows = wanted.mapInArrow(_packed, "page_id long, url string, digest string, size long, member binary")
    firsts = (
        wanted.where(F.col("page_id").isNotNull())
        .select("page_id", F.coalesce("html", F.lit(b"")).alias("html"))
        .where(F.octet_length("html") >= least_bytes)
        .groupBy(F.sha1("html").alias("hex"))
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .where("first < last")
        .mapInArrow(_named, "digest string, first long")
    )
    joined = rows.join(firsts, "digest", "left")
    lines = joined.select("page_id", "url", "digest", "size", "member", "first").mapInArrow(_lines, "value binary")
    lines.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


def _named(batches):
    for batch in batches:
        names = [base64.b32encode(bytes.fromhex(h)).decode() for h in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column(1)], names=["digest", "first"])


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read the records back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, path, least_bytes)
    return read_warc(pages.sparkSession, path)
