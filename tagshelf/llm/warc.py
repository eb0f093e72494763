"""WARC archives as a Spark data source.

`df.write.format("warc")` writes one record per row, `spark.read.format("warc")` reads them back. A writing
task fills files of its own and names them in its commit message; only the commit lists them in a manifest, so
that files of lost or repeated attempts are never read. Reading plans one partition per file. Filters
on the record type and on other header columns are taken into the source: a record's headers are parsed first,
and where it is not wanted, or its payload is not, the reader goes on to the next record at once. In
compressed archives every record is a gzip member that states its own length, so that this needs no inflating.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan,
    GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringContains,
    StringEndsWith, StringStartsWith, WriterCommitMessage,
)

from tagshelf.llm.rows import write_step

READ_SCHEMA = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string,"
    " refers_to bigint, payload binary"
)
ARROW_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])
HEADER_COLUMNS = [n for n in ARROW_SCHEMA.names if n != "payload"]
MANIFEST = "_committed-"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_HEAD = struct.Struct("<4sIBBH2sHII")  # magic, time, flags, system, extra length, field id, its length, two sizes
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
# Names that Spark's own readers use for what Arrow calls otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(path: str) -> str:
    """A path or URI as Arrow names it."""
    scheme, mark, rest = path.partition("://")
    return f"{SCHEMES.get(scheme.lower(), scheme)}{mark}{rest}" if mark else path


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    try:
        return pafs.FileSystem.from_uri(arrow_uri(path))
    except (pa.ArrowException, OSError) as e:
        raise ValueError(f"archives cannot be opened at {path}: Arrow has no file system for it here ({e})") from e


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records --------------------------------------------------------------------------------------


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or a revisit, which has the headers of the response but no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m.group()):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 4) -> bytes:
    """A gzip member whose extra field `sl` states its compressed and its uncompressed length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = GZIP_HEAD.size + len(body) + 8
    head = GZIP_HEAD.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, size, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:] if x)}


def _page(reference: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", reference or "")
    return int(found[1]) if found else None


def header_row(warc: dict[str, str], http: dict[str, str], http_size: int) -> dict:
    """The columns that headers give. Without an HTTP length, the block behind its headers is the payload."""
    stated = http.get("content-length")
    url = warc.get("warc-target-uri")
    return {
        "page_id": _page(warc.get("warc-record-id")),
        "url": url and re.sub("%([01][0-9A-F]|25|7F)", lambda m: chr(int(m[1], 16)), url),
        "record_type": warc.get("warc-type"),
        "payload_bytes": int(stated) if stated and stated.isdigit() else int(warc.get("content-length", 0)) - http_size,
        "payload_digest": (warc.get("warc-payload-digest") or "").rpartition(":")[2] or None,
        "refers_to": _page(warc.get("warc-refers-to")),
    }


class _Member:
    """Bytes of one record, fetched and inflated as far as they are asked for."""

    def __init__(self, file, at: int, size: int | None, packed: bool):
        self.file, self.at, self.left, self.packed = file, at, size, packed
        self.data = b""
        self.unpacker = zlib.decompressobj(31) if packed else None

    def more(self, least: int) -> bool:
        """Try to have `least` bytes."""
        while len(self.data) < least:
            if self.unpacker is not None and self.unpacker.eof:
                return False
            step = max(1 << 14, least - len(self.data))
            if self.left is not None:
                step = min(step, self.left)
            chunk = self.file.read_at(step, self.at) if step else b""
            if not chunk:
                return False
            self.at += len(chunk)
            if self.left is not None:
                self.left -= len(chunk)
            self.data += self.unpacker.decompress(chunk) if self.unpacker is not None else chunk
        return True

    def head_end(self, start: int) -> int:
        """Where the headers that begin at `start` end, their empty line included; -1 without an end."""
        look = start
        while (at := self.data.find(b"\r\n\r\n", max(look - 3, start))) < 0:
            look = len(self.data)
            if not self.more(look + 1):
                return -1
        return at + 4

    def finish(self) -> int:
        """The place in the file behind this member; for members that do not state their length."""
        while not self.unpacker.eof:
            chunk = self.file.read_at(1 << 16, self.at)
            if not chunk:
                break
            self.at += len(chunk)
            self.unpacker.decompress(chunk)
        return self.at - len(self.unpacker.unused_data)


def read_records(file, size: int, wanted: Callable[[dict], bool], with_payload: bool, verify: bool = False) -> Iterator[dict]:
    """Rows of the wanted response and revisit records of an archive, a random access file of `size` bytes. With `verify` a
    payload that is read must have the SHA-1 digest of its header, if that has one."""
    at = 0
    while at < size:
        head = file.read_at(GZIP_HEAD.size, at)
        packed = head[:2] == b"\x1f\x8b"
        length = None
        if packed and len(head) == GZIP_HEAD.size:
            fields = GZIP_HEAD.unpack(head)
            if fields[0][3] & 4 and fields[5] == b"sl" and fields[6] == 8:
                length = fields[7]
        member = _Member(file, at, length, packed)
        end = member.head_end(0)
        if end < 0:
            raise ValueError(f"no record at {at}")
        warc = parse_headers(member.data[:end])
        block = int(warc.get("content-length", 0))
        if warc.get("warc-type") in ("response", "revisit"):
            is_http = warc.get("content-type", "").startswith("application/http")
            http_end = member.head_end(end) if is_http else end
            http = parse_headers(member.data[end:http_end]) if http_end > end else {}
            row = header_row(warc, http, http_end - end)
            if wanted(row):
                row["payload"] = None
                if with_payload and row["record_type"] == "response":
                    member.more(end + block)
                    row["payload"] = member.data[http_end : end + block]
                    if verify and row["payload_digest"] not in (None, digest(row["payload"])):
                        raise ValueError(f"the payload of page {row['page_id']} is not the one of its digest")
                yield row
        if length is not None:
            at += length
        elif packed:
            at = member.finish()
        else:
            at += end + block + 4


# --- the data source ------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


@dataclass
class ArchivePart(InputPartition):
    file: str


class WarcWriter(DataSourceArrowWriter):
    """Rows of page_id, url, payload and refers_to (null: a response) to archives of at most about roll_bytes."""

    def __init__(self, options: dict, schema):
        self.path = options["path"]
        open_folder(self.path)  # a path that cannot be opened fails while the write is planned, before any task
        self.roll = int(options.get("roll_bytes", 64 << 20))
        self.packed = options.get("compression", "gzip") == "gzip"
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        missing = {"page_id", "url", "payload", "refers_to"} - set(schema.names)
        if missing:
            raise ValueError(f"a WARC record needs the columns {sorted(missing)}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        filesystem, folder = open_folder(self.path)
        filesystem.create_dir(folder, recursive=True)
        files: list[str] = []
        out, used = None, 0
        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in ("page_id", "url", "payload", "refers_to")]
            for page_id, url, payload, refers_to in zip(*columns, strict=True):
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.packed
                    out, used = filesystem.open_output_stream(f"{folder}/{name}", compression=None), 0
                    files.append(name)
                raw = payload.as_py()
                raw = raw.encode() if isinstance(raw, str) else raw or b""
                record = record_bytes(page_id.as_py(), url.as_py(), raw, refers_to.as_py(), self.date)
                record = gzip_member(record) if self.packed else record
                out.write(record)
                used += len(record)
                if used >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        filesystem, folder = open_folder(self.path)
        filesystem.create_dir(folder, recursive=True)
        files = [f for m in messages if m for f in m.files]
        with filesystem.open_output_stream(f"{folder}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        filesystem, folder = open_folder(self.path)
        for m in messages:
            for f in m.files if m else []:
                filesystem.delete_file(f"{folder}/{f}")


def predicate(f: Filter) -> tuple[str, Callable] | None:
    """The column and test of a filter that headers can answer; None for any other."""
    column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if column not in HEADER_COLUMNS:
        return None
    value = getattr(f, "value", None)
    known = {
        EqualTo: lambda x: x is not None and x == value, EqualNullSafe: lambda x: x == value,
        In: lambda x: x is not None and x in value, IsNull: lambda x: x is None, IsNotNull: lambda x: x is not None,
        GreaterThan: lambda x: x is not None and x > value, GreaterThanOrEqual: lambda x: x is not None and x >= value,
        LessThan: lambda x: x is not None and x < value, LessThanOrEqual: lambda x: x is not None and x <= value,
        StringStartsWith: lambda x: x is not None and x.startswith(value),
        StringEndsWith: lambda x: x is not None and x.endswith(value),
        StringContains: lambda x: x is not None and value in x,
    }
    return (column, known[type(f)]) if type(f) in known else None


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.with_payload = str(options.get("payload", "true")).lower() == "true"
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if predicate(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[ArchivePart]:
        """A part per archive: those that manifests list, or all in a folder that has none."""
        filesystem, folder = open_folder(self.path)
        infos = filesystem.get_file_info(pafs.FileSelector(folder))
        manifests = [i.path for i in infos if i.base_name.startswith(MANIFEST)]
        if manifests:
            files = [f for m in manifests for f in json.loads(filesystem.open_input_file(m).read())]
        else:
            files = [i.base_name for i in infos if re.search(r"\.warc(\.gz)?$", i.base_name)]
        return [ArchivePart(f) for f in sorted(files)]

    def read(self, partition: ArchivePart) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, ArchivePart):
            return  # an archive folder without archives
        filesystem, folder = open_folder(self.path)
        tests = [predicate(f) for f in self.filters]
        wanted = lambda row: all(test(row[column]) for column, test in tests)
        with filesystem.open_input_file(f"{folder}/{partition.file}") as file:
            rows, used = [], 0
            for row in read_records(file, file.size(), wanted, self.with_payload, self.verify):
                rows.append(row)
                used += 200 + len(row["payload"] or b"")
                if used > 16 << 20:
                    yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)
                    rows, used = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)


class WarcSource(DataSource):
    """Options: path; reading: payload (true), which false leaves null, verify (false), which checks payloads by their digests; writing: compression (gzip, none),
    roll_bytes, date."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to: write to a new folder")
        return WarcWriter(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set(PUSHDOWN, "true")


# --- pages to archives ----------------------------------------------------------------------------


def with_references(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0
) -> DataFrame:
    """page_id, url, payload and refers_to of each page: null, or the smallest id whose payload is equal.

    Payloads are compared by digest. Of pages with equal payloads of at least `min_bytes`, those with the
    smallest id refer to nothing; smaller payloads never refer. A null page is empty. A page without an id
    refers to a page with one where there is an equal one. Pages that repeat an id and a payload get the same.

    The pages of a payload are counted with combining before the shuffle; only ids and digests are joined by
    payload, and pages by id, so that no payload that many pages share gathers them in one task.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    keyed = rows.select("page_id", F.unhex(F.sha1("payload")).alias("sha")).filter(F.octet_length("payload") >= min_bytes)
    first = write_step(
        keyed.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first").isNotNull()).select("sha", "first"),
        "repeated-payloads",
    )
    revisits = keyed.join(first, "sha").filter(~F.col("page_id").eqNullSafe(F.col("first"))).select(
        F.col("page_id").alias("id"), F.col("sha").alias("by"), F.col("first").alias("refers_to")
    ).distinct()
    with_sha = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    return with_sha.join(
        revisits, with_sha["page_id"].eqNullSafe(revisits["id"]) & (with_sha["sha"] == revisits["by"]), "left"
    ).select("page_id", "url", "payload", "refers_to")


def write_archives(pages: DataFrame, path: str, **options) -> None:
    """Write pages (page_id, url, html) as archives into the folder `path`, which every executor reaches.

    A null html is an empty payload, a null url is left out, rows that repeat get a record each, an empty table writes no
    record, and other columns are dropped. Records of one payload refer to that of the smallest page_id.
    """
    register(pages.sparkSession)
    with_references(pages).write.format("warc").mode("append").options(path=path, **options).save()


def read_archives(spark: SparkSession, path: str, payload: bool = True, verify: bool = False) -> DataFrame:
    """The records of the archives in a folder. `payload` false leaves payloads undecoded and null; `verify` fails on a
    payload that is not the one of its record's digest."""
    register(spark)
    options = {"path": path, "payload": str(payload).lower(), "verify": str(verify).lower()}
    return spark.read.format("warc").options(**options).load()
