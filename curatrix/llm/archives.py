"""WARC records in ZIP-packaged archives, written once and read by ranges.

A package is a ZIP file whose members are stored, not compressed: the archive
(``archive/data.warc.gz``, one gzip member per record) and its index
(``indexes/index.cdxj``, a JSON line per record with offset and length).  The
reader parses the end record, the ZIP64 records where they are, and the
central directory, and then fetches single records by range; nothing is
extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import child_uri, open_store

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
LEAST_BYTES = 1000
#: A package is closed and the next begun beyond this many bytes of records.
PACKAGE_BYTES = 1 << 29

# Fixed values of the ZIP format.
END, END64, LOCATOR64, CENTRAL, LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class StoredZip:
    """Places of a ZIP file's members, read from a random-access source.

    Damaged directories, and reads of compressed members, raise ``ValueError``.
    """

    def __init__(self, source):
        self.source, self.size = source, source.size()
        tail_at = max(0, self.size - FULL16 - 22)
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(struct.pack("<I", END))
        if at < 0 or len(tail) - at < 22:
            raise ValueError("no end-of-directory record")
        count, length, start = struct.unpack_from("<HII", tail, at + 10)
        locator = tail_at + at - 20
        if locator >= 0:
            magic, _, place, _ = struct.unpack("<IIQI", self.read(locator, 20))
            if magic == LOCATOR64:
                record = self.read(place, 56)
                if struct.unpack_from("<I", record)[0] != END64:
                    raise ValueError("the ZIP64 end record is not where its locator says")
                count, length, start = struct.unpack_from("<QQQ", record, 32)
        self.members = dict(self._central(self.read(start, length), count))

    def read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _central(self, raw: bytes, count: int) -> Iterator[tuple[str, tuple[int, int, int]]]:
        at = 0
        for _ in range(count):
            if struct.unpack_from("<I", raw, at)[0] != CENTRAL:
                raise ValueError("the central directory is damaged")
            method = struct.unpack_from("<H", raw, at + 10)[0]
            packed, full, names, extras, comments = struct.unpack_from("<IIHHH", raw, at + 20)
            place = struct.unpack_from("<I", raw, at + 42)[0]
            name = raw[at + 46 : at + 46 + names].decode()
            wide, x, end = [], at + 46 + names, at + 46 + names + extras
            while x + 4 <= end:
                kind, n = struct.unpack_from("<HH", raw, x)
                if kind == 1:
                    wide = list(struct.unpack_from(f"<{n // 8}Q", raw, x + 4))
                x += 4 + n
            full = wide.pop(0) if full == FULL32 else full
            packed = wide.pop(0) if packed == FULL32 else packed
            place = wide.pop(0) if place == FULL32 else place
            yield name, (place, packed, method)
            at = end + comments

    def data(self, name: str) -> tuple[int, int]:
        """``(offset, length)`` of a stored member's bytes in the file."""
        place, length, method = self.members[name]
        if method:
            raise ValueError(f"{name} is compressed")
        head = self.read(place, 30)
        if struct.unpack_from("<I", head)[0] != LOCAL:
            raise ValueError("a local header is damaged")
        names, extras = struct.unpack_from("<HH", head, 26)
        return place + 30 + names + extras, length


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(record: str | None) -> int | None:
    tail = record.rstrip(">").rpartition(":")[2] if record else "none"
    return None if tail == "none" else int(tail)


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the HTTP headers but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    heads = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        heads.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        heads += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    heads += ["Content-Type: application/http;msgtype=response", "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(), f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(heads).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; a payload that does not fit its digest raises ``ValueError``."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = {k.lower(): v for k, v in (line.split(": ", 1) for line in http.decode().split("\r\n")[1:])}
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("a payload does not fit its digest")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": int(said["content-length"]), "payload_digest": digest,
        "record_type": kind, "refers_to": page_of(fields.get("WARC-Refers-To")), "payload": payload if kind == "response" else None,
    }


class PackageWriter:
    """Streams records into one package."""

    def __init__(self, stream):
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.index: list[bytes] = []
        self.size = 0

    def add(self, page_id: int | None, record: bytes) -> None:
        packed = gzip.compress(record, 1, mtime=0)
        self.member.write(packed)
        self.index.append(json.dumps({"page": page_id, "offset": self.size, "length": len(packed)}).encode())
        self.size += len(packed)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), b"\n".join(self.index))
        self.zip.close()


def read_package(source) -> Iterator[dict]:
    """Every record of a package, each fetched by its range."""
    package = StoredZip(source)
    first, length = package.data(ARCHIVE)
    at, n = package.data(INDEX)
    for line in package.read(at, n).splitlines():
        entry = json.loads(line)
        if entry["offset"] + entry["length"] > length:
            raise ValueError("the index points beyond the archive")
        yield parse_record(zlib.decompress(package.read(first + entry["offset"], entry["length"]), 31))


def with_record_types(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``payload_digest``, ``payload_bytes``, ``refers_to`` and ``revisit`` of every page.

    Of payloads that are equal and have at least ``LEAST_BYTES`` bytes, that
    with the largest id is the response.  Null html is the empty payload; rows
    that repeat the largest id are responses too.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.withColumns({"payload_digest": F.sha1(html), "payload_bytes": F.octet_length(html).cast("long")})
    large = rows.where(F.col("payload_bytes") >= LEAST_BYTES).groupBy(F.col("payload_digest").alias("seen_digest"), F.col("payload_bytes").alias("seen_bytes"))
    large = large.agg(F.max(id_col).alias("seen_id"), F.count("*").alias("seen_count")).where("seen_count > 1 and seen_id is not null")
    joined = rows.join(large, (F.col("payload_digest") == F.col("seen_digest")) & (F.col("payload_bytes") == F.col("seen_bytes")), "left")
    revisit = F.col("seen_id").isNotNull() & F.coalesce(F.col("seen_id") != F.col(id_col), F.lit(True))
    return joined.withColumns({"revisit": revisit, "refers_to": F.when(revisit, F.col("seen_id"))}).drop("seen_digest", "seen_bytes", "seen_id", "seen_count")


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> list[tuple[str, int]]:
    """Write a record per page; returns ``(uri, records)`` of every package.

    Package names are new for each attempt of a task, and only those of
    finished tasks are returned.  An empty table gives no packages; other
    columns of the pages are left alone, whatever their names.
    """
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = with_record_types(plain).select("page_id", "url", "html", "payload_digest", "refers_to", "revisit")
    kind = pa.schema([("uri", pa.string()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = stream = None
        uri, count = "", 0

        def done() -> pa.RecordBatch:
            writer.close()
            stream.close()
            return pa.RecordBatch.from_pydict({"uri": [uri], "records": [count]}, schema=kind)

        for batch in batches:
            for page, url, html, digest, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    uri, count = child_uri(folder, f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.wacz"), 0
                    store, path = open_store(uri)
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    stream = store.open_output_stream(path, compression=None)
                    writer = PackageWriter(stream)
                writer.add(page, make_record(page, url, (html or "").encode(), digest, refers_to, revisit))
                count += 1
                if writer.size >= PACKAGE_BYTES:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    return sorted(map(tuple, rows.mapInArrow(run, "uri string, records bigint").collect()))


def read_packages(spark: SparkSession, uris: list[str]) -> DataFrame:
    """All records of the packages, with their payloads (null for revisits)."""
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = open_store(uri)
                with store.open_input_file(path) as source:
                    held = []
                    for record in read_package(source):
                        held.append(record)
                        if len(held) >= 256:
                            yield pa.RecordBatch.from_pylist(held, schema=kind)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema=kind)

    listed = spark.createDataFrame([(u,) for u in uris], "uri string")
    if len(uris) > 1:
        listed = listed.repartition(len(uris))
    return listed.mapInArrow(run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary")
