"""WARC records in ZIP packages: written by Spark's own file writer, and read by ranges through the ZIP directories.

A package is one ZIP file with stored members: `archive/*.warc.gz`, each record a gzip member of its own;
`indexes/index.cdxj`, a line per record with its archive, offset and length; and `datapackage.json`. The central directory is
followed by the ZIP64 end record and locator. Every piece of a package is a row of Spark's text writer, whose line
end is a byte between members that no directory points to, and the last one is the comment of the package. So files are committed as
any Spark output is, on any store, and a lost executor's are written anew.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import in_python

#: A member of records is closed at this size, a package's member index likewise stays small.
MEMBER_BYTES = 8 << 20
#: Fixed values of the formats: signatures and layouts of ZIP records.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
WARC_DATE = "2026-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False, date: str = WARC_DATE) -> bytes:
    """A response, or a revisit of the response `refers_to`: then the HTTP head alone, with the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {(url or '').replace(chr(13), ' ').replace(chr(10), ' ')}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


class PackageWriter:
    """Pieces of one package in file order; each is followed by one byte that the text writer adds."""

    def __init__(self):
        self.at = 0
        self.directory: list[bytes] = []

    def member(self, name: str, content: bytes) -> bytes:
        encoded, crc, size = name.encode(), zlib.crc32(content), len(content)
        big = struct.pack("<HHQQ", 1, 16, size, size)
        piece = struct.pack("<4sHHHHHIIIHH", LOCAL, 45, 0x800, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(encoded), len(big)) + encoded + big + content
        big = struct.pack("<HHQQQ", 1, 24, size, size, self.at)
        self.directory.append(struct.pack("<4sHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x800, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(encoded), len(big), 0, 0, 0, 0, 0xFFFFFFFF) + encoded + big)
        self.at += len(piece) + 1
        return piece

    def end(self) -> bytes:
        entries, count = b"".join(self.directory), len(self.directory)
        end64 = struct.pack("<4sQHHIIQQQQ", END64, 44, 45, 45, 0, 0, count, count, len(entries), self.at)
        locator = struct.pack("<4sIQI", LOCATOR64, 0, self.at + len(entries), 1)
        return entries + end64 + locator + struct.pack("<4sHHHHIIH", END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 1)


def package(records: Iterator[tuple[str, bytes]]) -> Iterator[bytes]:
    """The pieces of a package of (index key, record)s."""
    writer, index, buffer, number = PackageWriter(), [], bytearray(), 0
    some = False

    def flush() -> bytes:
        nonlocal number
        name = f"archive/data-{number:05d}.warc.gz"
        number += 1
        piece = writer.member(name, bytes(buffer))
        buffer.clear()
        return piece

    for key, content in records:
        some = True
        packed = gzip.compress(content, 4, mtime=0)
        if buffer and len(buffer) + len(packed) > MEMBER_BYTES:
            yield flush()
        index.append(f"{key} " + json.dumps({"filename": f"data-{number:05d}.warc.gz", "offset": len(buffer), "length": len(packed)}))
        buffer += packed
    if not some:
        return
    yield flush()
    yield writer.member("indexes/index.cdxj", ("\n".join(index) + "\n").encode())
    yield writer.member("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1"}).encode())
    yield writer.end()


@dataclass(frozen=True)
class Member:
    name: str
    offset: int
    size: int
    method: int


class Ranges:
    """A file of which ranges are read: bytes in memory, or a path of a store that Arrow can open."""

    def __init__(self, path: str, content: bytes | None = None):
        if content is None:
            from pyarrow import fs

            store, place = fs.FileSystem.from_uri(path)
            self.file = store.open_input_file(place)
            self.size = self.file.size()
        else:
            self.file, self.size = io.BytesIO(content), len(content)

    def read(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return bytes(self.file.read(length))


def members(file: Ranges) -> dict[str, Member]:
    """The members by the central directory, with ZIP64 sizes and offsets, and where their content begins."""
    tail_at = max(0, file.size - 66_000)
    tail = file.read(tail_at, file.size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and struct.unpack_from("<H", tail, at + 20)[0] != len(tail) - at - 22:
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == LOCATOR64:
        end64 = file.read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end record where the locator points")
        count, size, start = struct.unpack_from("<QQQ", end64, 32)
    entries, at, out = file.read(start, size), 0, {}
    for _ in range(count):
        if entries[at : at + 4] != CENTRAL:
            raise ValueError("the ZIP directory is broken")
        method = struct.unpack_from("<H", entries, at + 10)[0]
        packed, full, names, extras, comments = struct.unpack_from("<IIHHH", entries, at + 20)
        offset = struct.unpack_from("<I", entries, at + 42)[0]
        name = entries[at + 46 : at + 46 + names].decode()
        extra, stop = at + 46 + names, at + 46 + names + extras
        while extra + 4 <= stop:
            tag, length = struct.unpack_from("<HH", entries, extra)
            if tag == 1:
                values = list(struct.unpack_from(f"<{length // 8}Q", entries, extra + 4))
                full = values.pop(0) if full == 0xFFFFFFFF else full
                packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                offset = values.pop(0) if offset == 0xFFFFFFFF else offset
            extra += 4 + length
        head = file.read(offset, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no member at the offset of {name}")
        out[name] = Member(name, offset + 30 + sum(struct.unpack_from("<HH", head, 26)), packed, method)
        at += 46 + names + extras + comments
    return out


def indexed(file: Ranges) -> Iterator[tuple[Member, int, int]]:
    """Archive member, offset in it and length of each record that the index names; members must be stored, not deflated."""
    found = members(file)
    for name, member in found.items():
        if name.startswith("indexes/") and name.endswith(".cdxj"):
            for line in _stored(file, member).decode().splitlines():
                entry = json.loads(line[line.index("{") :])
                archive = found["archive/" + entry["filename"]]
                if archive.method:
                    raise ValueError(f"{archive.name} is not stored")
                yield archive, int(entry["offset"]), int(entry["length"])


def _stored(file: Ranges, member: Member) -> bytes:
    content = file.read(member.offset, member.size)
    return content if member.method == 0 else zlib.decompress(content, -15)


def records(file: Ranges, window: int = 4 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head fields and block of each record, read by ranges: neighbouring records share a read of up to `window` bytes."""
    begin, held = 0, b""
    for archive, offset, length in indexed(file):
        at = archive.offset + offset
        if not (begin <= at and at + length <= begin + len(held)):
            begin, held = at, file.read(at, max(length, min(window, archive.size - offset)))
        content = gzip.decompress(held[at - begin : at - begin + length])
        head, _, rest = content.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
        yield fields, rest[: int(fields["Content-Length"])]


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write a record per row of `pages` (page_id, url, html) to packages under `path`.

    Of records with equal payloads of at least `min_bytes` bytes that with the largest page_id is a response, and others are revisits
    of it; rows that repeat page_id and payload are each a response. Records of NULL page_ids are responses only if all of their payload
    are. NULL html is an empty payload; other columns are ignored.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    often = rows.filter(F.octet_length("html") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(often, "sha", "left").select("page_id", "url", "html", "response")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def every() -> Iterator[tuple[str, bytes]]:
            for batch in batches:
                for page_id, url, html, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    revisit = response is not None and page_id != response
                    yield f"{page_id} 20260101000000", record(page_id, url, html.encode("utf-8", "surrogatepass"), response, revisit)

        for piece in package(every()):
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.binary())], ["piece"])

    pieces = in_python(rows, run, "piece binary")
    pieces.select(F.col("piece").cast("string").alias("value")).write.text(path)


def read(spark, path: str, through_spark: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record in the packages under `path`.

    Executors read ranges of the packages through Arrow's file systems. For a store that only Spark reads, `through_spark`
    hands each package's bytes to the same reader, and packages must then fit in memory.
    """
    files = spark.read.format("binaryFile").load(path).filter(F.col("length") > 0)
    packages = files.select("path").count()
    files = files.select("path", "content" if through_spark else F.lit(None).cast("binary").alias("content")).repartition(max(1, packages))  # a task for each package

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [described(*r) for r in records(Ranges(place, content))]
                for at in range(0, len(rows), 10_000):
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows[at : at + 10_000], strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return in_python(files, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def described(fields: dict[str, str], block: bytes) -> tuple:
    """What a record says, after a check of a response's payload against its length and digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(line.split(b":")[1] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")))
    marked = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest(payload) != marked):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what was written")
    number = lambda name: (lambda v: int(v) if v else None)(fields.get(name, "<urn:page:>").removeprefix("<urn:page:").removesuffix(">"))
    return number("WARC-Record-ID"), size, marked, kind, number("WARC-Refers-To")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write `pages` to packages in the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "packages")
    write(pages, path, min_bytes)
    return read(pages.sparkSession, path)
