"""WARC records in ZIP packages, read by ranges without extraction.

A package is a ZIP archive whose members are *stored*: ``archive/data.warc.gz``
(one gzip member per record) and ``indexes/index.cdx`` (one line per record:
identifier, type, offset and length inside the archive member).  The reader
fetches the tail of the package for the end-of-central-directory record, its
ZIP64 locator and record where they are present, then the central directory;
from there it finds the stored members, the index, and reads single records by
byte range.  Nothing is ever unpacked as a whole.

Defined results: a null html counts as an empty payload and a null url has no
target URI; of records with equal payloads of at least ``least`` bytes, those
with the smallest page_id are responses and the rest revisit it; a null
page_id never is the smallest unless all are null; repeated rows each get a
record; an empty table gives no package and no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import itertools
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialize, new_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A package is closed when its records reach so many bytes.
PACKAGE_BYTES = 256 << 20
#: Fast; the packages hold text that is read back soon.
GZIP_LEVEL = 1
#: Records that one range-reading task row covers.
BLOCK_RECORDS = 512

MANIFEST_SCHEMA = "package string, bytes bigint, records bigint"
RECORD_SCHEMA = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


# ---- digests and record types, native ----


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of ``payload``, by built-in functions: 5 hex digits make 4 base32 digits."""
    digits = F.sha1(payload)
    groups = [F.conv(F.substring(digits, 5 * k + 1, 5), 16, 10).cast("int") for k in range(8)]
    return F.concat(*[F.substring(F.lit(BASE32), (F.shiftright(g, s).bitwiseAND(31)) + 1, F.lit(1)) for g in groups for s in (15, 10, 5, 0)])


def with_types(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages(page_id, url, html)`` with payload, its digest, record_type and refers_to.

    The smallest page_id of each digest is aggregated with map-side partials
    and only digests that occur twice are joined back; Spark's skew join splits
    a digest that holds a large share of all rows.
    """
    own = pages.select(pages["page_id"].cast("bigint").alias("page_id"), pages["url"].cast("string").alias("url"), F.encode(F.coalesce(pages["html"].cast("string"), F.lit("")), "UTF-8").alias("payload"))
    own = own.withColumn("payload_digest", base32_sha1(F.col("payload")))
    first = own.where(F.length("payload") >= least).groupBy(F.col("payload_digest").alias("d")).agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    joined = own.join(first, (F.col("payload_digest") == F.col("d")) & (F.length("payload") >= least), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


# ---- records ----


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(rid: str) -> int | None:
    tail = rid.strip("<>").rpartition(":")[2]
    return None if tail == "none" else int(tail)


def _awkward(b: int) -> bool:
    return b <= 0x20 or b == 0x7F


def _uri(url: str) -> str:
    """A URL with its control characters, blanks and ``%`` as escapes; bytes stand as Latin-1."""
    return "".join(f"%{b:02X}" if _awkward(b) or b == 0x25 else chr(b) for b in url.encode())


def _url(uri: str) -> str:
    return re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m[1], 16)]), uri.encode("latin-1")).decode()


def build(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One uncompressed WARC/1.1 record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        plain = not any(map(_awkward, url.encode()))
        head.insert(3, f"WARC-Target-URI: {url.encode().decode('latin-1') if plain else _uri(url)}")
        head += [] if plain else ["X-Target-URI-Escaped: 1"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(head).encode("latin-1") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """Read a record that :func:`build` made: the columns of RECORD_SCHEMA.

    A response's length and digest are those of the payload that is there; a
    revisit has them from its headers.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("latin-1").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    if kind == "response":
        n, digest, refers = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), None
        if digest != fields["WARC-Payload-Digest"].removeprefix("sha1:"):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    else:
        n = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))[15:])
        digest, refers, payload = fields["WARC-Payload-Digest"].removeprefix("sha1:"), page_of(fields["WARC-Refers-To"]), None
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = _url(url) if "X-Target-URI-Escaped" in fields else url.encode("latin-1").decode()
    return page_of(fields["WARC-Record-ID"]), url, kind, refers, n, digest, payload


# ---- ZIP ----


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header_at: int


class PackageWriter:
    """Streams a ZIP of two stored members; ZIP64 fields throughout if ``zip64`` or where sizes need them."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at = out, zip64, 0
        self.index: list[str] = []
        self.members: list[tuple[str, int, int, int]] = []
        self._open(DATA)

    def _put(self, b: bytes) -> None:
        self.out.write(b)
        self.at += len(b)

    def _open(self, name: str) -> None:
        self.name, self.header_at, self.crc = name, self.at, 0
        # sizes follow in a data descriptor (flag bit 3); a ZIP64 extra field makes it 8 bytes wide
        raw = name.encode()
        self._put(struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0x808, 0, 0, 33, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 20) + raw + struct.pack("<HHQQ", 1, 16, 0, 0))
        self.data_at = self.at

    def _close(self) -> None:
        n = self.at - self.data_at
        self._put(struct.pack("<4sIQQ", b"PK\7\x08", self.crc, n, n))
        self.members.append((self.name, self.crc, n, self.header_at))

    def add(self, rid: str, kind: str, record: bytes) -> None:
        packed = gzip.compress(record, GZIP_LEVEL, mtime=0)
        self.index.append(f"{rid} {kind} {self.at - self.data_at} {len(packed)}\n")
        self.crc = zlib.crc32(packed, self.crc)
        self._put(packed)

    def finish(self) -> int:
        self._close()
        self._open(INDEX)
        for k in range(0, len(self.index), 4096):
            part = "".join(self.index[k : k + 4096]).encode()
            self.crc = zlib.crc32(part, self.crc)
            self._put(part)
        self._close()
        directory_at = self.at
        for name, crc, n, header_at in self.members:
            raw = name.encode()
            wide = self.zip64 or max(n, header_at) >= 0xFFFFFFFF
            extra = struct.pack("<HHQQQ", 1, 24, n, n, header_at) if wide else b""
            small = (0xFFFFFFFF,) * 3 if wide else (n, n, header_at)
            self._put(struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0x808, 0, 0, 33, crc, small[0], small[1], len(raw), len(extra), 0, 0, 0, 0, small[2]) + raw + extra)
        n, count = self.at - directory_at, len(self.members)
        wide = self.zip64 or self.at >= 0xFFFFFFFF
        if wide:
            end_at = self.at
            self._put(struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, count, count, n, directory_at))
            self._put(struct.pack("<4sIQI", b"PK\6\7", 0, end_at, 1))
        self._put(struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, count, count, 0xFFFFFFFF if wide else n, 0xFFFFFFFF if wide else directory_at, 0))
        return self.at


class Package:
    """Range reads over a ZIP archive: ``size`` bytes behind ``read(at, n)``."""

    def __init__(self, f, size: int):
        self.f, self.size = f, size
        self.members = {m.name: m for m in self._directory()}

    def read(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        got = self.f.read(n)
        if len(got) != n:
            raise ValueError(f"package ends within bytes {at} to {at + n}")
        return got

    def _directory(self) -> Iterator[Member]:
        n = min(self.size, 65_557)
        tail = self.read(self.size - n, n)
        at = tail.rfind(b"PK\5\6")
        if at < 0:
            raise ValueError("no end of a central directory")
        *_, count, size, start, _ = struct.unpack("<4s4H2IH", tail[at : at + 22])
        end = self.size - n + at
        if 0xFFFF == count or 0xFFFFFFFF in (size, start):
            mark, _, at64, _ = struct.unpack("<4sIQI", self.read(end - 20, 20))
            if mark != b"PK\6\7":
                raise ValueError("no ZIP64 locator")
            mark, _, _, _, _, _, _, count, size, start = struct.unpack("<4sQHHIIQQQQ", self.read(at64, 56))
            if mark != b"PK\6\6":
                raise ValueError("no ZIP64 end of a central directory")
        raw, k = self.read(start, size), 0
        for _ in range(count):
            mark, _, _, _, method, _, _, _, packed, plain, a, b, c, _, _, _, header_at = struct.unpack("<4s6H3I5H2I", raw[k : k + 46])
            if mark != b"PK\1\2":
                raise ValueError("broken central directory")
            name, extra = raw[k + 46 : k + 46 + a].decode(), raw[k + 46 + a : k + 46 + a + b]
            e = 0
            while e + 4 <= len(extra):
                kind, n = struct.unpack("<HH", extra[e : e + 4])
                if kind == 1:  # the fields that are full in the entry, in this order
                    wide = iter(struct.unpack(f"<{n // 8}Q", extra[e + 4 : e + 4 + n // 8 * 8]))
                    plain = next(wide) if plain == 0xFFFFFFFF else plain
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    header_at = next(wide) if header_at == 0xFFFFFFFF else header_at
                e += 4 + n
            yield Member(name, method, packed, header_at)
            k += 46 + a + b + c

    def data_at(self, m: Member) -> int:
        """Where a stored member's bytes begin."""
        if m.method != 0:
            raise ValueError(f"{m.name} is not stored")
        mark, *_, a, b = struct.unpack("<4s5H3I2H", self.read(m.header_at, 30))
        if mark != b"PK\3\4":
            raise ValueError(f"no local header of {m.name}")
        return m.header_at + 30 + a + b

    def index(self) -> Iterator[tuple[int, int]]:
        """Byte ranges of all records, in the package's own offsets, read line by line."""
        m = self.members[INDEX]
        base, at, left, rest = self.data_at(self.members[DATA]), self.data_at(m), m.size, b""
        while left:
            n = min(left, 1 << 20)
            *lines, rest = (rest + self.read(at, n)).split(b"\n")
            at, left = at + n, left - n
            for line in lines:
                _, _, offset, length = line.split(b" ")
                yield base + int(offset), int(length)


def _filesystem(uri: str):
    """The store of a folder that driver and executors share."""
    fs, path = pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")
    return fs, path


# ---- Spark ----


def write(typed: DataFrame, out_dir: str, package_bytes: int = PACKAGE_BYTES, zip64: bool = False) -> DataFrame:
    """Write packages of the rows of :func:`with_types`; a lazy manifest of them.

    Every attempt of a task writes under a name of its own, moved into place
    when whole, so a lost or repeated task leaves no half package in the
    manifest.  Materialise the manifest before reading.
    """

    def run(batches):
        fs, folder = _filesystem(out_dir)
        fs.create_dir(folder, recursive=True)
        made: list[tuple[str, int, int]] = []
        w, out, name = None, None, ""

        def close():
            n = w.finish()
            out.close()
            fs.move(f"{folder}/.{name}.tmp", f"{folder}/{name}")
            made.append((f"{out_dir}/{name}", n, len(w.index)))

        for batch in batches:
            for k in range(batch.num_rows):
                page, url, payload, digest, kind, refers = (c[k].as_py() for c in batch.columns)
                if w is None:
                    name = f"{uuid.uuid4().hex}.zip"
                    out = fs.open_output_stream(f"{folder}/.{name}.tmp", compression=None, buffer_size=1 << 20)
                    w = PackageWriter(out, zip64)
                w.add(record_id(page), kind, build(page, url, payload, digest, kind, refers))
                if w.at >= package_bytes:
                    close()
                    w = None
        if w is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["package", "bytes", "records"])

    return typed.select("page_id", "url", "payload", "payload_digest", "record_type", "refers_to").mapInArrow(run, MANIFEST_SCHEMA)


def blocks(manifest: DataFrame, block_records: int = BLOCK_RECORDS) -> DataFrame:
    """Read directories and indexes: a row per block of record ranges."""

    def run(batches):
        kind = pa.list_(pa.int64())
        for batch in batches:
            for package in batch.column(0).to_pylist():
                fs, path = _filesystem(package)
                with fs.open_input_file(path) as f:
                    ranges = Package(f, fs.get_file_info(path).size).index()
                    while part := list(itertools.islice(ranges, block_records)):
                        at, n = zip(*part, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array([package]), pa.array([at], kind), pa.array([n], kind)], ["package", "at", "n"])

    return manifest.select("package").mapInArrow(run, "package string, at array<bigint>, n array<bigint>")


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the manifest's packages by range reads; blocks are dealt out evenly."""

    def run(batches):
        for batch in batches:
            for package, at, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = _filesystem(package)
                with fs.open_input_file(path) as f:
                    for lo in range(0, len(at), 64):
                        rows = []
                        for a, b in zip(at[lo : lo + 64], n[lo : lo + 64], strict=True):
                            f.seek(a)
                            *head, payload = parse(gzip.decompress(f.read(b)))
                            rows.append((*head, payload if payloads else None))
                        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return blocks(manifest).repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4).mapInArrow(run, RECORD_SCHEMA)


def round_trip(pages: DataFrame, least: int = 0, out_dir: str | None = None) -> DataFrame:
    """Write all pages as WARC packages and read every record back."""
    out_dir = out_dir or new_dir(pages.sparkSession, "warc")
    manifest = materialize(write(with_types(pages, least), out_dir), "warc-manifest")
    return read(manifest, payloads=False).drop("payload", "url")
