"""WARC records in ZIP packages: written by tasks, read by ranges without extraction.

A package holds two members, stored and not compressed: ``archive/data.warc.gz``
(one gzip member per record) and ``indexes/index.cdx`` (a line per record:
place, length, kind). The reader opens a package by its end record, follows the
ZIP64 records where a size or place needs them, parses the central directory
and reads single records straight out of the stored archive.

Equal payloads: sizes and digests (SHA-1 with SHA-256 beside it) are computed
in the JVM, groups are found over narrow rows, and a payload moves at most once.
Packages lie in the shared folder; names come from the tasks that finished, so
what a lost executor left behind is never read.

Defined cases: a null payload is empty; a null page_id is written as such and
counts as the smallest; rows that share the largest page_id of their group are
all responses; a null url is left out; a url is percent-encoded where it holds
spaces, control or non-ASCII characters; an empty table gives no packages.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storespark.llm.common import materialise, arrow_ready
from storespark.session import shared_folder

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Least payload for a revisit record, and bytes after which a task begins another package.
LEAST_REVISIT, PACKAGE_BYTES = 1000, 256 << 20
#: A task reads about one block of packages, or the indexes of so many.
READ_BLOCK, INDEXES_PER_TASK = 16 << 20, 16
END, END64, LOCATOR64, ENTRY, LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


class Member(NamedTuple):
    name: str
    method: int
    size: int
    header_at: int


# --- writing -----------------------------------------------------------------


class PackageWriter:
    """A ZIP package with one growing stored member and one stored index, written front to back.

    Sizes come after the data: in the archive's data descriptor and in the
    central directory, which always carry them in ZIP64 form.
    """

    def __init__(self, out) -> None:
        self.out, self.at, self.entries = out, 0, []
        self._index: list[str] = []
        self._begin(ARCHIVE)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _begin(self, name: str) -> None:
        self._name, self._header_at, self._crc = name.encode(), self.at, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._write(
            struct.pack("<IHHHHHIIIHH", LOCAL, 45, 8, 0, 0, 33, 0, FULL32, FULL32, len(self._name), len(extra))
            + self._name
            + extra
        )
        self._data_at = self.at

    def _data(self, data: bytes) -> None:
        self._crc = zlib.crc32(data, self._crc)
        self._write(data)

    def _finish(self) -> None:
        size = self.at - self._data_at
        self._write(struct.pack("<IIQQ", 0x08074B50, self._crc, size, size))
        extra = struct.pack("<HHQQQ", 1, 24, size, size, self._header_at)
        self.entries.append(
            struct.pack("<IHHHHHHIIIHHHHHII", ENTRY, 45, 45, 8, 0, 0, 33, self._crc, FULL32, FULL32,
                        len(self._name), len(extra), 0, 0, 0, 0, FULL32) + self._name + extra
        )

    def record(self, record: bytes, kind: str) -> None:
        data = gzip.compress(record, 1, mtime=0)
        self._index.append(f"{self.at - self._data_at} {len(data)} {kind}\n")
        self._data(data)

    def close(self) -> int:
        self._finish()
        self._begin(INDEX)
        for first in range(0, len(self._index), 10_000):
            self._data("".join(self._index[first : first + 10_000]).encode())
        self._finish()
        directory_at = self.at
        self._write(b"".join(self.entries))
        size, n = self.at - directory_at, len(self.entries)
        end64_at = self.at
        self._write(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, directory_at))
        self._write(struct.pack("<IIQI", LOCATOR64, 0, end64_at, 1))
        self._write(struct.pack("<IHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))
        self.out.close()
        return self.at


def warc_record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> tuple[bytes, str]:
    """A response record with the payload, or a revisit record that names the response instead."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html;charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''':/?#[]@!$&'()*+,;=%~-._''')}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", kind


def package_writer(folder: str, package_bytes: int):
    """A mapInArrow function that writes packages and returns a row for each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        package, name, n = None, "", 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"package": name, "bytes": package.close(), "records": n}])

        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    name, n = f"{uuid.uuid4().hex}.zip", 0
                    package = PackageWriter(store.open_output_stream(f"{base}/{name}", compression=None))
                payload = (row["html"] or "").encode()
                record, kind = warc_record(row["page_id"], row["url"], payload, row["sha1"], row["refers_to"])
                package.record(record, kind)
                n += 1
                if package.at >= package_bytes:
                    yield done()
                    package = None
        if package is not None:
            yield done()

    return write


def with_references(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html, sha1 and refers_to: the response that a revisit names, else null."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", "url", "html", F.sha1(html.cast("binary")).alias("sha1"), F.sha2(html, 256).alias("_sha2"),
        F.octet_length(html).cast("long").alias("_bytes"),
    )
    copies = (
        rows.where(F.col("_bytes") >= least)
        .groupBy("sha1", "_sha2", "_bytes")
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    # written, so that the join shuffles both sides by itself and a page that is everywhere can be split
    copies = materialise(copies, "page-copies")
    joined = rows.join(copies, ["sha1", "_sha2", "_bytes"], "left")
    other = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select("page_id", "url", "html", "sha1", F.when(other, F.col("_first")).alias("refers_to"))


def write_packages(pages: DataFrame, folder: str, least: int = LEAST_REVISIT, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write all pages; returns package, bytes and records of every finished package."""
    arrow_ready(pages.sparkSession)
    written = with_references(pages, least).mapInArrow(
        package_writer(folder, package_bytes), "package string, bytes bigint, records bigint"
    )
    return materialise(written, "packages")


# --- reading -----------------------------------------------------------------


def read_at(file: BinaryIO, at: int, size: int) -> bytes:
    file.seek(at)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"package ends inside a range: {size} bytes at {at}")
    return data


def members(file: BinaryIO, size: int) -> list[Member]:
    """The central directory's entries; ZIP64 records are followed where a field is full."""
    tail_at = max(0, size - (22 + 0xFFFF))
    tail = read_at(file, tail_at, size - tail_at)
    found = tail.rfind(struct.pack("<I", END))
    if found < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, n, length, at, _ = struct.unpack_from("<IHHHHIIH", tail, found)
    locator_at = tail_at + found - 20
    if (n == FULL16 or length == FULL32 or at == FULL32) and locator_at >= 0:
        mark, _, end64_at, _ = struct.unpack("<IIQI", read_at(file, locator_at, 20))
        if mark != LOCATOR64:
            raise ValueError("no ZIP64 locator before the end record")
        mark, *_, n, length, at = struct.unpack("<IQHHIIQQQQ", read_at(file, end64_at, 56))
        if mark != END64:
            raise ValueError("no ZIP64 end record where the locator points")
    directory, place, out = read_at(file, at, length), 0, []
    for _ in range(n):
        fields = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, place)
        if fields[0] != ENTRY:
            raise ValueError("broken central directory")
        method, packed, full, name_len, extra_len, note_len, header_at = fields[4], fields[8], fields[9], *fields[10:13], fields[16]
        name = directory[place + 46 : place + 46 + name_len].decode()
        extra = directory[place + 46 + name_len : place + 46 + name_len + extra_len]
        full, packed, header_at = _zip64(extra, full, packed, header_at)
        out.append(Member(name, method, packed, header_at))
        place += 46 + name_len + extra_len + note_len
    return out


def _zip64(extra: bytes, full: int, packed: int, header_at: int) -> tuple[int, int, int]:
    """The three fields, those that are full read from the ZIP64 extra block in this order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            full = next(wide) if full == FULL32 else full
            packed = next(wide) if packed == FULL32 else packed
            header_at = next(wide) if header_at == FULL32 else header_at
        at += 4 + length
    return full, packed, header_at


def data_at(file: BinaryIO, member: Member) -> int:
    """Where a stored member's bytes begin, by its local header."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; only stored members are read by ranges")
    mark, *_, name_len, extra_len = struct.unpack("<IHHHHHIIIHH", read_at(file, member.header_at, 30))
    if mark != LOCAL:
        raise ValueError(f"no local header for {member.name}")
    return member.header_at + 30 + name_len + extra_len


def index_reader(folder: str):
    """A mapInArrow function from packages to the absolute places of their records."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("package").to_pylist():
                size = store.get_file_info(f"{base}/{name}").size
                with store.open_input_file(f"{base}/{name}") as file:
                    by_name = {m.name: m for m in members(file, size)}
                    start, index = data_at(file, by_name[ARCHIVE]), by_name[INDEX]
                    lines = read_at(file, data_at(file, index), index.size).decode().splitlines()
                for first in range(0, len(lines), 10_000):
                    parts = [line.split(" ") for line in lines[first : first + 10_000]]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "package": [name] * len(parts),
                            "at": [start + int(p[0]) for p in parts],
                            "size": [int(p[1]) for p in parts],
                        }
                    )

    return read


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def record_reader(folder: str, payloads: bool):
    """A mapInArrow function that range-reads records; digests of responses come from the payload itself."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payloads
        )
        name, file = None, None
        for batch in batches:
            rows = []
            for package, at, size in zip(*(batch.column(c).to_pylist() for c in ("package", "at", "size"))):
                if package != name:
                    if file is not None:
                        file.close()
                    name, file = package, store.open_input_file(f"{base}/{package}")
                head, body = parse_record(gzip.decompress(read_at(file, at, size)))
                kind, said = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                digest, length = said, int(head["X-Payload-Length"])
                if kind == "response":
                    digest, length = hashlib.sha1(body).hexdigest(), len(body)
                    if digest != said:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                row = {"page_id": _page(head["WARC-Record-ID"]), "url": head.get("WARC-Target-URI"),
                       "payload_bytes": length, "payload_digest": digest, "record_type": kind,
                       "refers_to": _page(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None}
                rows.append(row | ({"payload": body} if payloads else {}))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if file is not None:
            file.close()

    return read


def read_packages(packages: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """One row per record of ``packages`` (package, bytes); with ``payloads``, the bytes of responses too.

    Indexes are read first; then records are dealt out by package and place, so
    that a large package is read by several tasks, each front to back. How many
    tasks follows the packages' bytes, as the index itself is narrow.
    """
    arrow_ready(packages.sparkSession)
    total, count = packages.agg(F.sum("bytes"), F.count("package")).first()
    listing = packages.select("package").repartition(max(1, -(-count // INDEXES_PER_TASK)), "package")
    places = listing.mapInArrow(index_reader(folder), "package string, at bigint, size bigint")
    block = F.floor(F.col("at") / READ_BLOCK)
    tasks = max(1, -(-(total or 0) // READ_BLOCK))
    dealt = places.repartition(tasks, "package", block).sortWithinPartitions("package", "at")
    return dealt.mapInArrow(record_reader(folder, payloads), RECORD + (", payload binary" if payloads else ""))


def archive_pages(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to packages in the shared folder and read them back."""
    folder = shared_folder(pages.sparkSession, "warc")
    if folder.startswith(("/", "file:/")) and "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    return read_packages(write_packages(pages, folder, least), folder)
