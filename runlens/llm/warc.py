"""WARC records in ZIP packages: write them, find them by directory and index, read them by range.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz`` holds one
gzip member per record, ``indexes/index.cdxj`` one line per record with its offset and length there.
A reader takes the end record, the central directory and, where sizes ask for them, the ZIP64 records;
it then reads the index and fetches runs of records by range. Nothing is unpacked to disk. Members
without an index are walked from their first byte.

Packages are written by the tasks through pyarrow's file systems to a folder that all executors reach,
under a name with the attempt's number; only names of tasks that ended well are read.

Of records with equal payloads of at least LEAST bytes, the one with the largest id is the response and
the others revisit it. Digests are joined in narrow groups, and a digest that a third of all pages share
is a skewed join key that adaptive execution splits; only digests that occur twice are on its other side.

Defined cases: a null payload is empty. Rows that share the largest id are all responses, so repeated
rows stay responses; a null id is smaller than any other. An empty table gives no package and no rows.
Payloads of any length are one record. A null url becomes ``urn:page:<id>``; characters that a header
can't hold are percent-encoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import urllib.parse
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.rows import slices
from runlens.session import shared_dir, stage

LEAST = 1000
#: A task begins another package after so many records, which bounds its index in memory.
PACKAGE_RECORDS = 50_000
#: Bytes that one range read fetches, but for a longer record, and that one task fetches in all.
READ_BYTES, TASK_BYTES = 4 << 20, 64 << 20
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the ZIP format: signatures and the sizes of the records they begin.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_BYTES, LOCATOR64_BYTES, ENTRY_BYTES, LOCAL_BYTES = 22, 20, 46, 30

Read = Callable[[int, int], bytes]


class Member(NamedTuple):
    name: str
    offset: int
    size: int


# ---- records


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record: an HTTP response, or a revisit that holds its header alone."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": name(page_id),
        "WARC-Target-URI": urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else name(page_id)[1:-1],
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        head |= {"WARC-Refers-To": name(refers_to), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    else:
        block += payload
    head["Content-Length"] = str(len(block))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in raw.decode().split("\r\n")[1:])}


def parse(raw: bytes) -> dict:
    """Fields of a record; the payload of a response is held against its digest."""
    top, _, rest = raw.partition(b"\r\n\r\n")
    head = _headers(top)
    block = rest[: int(head["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = head["warc-type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
    number = lambda s: int(s) if s else None
    return {
        "page_id": number(head["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")),
        "url": head["warc-target-uri"],
        "record_type": kind,
        "payload_digest": digest,
        "payload_bytes": len(payload) if kind == "response" else int(_headers(http)["content-length"]),
        "refers_to": number(head["warc-refers-to"].removeprefix("<urn:page:").removesuffix(">")) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


# ---- packages


def directory(read: Read, size: int) -> list[Member]:
    """Stored members of a ZIP file, from its central directory."""
    tail = read(max(0, size - END_BYTES - 0xFFFF), min(size, END_BYTES + 0xFFFF))
    at = tail.rfind(END, 0, len(tail) - END_BYTES + len(END))
    while at >= 0 and at + END_BYTES + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = size - len(tail) + at - LOCATOR64_BYTES
        found = read(locator, LOCATOR64_BYTES)
        if found[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end = read(struct.unpack_from("<Q", found, 8)[0], 56)
        if end[:4] != END64:
            raise ValueError("no ZIP64 end record")
        entries, length, start = struct.unpack_from("<QQQ", end, 32)
    table, place, members = read(start, length), 0, []
    for _ in range(entries):
        if table[place : place + 4] != ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", table, place + 8)
        packed, full, n, extra, comment = struct.unpack_from("<IIHHH", table, place + 20)
        local = struct.unpack_from("<I", table, place + 42)[0]
        name = table[place + ENTRY_BYTES : place + ENTRY_BYTES + n].decode("utf-8" if flags & 0x800 else "cp437")
        more, where = table[place + ENTRY_BYTES + n : place + ENTRY_BYTES + n + extra], 0
        while where + 4 <= len(more):
            kind, held = struct.unpack_from("<HH", more, where)
            if kind == 1:  # ZIP64: only the fields that are full elsewhere, in this order
                wide = iter(struct.unpack_from(f"<{held // 8}Q", more, where + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            where += 4 + held
        place += ENTRY_BYTES + n + extra + comment
        if name.endswith("/"):
            continue
        if method != 0 or packed != full:
            raise ValueError(f"{name} is compressed: only stored members can be read by range")
        first = read(local, LOCAL_BYTES)
        if first[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        members.append(Member(name, local + LOCAL_BYTES + sum(struct.unpack_from("<HH", first, 26)), full))
    return members


def walk(read: Read, member: Member) -> Iterator[tuple[int, int]]:
    """Offset and length of the gzip members of a stored member that no index describes."""
    begin = at = member.offset
    stop, tool = member.offset + member.size, zlib.decompressobj(31)
    while at < stop:
        data = read(at, min(READ_BYTES, stop - at))
        at += len(data)
        while data:
            tool.decompress(data)
            if not tool.eof:
                break
            data = tool.unused_data
            yield begin, at - len(data) - begin
            begin, tool = at - len(data), zlib.decompressobj(31)


def ranges(read: Read, size: int) -> Iterator[tuple[int, int]]:
    """Offset in the file and length of every record of a package."""
    members = {m.name: m for m in directory(read, size)}
    listed: set[str] = set()
    for m in (m for n, m in members.items() if n.startswith("indexes/") and n.endswith(".cdxj")):
        for line in read(m.offset, m.size).splitlines():
            x = json.loads(line[line.index(b"{") :])
            listed.add(x["filename"])
            yield members[f"archive/{x['filename']}"].offset + x["offset"], x["length"]
    for n, m in members.items():
        if n.startswith("archive/") and n.removeprefix("archive/") not in listed:
            yield from walk(read, m)


def _open(path: str):
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    return system, place


def _reader(path: str):
    system, place = _open(path)
    file = system.open_input_file(place)
    return (lambda offset, length: file.read_at(length, offset)), file.size(), file


class Package:
    """A package under construction."""

    def __init__(self, path: str):
        system, place = _open(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.path, self.file, self.lines, self.at = path, system.open_output_stream(place), [], 0
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo("archive/data.warc.gz"), "w", force_zip64=True)

    def add(self, key: str, raw: bytes) -> None:
        packed = gzip.compress(raw, compresslevel=1, mtime=0)
        self.data.write(packed)
        place = {"offset": self.at, "length": len(packed), "filename": "data.warc.gz"}
        self.lines.append(f"{key} {json.dumps(place)}\n")
        self.at += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo("indexes/index.cdxj"), "".join(self.lines))
        self.zip.close()
        self.file.close()
        return self.path, len(self.lines), self.at


# ---- tables


def revisits(pages: DataFrame, page_id: Column, payload: Column, least: int = LEAST, url: Column | None = None) -> DataFrame:
    """``page_id``, ``url``, ``payload`` (bytes), ``refers_to``, ``revisit`` of every row."""
    body = F.coalesce(payload.cast("binary"), F.lit(b""))
    rows = pages.select(page_id.cast("long").alias("page_id"), (F.lit(None) if url is None else url).cast("string").alias("url"), body.alias("payload"))
    shared = rows.where(F.octet_length("payload") >= least).groupBy(F.sha1("payload").alias("digest")).agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = rows.withColumn("digest", F.sha1("payload")).join(shared, "digest", "left")
    later = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.select("page_id", "url", "payload", F.when(later, F.col("first")).alias("refers_to"), later.alias("revisit"))


def write_packages(rows: DataFrame, folder: str, package_records: int = PACKAGE_RECORDS) -> DataFrame:
    """Write rows of ``revisits``; gives ``path``, ``records`` and ``bytes`` per package. Run it once: stage the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, made, open_one = TaskContext.get(), [], None
        for batch in batches:
            for part in slices(batch, batch.column("payload")):
                for r in part.to_pylist():
                    if open_one is None:
                        open_one = Package(f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(made)}.wacz")
                    open_one.add(str(r["page_id"]), record(r["page_id"], r["url"], r["payload"], r["refers_to"], r["revisit"]))
                    if len(open_one.lines) >= package_records:
                        made.append(open_one.close())
                        open_one = None
        if open_one is not None:
            made.append(open_one.close())
        yield pa.RecordBatch.from_pydict({"path": [m[0] for m in made], "records": [m[1] for m in made], "bytes": [m[2] for m in made]}, schema=schema)

    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    return rows.mapInArrow(run, "path string, records long, bytes long")


def read_packages(packages: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the packages in column ``path``: directories and indexes first, then runs of records by range.

    Paths and ranges are small rows that stand for many bytes, so the number of tasks follows ``bytes``.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                read, size, file = _reader(path)
                with file:
                    run: list[tuple[int, int]] = []
                    for place in ranges(read, size):
                        if run and place[0] + place[1] - run[0][0] > READ_BYTES:
                            yield _runs(path, run)
                            run = []
                        run.append(place)
                    if run:
                        yield _runs(path, run)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n for n in schema.names if n != "payload" or payloads]
        for batch in batches:
            for run in batch.to_pylist():
                read, _, file = _reader(run["path"])
                with file:
                    begin = min(run["offsets"])
                    data = read(begin, max(a + n for a, n in zip(run["offsets"], run["lengths"], strict=True)) - begin)
                found = [parse(gzip.decompress(data[a - begin : a - begin + n])) for a, n in zip(run["offsets"], run["lengths"], strict=True)]
                yield pa.RecordBatch.from_pydict({n: [f[n] for f in found] for n in names}, schema=pa.schema([schema.field(n) for n in names]))

    def _runs(path: str, run: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"path": [path], "offsets": [[a for a, _ in run]], "lengths": [[n for _, n in run]]},
            schema=pa.schema([("path", pa.string()), ("offsets", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))]),
        )

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    total = packages.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    readers = max(1, -(-total["bytes"] // TASK_BYTES), min(total["n"], packages.sparkSession.sparkContext.defaultParallelism))
    runs = packages.select("path").repartition(max(1, min(readers, total["n"])), "path").mapInArrow(locate, "path string, offsets array<long>, lengths array<long>")
    dealt = runs.repartition(readers, "path", F.col("offsets")[0])
    return dealt.mapInArrow(fetch, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long" + ", payload binary" * payloads)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write every row to packages in the shared folder and read the records back."""
    rows = revisits(pages, F.col(page_id), F.col(payload), url=F.col(url))
    folder = f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_packages(stage(write_packages(rows, folder)))
