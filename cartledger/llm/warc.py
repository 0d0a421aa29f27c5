"""Web archives: WARC records in ZIP packages, written and range-read by Spark tasks.

A package holds stored (not deflated) members: WARC files whose records are gzip members,
an index with a line for each record, and a description. A reader parses the package's
central directory, also in its ZIP64 form, finds the stored members, reads the index and
then only the byte ranges of records; nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartledger.llm.common import quoted, stored
from cartledger.sources.scratch import scratch_path

#: Bytes of WARC data after which a task begins another package, and of records read at once.
PACKAGE_BYTES = 256 << 20
RANGE_BYTES = 4 << 20
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
LEVEL = 1
INDEX, DATA, ABOUT = "indexes/index.cdxj", "archive/data.warc.gz", "datapackage.json"


# Records


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _header(lines: list[tuple[str, str]]) -> bytes:
    clean = ((k, v.replace("\r", "%0D").replace("\n", "%0A")) for k, v in lines)
    return "".join(f"{k}: {v}\r\n" for k, v in clean).encode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit of ``refers_to`` when that is given, without the payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id))]
    if url is not None:
        lines.append(("WARC-Target-URI", url))
    lines += [("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if revisit:
        lines += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(refers_to)),
        ]
    lines += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + _header(lines) + b"\r\n" + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    page_id: int | None
    url: str | None
    kind: str
    payload_digest: str
    payload_bytes: int
    refers_to: int | None
    payload: bytes | None


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k}


def _page(identifier: str | None) -> int | None:
    value = (identifier or "").strip("<>").rpartition(":")[2]
    return int(value) if value else None


def parse(data: bytes) -> Record:
    """A record from its bytes. Of a response the digest and the length are those of the
    payload found, and must be those that it states."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(_fields(http)["content-length"])
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != length or digest(payload) != stated):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return Record(
        _page(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, stated, length,
        _page(fields.get("warc-refers-to")), payload if kind == "response" else None,
    )


# Packages


class _Output:
    """A forward-only file for ``zipfile``."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, data) -> int:
        self.stream.write(data)
        return len(data)

    def flush(self) -> None:
        pass


def _packages(folder: str, task: str, attempt: str, rows: Iterator[tuple]) -> Iterator[tuple]:
    """Write records (page_id, bytes) into packages; yields (path, bytes of data, records).

    A package is renamed when it is complete, and its name tells the attempt: a task that
    runs twice, perhaps with its rows in another order, writes other packages and replaces
    none. Those that count are listed by the attempt whose rows Spark takes.
    """
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    rows, number = iter(rows), 0
    item = next(rows, None)
    while item is not None:
        name = f"{base}/part-{task}-{attempt}-{number:05d}.zip"
        number += 1
        lines, at = [], 0
        with store.open_output_stream(f"{name}.part") as stream:
            with zipfile.ZipFile(_Output(stream), "w", zipfile.ZIP_STORED, allowZip64=True) as package:
                with package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as member:
                    while item is not None and at < PACKAGE_BYTES:
                        page_id, data = item
                        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        packed = packer.compress(data) + packer.flush()
                        member.write(packed)
                        lines.append(json.dumps({"id": page_id, "offset": at, "length": len(packed)}))
                        at += len(packed)
                        item = next(rows, None)
                package.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines))
                about = {"profile": "data-package", "resources": [DATA, INDEX], "records": len(lines)}
                package.writestr(zipfile.ZipInfo(ABOUT), json.dumps(about))
        store.move(f"{name}.part", name)
        yield name, at, len(lines)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    stored: int
    size: int
    header: int


def _at(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    return file.read(length)


def members(file, size: int) -> list[Member]:
    """The central directory of a ZIP file of ``size`` bytes, ZIP64 included."""
    tail_at = max(0, size - (1 << 16) - 22)
    tail = _at(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of a ZIP directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        locator = _at(file, tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        (big_at,) = struct.unpack_from("<Q", locator, 8)
        big = _at(file, big_at, 56)
        count, length, start = struct.unpack_from("<QQQ", big, 32)
    directory, at, found = _at(file, start, length), 0, []
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("damaged ZIP directory")
        (method,) = struct.unpack_from("<H", directory, at + 10)
        packed, full, n, extra, comment = struct.unpack_from("<IIHHH", directory, at + 20)
        (header,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n].decode("utf-8", "replace")
        more = directory[at + 46 + n : at + 46 + n + extra]
        while len(more) >= 4:
            tag, width = struct.unpack_from("<HH", more)
            if tag == 1:  # 64-bit values, only for the fields that overflowed, in this order
                wide = iter(struct.unpack_from(f"<{width // 8}Q", more, 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            more = more[4 + width :]
        found.append(Member(name, method, packed, full, header))
        at += 46 + n + extra + comment
    return found


def data_offset(file, member: Member) -> int:
    """Where a member's bytes begin: after its own header, whose extra field may differ."""
    name, extra = struct.unpack_from("<HH", _at(file, member.header, 30), 26)
    return member.header + 30 + name + extra


def _ranges(path: str, store) -> Iterator[tuple[int, int, int]]:
    """(offset, length, records) of runs of consecutive records of a package."""
    with store.open_input_file(path) as file:
        found = {m.name: m for m in members(file, file.size())}
        if not {DATA, INDEX} <= found.keys() or any(found[n].method for n in (DATA, INDEX)):
            raise ValueError(f"{path} lacks a stored archive or index")
        data, index = (data_offset(file, found[n]) for n in (DATA, INDEX))
        begin, end, n = 0, 0, 0
        for line in _at(file, index, found[INDEX].size).splitlines():
            entry = json.loads(line)
            if n and (entry["offset"] != end or end - begin >= RANGE_BYTES):
                yield data + begin, end - begin, n
                n = 0
            if not n:
                begin = entry["offset"]
            end, n = entry["offset"] + entry["length"], n + 1
        if n:
            yield data + begin, end - begin, n


def _unpacked(data: bytes) -> Iterator[bytes]:
    """The gzip members of a range of bytes."""
    while data:
        opener = zlib.decompressobj(31)
        yield opener.decompress(data) + opener.flush()
        data = opener.unused_data


# Spark


def with_revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(k, u, payload, refers) of rows (k, u, payload): which row each repeats, if any.

    Payloads are told apart by SHA-1. Only digests that occur twice are joined back, after
    a partial aggregation, so a payload shared by very many pages is one row of it. Rows that
    share the largest key of a payload are stored and numbered, and the first is the response.
    """
    big = F.octet_length("payload") >= min_bytes
    named = pages.withColumn("digest", F.sha1("payload"))
    keys = named.where(big).groupBy("digest", "k").agg(F.count("*").alias("n"))
    twice = stored(
        keys.groupBy("digest").agg(F.max(F.struct("k", "n")).alias("last"), F.sum("n").alias("rows"))
        .where("rows > 1 and last.k is not null")
        .select("digest", F.col("last.k").alias("last"), (F.col("last.n") > 1).alias("shared")),
        "repeated",
    )
    joined = named.join(twice, "digest", "left")
    last = big & F.col("k").eqNullSafe(F.col("last"))
    shared = F.coalesce(last & F.col("shared"), F.lit(False))
    single = joined.where(~shared).select("k", "u", "payload", F.when(big & ~last, F.col("last")).alias("refers"))
    if twice.where("shared").isEmpty():
        return single
    alike = stored(joined.where(shared).drop("shared").withColumn("n", F.monotonically_increasing_id()), "alike")
    first = alike.groupBy("digest").agg(F.min("n").alias("first"))
    again = alike.join(first, "digest").select(
        "k", "u", "payload", F.when(F.col("n") != F.col("first"), F.col("last")).alias("refers")
    )
    return single.unionByName(again)


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Write a record for each row into packages under ``folder``; returns (path, bytes, records).

    Of rows with equal payloads of at least ``min_bytes`` bytes one with the largest key is the
    response and the others are revisits of it; a null key is smaller than any. A null
    page is an empty payload, a null URL leaves its field out.
    """
    rows = pages.select(
        quoted(key).cast("long").alias("k"),
        quoted(url).cast("string").alias("u"),
        F.coalesce(quoted(html), F.lit("")).cast("binary").alias("payload"),
    )
    rows = with_revisits(rows, min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task, attempt = f"{context.partitionId():06d}", str(context.taskAttemptId())

        def records():
            for batch in batches:
                for k, u, payload, refers in zip(*batch.columns):
                    k = k.as_py()
                    yield k, record(k, u.as_py(), payload.as_py(), refers.as_py())

        for path, size, n in _packages(folder, task, attempt, records()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([size], pa.int64()), pa.array([n], pa.int64())],
                names=["path", "bytes", "records"],
            )

    # Written once: the list of packages is a table, so reading it again writes nothing anew.
    return stored(rows.mapInArrow(run, "path string, bytes long, records long"), "packages")


def read_archives(packages: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload) of every
    record of the packages (path, ...), read by byte ranges."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = list(_ranges(path, store))
                columns = list(zip(*found)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found), pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
                    names=["path", "offset", "length", "records"],
                )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, offset, length, _ in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(path) as file:
                    found = [parse(r) for r in _unpacked(_at(file, offset, length))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r.page_id for r in found], pa.int64()),
                        pa.array([r.url for r in found], pa.string()),
                        pa.array([r.kind for r in found], pa.string()),
                        pa.array([r.payload_digest for r in found], pa.string()),
                        pa.array([r.payload_bytes for r in found], pa.int64()),
                        pa.array([r.refers_to for r in found], pa.int64()),
                        pa.array([r.payload for r in found], pa.binary()),
                    ],
                    names=["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"],
                )

    parts = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = packages.select("path").mapInArrow(
        locate, "path string, offset long, length long, records long"
    )
    return ranges.repartition(parts).mapInArrow(
        fetch,
        "page_id long, url string, record_type string, payload_digest string, "
        "payload_bytes long, refers_to long, payload binary",
    )


def with_scheme(spark: SparkSession, folder: str) -> str:
    """A folder as a URI: one without a scheme lies in the default file system, as Spark has it."""
    if "://" in folder or folder.startswith("file:"):
        return folder
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return f"{default.rstrip('/')}{folder}" if not default.startswith("file:") else f"file://{folder}"


def archived(
    spark: SparkSession, pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Write ``pages`` to packages in the shared scratch folder and read all records back."""
    folder = with_scheme(spark, scratch_path(spark, "archives"))
    return read_archives(write_archives(pages, folder, key, url, html, min_bytes), folder)
