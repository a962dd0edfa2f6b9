"""WARC records in ZIP packages: a writer, and a reader that ranges into them without extraction.

A package is a ZIP file with stored (uncompressed) members: one WARC file whose
records are gzip members of their own, and its index, one JSON line per record
with offset and length. The reader parses the end of the file, the ZIP64 end
records if there are any and the central directory, finds the WARC and index
members, and turns the index into ranges of at most ``RANGE_BYTES``. The ranges
are spread over the cluster; each is one read, cut into records.

Packages lie in storage that all executors reach, opened through Arrow's file
systems. A package's name is unique to the attempt that writes it and only the
names that Spark has collected into the written list are read, so a lost or
repeated task leaves nothing but an unread file.

Equal payloads: the record with the smallest page id is the response, others
are revisits that refer to it; payloads under ``least_bytes`` are always
responses. Defined cases: a null payload is empty; a null page id is never
referred to unless all ids of the payload are null, and is named by the payload;
rows with the page id that is referred to are all responses; a null or odd url
is percent-encoded or left out. An empty table writes no package.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_features.sources.storage import materialize, run_dir

PACKAGE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
DATE = "2026-01-01T00:00:00Z"

#: Fixed values of the ZIP format: signatures and fixed-size record layouts (little-endian).
CENTRAL = (0x02014B50, "<IHHHHHHIIIHHHHHII")
LOCAL = (0x04034B50, "<IHHHHHIIIHH")
END = (0x06054B50, "<IHHHHIIH")
END64_LOCATOR = (0x07064B50, "<IIQI")
END64 = (0x06064B50, "<IQHHIIQQQQ")
ZIP64_EXTRA = 0x0001
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


# --- reading packages -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def _unpack(record: tuple[int, str], data: bytes, at: int) -> tuple:
    fields = struct.unpack_from(record[1], data, at)
    if fields[0] != record[0]:
        raise ValueError(f"no ZIP record {record[0]:#x}")
    return fields


def _read(file, at: int, size: int) -> bytes:
    file.seek(at)
    data = file.read(size)
    if len(data) != size:
        raise ValueError("package ends too early")
    return data


def central_directory(file, size: int) -> list[Member]:
    """The members of a package by its central directory, ZIP64 values included."""
    tail_at = max(0, size - (1 << 16) - struct.calcsize(END[1]))
    tail = _read(file, tail_at, size - tail_at)
    at = tail.rfind(struct.pack("<I", END[0]))
    if at < 0:
        raise ValueError("not a ZIP package")
    _, _, _, _, entries, directory_size, directory_at, _ = _unpack(END, tail, at)
    locator_at = tail_at + at - struct.calcsize(END64_LOCATOR[1])
    if locator_at >= 0:
        locator = _read(file, locator_at, struct.calcsize(END64_LOCATOR[1]))
        if struct.unpack_from("<I", locator)[0] == END64_LOCATOR[0]:
            end_at = _unpack(END64_LOCATOR, locator, 0)[2]
            fields = _unpack(END64, _read(file, end_at, struct.calcsize(END64[1])), 0)
            entries, directory_size, directory_at = fields[7], fields[8], fields[9]
    directory, at, members = _read(file, directory_at, directory_size), 0, []
    for _ in range(entries):
        fields = _unpack(CENTRAL, directory, at)
        method, packed, plain = fields[4], fields[8], fields[9]
        name_size, extra_size, comment_size, header = fields[10], fields[11], fields[12], fields[16]
        at += struct.calcsize(CENTRAL[1])
        name = directory[at : at + name_size].decode("utf-8", "replace")
        extra = directory[at + name_size : at + name_size + extra_size]
        at += name_size + extra_size + comment_size
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == ZIP64_EXTRA:
                # the values that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                header = next(wide) if header == FULL32 else header
            extra = extra[4 + length :]
        members.append(Member(name, method, packed, header))
    return members


def data_offset(file, member: Member) -> int:
    """Where a stored member's bytes begin; its local header may have another extra field than the directory."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed; ranges need stored members")
    fields = _unpack(LOCAL, _read(file, member.header, struct.calcsize(LOCAL[1])), 0)
    return member.header + struct.calcsize(LOCAL[1]) + fields[9] + fields[10]


def package_ranges(path: str, range_bytes: int = RANGE_BYTES) -> Iterator[tuple[str, int, list[int]]]:
    """(path, offset, record lengths) of neighbouring records, from every index in the package."""
    system, name = opened(path)
    with system.open_input_file(name) as file:
        members = {m.name: m for m in central_directory(file, file.size())}
        for index in (m for n, m in members.items() if n.startswith("indexes/")):
            entries = []
            for line in _read(file, data_offset(file, index), index.size).splitlines():
                entry = json.loads(line[line.index(b"{") :])
                entries.append((entry["filename"], entry["offset"], entry["length"]))
            entries.sort()
            lengths: list[int] = []
            warc, begin, held, base = None, 0, 0, 0
            for filename, offset, length in entries:
                if lengths and (warc != filename or offset != begin + held or held + length > range_bytes):
                    yield path, base + begin, lengths
                    lengths = []
                if not lengths:
                    base = base if warc == filename else data_offset(file, members[filename])
                    warc, begin, held = filename, offset, 0
                lengths.append(length)
                held += length
            if lengths:
                yield path, base + begin, lengths


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def parse_record(data: bytes) -> Record:
    """One WARC record, uncompressed."""

    def fields(block: bytes) -> dict[str, str]:
        lines = block.decode("utf-8").split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}

    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = fields(head)
    block = rest[: int(headers["content-length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    return Record(headers, fields(http_head), payload)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page_of(urn: str | None) -> str | None:
    return None if urn is None or urn.startswith("<urn:payload:") else urn.removeprefix("<urn:page:").removesuffix(">")


TASKS_PER_CORE = 8
RECORDS = "page_id string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, payload binary"


def read_records(packages: DataFrame) -> DataFrame:
    """Every record of the packages named in the column ``path``; a revisit has no payload of its own."""

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = list(package_ranges(path))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()),
                     pa.array([f[2] for f in found], pa.list_(pa.int64()))],
                    ["path", "offset", "lengths"],
                )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for path, offset, lengths in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                system, name = opened(path)
                with system.open_input_file(name) as file:
                    data = _read(file, offset, sum(lengths))
                rows, at = [], 0
                for length in lengths:
                    record = parse_record(gzip.decompress(data[at : at + length]))
                    at += length
                    h = record.headers
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    revisit = h["warc-type"] == "revisit"
                    if not revisit and sha1_base32(record.payload) != digest:
                        raise ValueError(f"{path}: a payload differs from its digest")
                    rows.append(
                        {
                            "page_id": _page_of(h["warc-record-id"]), "url": h.get("warc-target-uri"),
                            "record_type": h["warc-type"], "refers_to": _page_of(h.get("warc-refers-to")),
                            "payload_bytes": int(record.http["content-length"]) if revisit else len(record.payload),
                            "payload_digest": digest, "payload": None if revisit else record.payload,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema)

    ranges = materialize(packages.select("path").mapInArrow(ranged, "path string, offset bigint, lengths array<bigint>"))
    # the rows are tiny and what they stand for is not: the number of tasks is given, so that none are merged
    tasks = min(ranges.count(), TASKS_PER_CORE * packages.sparkSession.sparkContext.defaultParallelism)
    return ranges.repartition(max(1, tasks)).mapInArrow(records, RECORDS)


# --- writing packages -------------------------------------------------------------------------------------------------


def _urn(page: object, payload_digest: str) -> str:
    return f"<urn:payload:{payload_digest}>" if page is None else f"<urn:page:{page}>"


def warc_record(page: object, url: str | None, payload: bytes, refers_to: object, revisit: bool) -> tuple[bytes, str]:
    """One record and its payload digest."""
    digest = sha1_base32(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page, digest)}"]
    if url:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._' + chr(39))}")
    lines += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_urn(refers_to, digest)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def write_package(sink, records: Iterator[tuple], most: int) -> int:
    """Records into one package until it holds ``most`` bytes; how many it took."""
    index, at = io.BytesIO(), 0
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
        with package.open(zipfile.ZipInfo(WARC_MEMBER), "w", force_zip64=True) as warc:
            n = 0
            for page, url, payload, refers_to, revisit in records:
                record, digest = warc_record(page, url, payload or b"", refers_to, revisit)
                packed = gzip.compress(record, 6, mtime=0)
                warc.write(packed)
                entry = {"url": url, "digest": digest, "filename": WARC_MEMBER, "offset": at, "length": len(packed)}
                index.write(f"{page} {DATE} {json.dumps(entry)}\n".encode())
                at, n = at + len(packed), n + 1
                if at >= most:
                    break
        package.writestr(zipfile.ZipInfo(INDEX_MEMBER), index.getvalue())
    return n


def write_packages(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    least_bytes: int = 0, package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write every row as a record; (path, n_records) of the packages, written once."""
    rows = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).alias("url"),
        F.coalesce(F.col(body_col), F.lit("")).cast("binary").alias("body"),
    ).withColumn("same", F.sha2("body", 256))
    # a payload that stands once needs no partner; counts are combined before they are shuffled
    firsts = rows.select("page", "same", F.octet_length("body").alias("size")).where(F.col("size") >= least_bytes)
    firsts = firsts.groupBy("same").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = rows.join(materialize(firsts.select("same", "first")), "same", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    records = joined.select("page", "url", "body", "first", revisit.alias("revisit"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        rows = each()
        following = next(rows, None)
        while following is not None:
            path = f"{folder}/{uuid.uuid4().hex}.wacz"
            system, name = opened(path)
            system.create_dir(name.rpartition("/")[0], recursive=True)

            def chained(first=following) -> Iterator[tuple]:
                yield first
                yield from rows

            with system.open_output_stream(name) as sink:
                n = write_package(sink, chained(), package_bytes)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "n_records"])
            following = next(rows, None)

    return materialize(records.mapInArrow(written, "path string, n_records bigint"))


def package_folder(spark: SparkSession) -> str:
    return f"{run_dir(spark)}/packages/{uuid.uuid4().hex}"
