"""WARC records in ZIP packages: written by partition, read by ranges without extraction.

A package holds, all stored without compression of its own:

    archive/data-NNNN.warc.gz   one gzip member per record
    indexes/index.jsonl         a line per record: member, offset, length, type, page

The reader goes from the end of the file to the (ZIP64) directory, to the index, to the records.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.llm.common import files_below, open_ranged, shared_folder, text_or_empty, write_bytes, written

#: Payloads below this are never replaced by a revisit.
LEAST_BYTES = 1000
MEMBER_BYTES = 8 << 20
INDEX = "indexes/index.jsonl"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_U16, _U32 = 0xFFFF, 0xFFFFFFFF


# ---- ZIP ----------------------------------------------------------------------------------------


class ZipRows:
    """A ZIP package as rows of bytes, each of which a newline will follow in the file.

    The newlines between members are gaps that the directory skips; the last is the archive comment.
    """

    def __init__(self, zip64: bool = False):
        self.at, self.entries, self.zip64 = 0, [], zip64

    def member(self, name: str, data: bytes) -> bytes:
        crc, n, raw = zlib.crc32(data), len(data), name.encode()
        wide = self.zip64 or n >= _U32
        extra = struct.pack("<HHQQ", 1, 16, n, n) if wide else b""
        short = _U32 if wide else n
        head = struct.pack("<4s5H3I2H", b"PK\3\4", 45 if wide else 20, 0x800, 0, 0, 33, crc, short, short, len(raw), len(extra))
        self.entries.append((raw, crc, n, self.at))
        row = head + raw + extra + data
        self.at += len(row) + 1
        return row

    def end(self) -> bytes:
        rows = []
        for raw, crc, n, at in self.entries:
            wide = self.zip64 or n >= _U32 or at >= _U32
            extra = struct.pack("<HHQQQ", 1, 24, n, n, at) if wide else b""
            sizes = (_U32, _U32) if wide else (n, n)
            head = struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45 if wide else 20, 0x800, 0, 0, 33, crc, *sizes, len(raw), len(extra), 0, 0, 0, 0, _U32 if wide else at)
            rows.append(head + raw + extra)
        directory, n = b"".join(rows), len(self.entries)
        wide = self.zip64 or n >= _U16 or self.at >= _U32 or len(directory) >= _U32
        tail = b""
        if wide:
            tail += struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, len(directory), self.at)
            tail += struct.pack("<4sIQI", b"PK\6\7", 0, self.at + len(directory), 1)
        seen = (_U16, _U16, _U32, _U32) if wide else (n, n, len(directory), self.at)
        return directory + tail + struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, *seen, 1)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    packed: int
    crc: int
    header: int  # where its local header begins


def _range(file, at: int, n: int) -> bytes:
    file.seek(at)
    return file.read(n)


def read_directory(file) -> dict[str, Member]:
    """The members that the central directory lists; follows ZIP64 records where they are needed."""
    file.seek(0, 2)
    size = file.tell()
    tail = _range(file, max(0, size - 65557), min(size, 65557))
    at = len(tail)
    while True:
        at = tail.rfind(b"PK\5\6", 0, at)
        if at < 0:
            raise ValueError("not a ZIP package: no end of central directory")
        if len(tail) - at >= 22 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    _, _, _, n, length, start = struct.unpack_from("<4H2I", tail, at + 4)[0:6]
    if _U16 == n or _U32 in (length, start):
        end = max(0, size - 65557) + at
        mark, _, where, _ = struct.unpack("<4sIQI", _range(file, end - 20, 20))
        if mark == b"PK\6\7":
            record = _range(file, where, 56)
            if record[:4] != b"PK\6\6":
                raise ValueError("damaged ZIP64 end of central directory")
            n, length, start = struct.unpack_from("<3Q", record, 32)
    raw, at, members = _range(file, start, length), 0, {}
    for _ in range(n):
        mark, _, _, _, method, _, _, crc, packed, plain, k, e, c, _, _, _, header = struct.unpack_from("<4s6H3I5H2I", raw, at)
        if mark != b"PK\1\2":
            raise ValueError("damaged central directory")
        name, extra = raw[at + 46 : at + 46 + k].decode(), raw[at + 46 + k : at + 46 + k + e]
        while len(extra) >= 4:
            kind, m = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{m // 8}Q", extra, 4))
                plain = next(wide) if plain == _U32 else plain
                packed = next(wide) if packed == _U32 else packed
                header = next(wide) if header == _U32 else header
            extra = extra[4 + m :]
        members[name] = Member(name, method, plain, packed, crc, header)
        at += 46 + k + e + c
    return members


def data_start(file, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    head = _range(file, member.header, 30)
    if head[:4] != b"PK\3\4":
        raise ValueError(f"damaged local header of {member.name}")
    if member.method:
        raise ValueError(f"{member.name} is not stored: its records can't be read by ranges")
    return member.header + 30 + sum(struct.unpack_from("<2H", head, 26))


def read_index(file, members: dict[str, Member]) -> list[dict]:
    member = members[INDEX]
    return [json.loads(x) for x in _range(file, data_start(file, member), member.size).splitlines()]


# ---- WARC ---------------------------------------------------------------------------------------


def _id(page_id) -> str:
    return f"<urn:page:{page_id}>"


def make_record(page_id, url, payload: bytes | None, digest: str, n: int, refers_to) -> bytes:
    """A response with its payload, or without one a revisit of ``refers_to``."""
    block = _HTTP + payload if payload is not None else _HTTP
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {_id(page_id)}"]
    if url is not None:  # no line break or other control character may enter a header
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Bytes: {n}"]
    if payload is None:
        head += [f"WARC-Refers-To: {_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload (empty for a revisit)."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.split(b"\r\n\r\n", 1)[1]


def write_archives(pages: DataFrame, folder: str, member_bytes: int = MEMBER_BYTES, zip64: bool = False) -> str:
    """Write a record for each row of ``pages(page_id, url, html)``, a package per task.

    Of rows with equal payloads of at least ``LEAST_BYTES`` bytes, those with the largest ``page_id`` are
    responses and the others revisit it; a null ``page_id`` counts as the smallest.  Other rows are
    responses.  A null ``html`` is an empty payload, a null ``url`` gives no target header; rows may repeat.
    Other columns are ignored.  The payloads are only shuffled if the repeated digests are too many to broadcast.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", text_or_empty("html").alias("html"))
    rows = rows.select("*", F.sha1("html").alias("digest"), F.octet_length("html").cast("bigint").alias("n"))
    same = rows.where(F.col("n") >= LEAST_BYTES).groupBy("digest", "n")
    target = same.agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    target = written(target.select("digest", "n", "target"), "repeated-payloads")
    rows = rows.join(target, ["digest", "n"], "left")
    revisit = F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    rows = rows.select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "digest", "n", F.when(revisit, F.col("target")))

    def packages(batches) -> Iterator[pa.RecordBatch]:
        package, index, held, size, number = ZipRows(zip64), [], [], 0, 0

        def row(data: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

        for batch in batches:
            for page_id, url, html, digest, n, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                payload = None if html is None else html.encode("utf-8", "surrogatepass")
                squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
                record = squeeze.compress(make_record(page_id, url, payload, digest, n, refers_to)) + squeeze.flush()
                line = {"member": f"archive/data-{number:04d}.warc.gz", "offset": size, "length": len(record), "page_id": page_id}
                index.append(json.dumps(line, separators=(",", ":")))
                held.append(record)
                size += len(record)
                if size >= member_bytes:
                    yield row(package.member(f"archive/data-{number:04d}.warc.gz", b"".join(held)))
                    held, size, number = [], 0, number + 1
        if held:
            yield row(package.member(f"archive/data-{number:04d}.warc.gz", b"".join(held)))
        if index:
            yield row(package.member(INDEX, "\n".join(index).encode()))
            yield row(package.end())

    write_bytes(rows.mapInArrow(packages, "value binary"), folder)
    return folder


def read_archives(spark: SparkSession, folder: str, keep_payload: bool = False) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to)`` per record of the packages.

    Bytes and digest of a response are those of the payload that was read, and must be those its headers
    state; a revisit has those of the payload it refers to.  ``keep_payload`` adds the payload (null for a revisit).
    """
    files = files_below(spark, folder).where("length > 0").select("path")
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    fields += [("record_type", pa.string()), ("refers_to", pa.int64())] + ([("payload", pa.binary())] if keep_payload else [])
    schema = pa.schema(fields)

    def read(batches):
        import hashlib

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_ranged(path) as file:
                    members = read_directory(file)
                    starts, rows = {}, []
                    for line in read_index(file, members):
                        name = line["member"]
                        if name not in starts:
                            starts[name] = data_start(file, members[name])
                        raw = zlib.decompress(_range(file, starts[name] + line["offset"], line["length"]), 31)
                        headers, payload = parse_record(raw)
                        digest, n = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["WARC-Payload-Bytes"])
                        kind, refers_to = headers["WARC-Type"], headers.get("WARC-Refers-To", "")[10:-1]
                        if kind == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (n, digest):
                            raise ValueError(f"damaged payload of page {line['page_id']} in {path}")
                        row = (line["page_id"], headers.get("WARC-Target-URI"), n, digest, kind, int(refers_to) if refers_to else None)
                        rows.append(row + ((payload if kind == "response" else None,) if keep_payload else ()))
                        if len(rows) >= 1024:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    kinds = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    tasks = files.repartition(max(1, files.count()))
    return tasks.mapInArrow(read, kinds + (", payload binary" if keep_payload else ""))


def archived(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``pages`` to packages and read the records back."""
    folder = folder or shared_folder(pages.sparkSession, "packages")
    return read_archives(pages.sparkSession, write_archives(pages, folder, **options))
