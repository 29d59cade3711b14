"""Token-id files: blocks of ids as byte or bit planes, each plane compressed, with a chunk index.

A file holds ids of whole documents in ascending ``doc_id`` order:

    chunk*  compressed planes of up to ``block`` ids, one after another, then a newline
    footer  compressed index, its length (8 bytes, little endian), ``MAGIC``, then a newline

The index has the plane lengths of every chunk and ``(doc_id, tokens)`` of every document,
so that any document is read by fetching the chunks it lies in.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segmentry.llm.common import files_below, open_ranged, shared_folder, text_or_empty, written
from segmentry.llm.tokens import encoder

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
TAIL = 8 + len(MAGIC) + 1
LEVEL = 3


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """4 byte planes or 32 bit planes of unsigned 32-bit ids, most significant first."""
    raw = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1)
    return [np.packbits(bits[:, k]).tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        raw = np.packbits(np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1), axis=1)
    return np.ascontiguousarray(raw).view(">u4").ravel().astype(np.uint32)


class _Writer:
    """Turns documents into the rows of one file."""

    def __init__(self, shard: int, kind: str, block: int):
        import zstandard

        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.shard, self.kind, self.block = shard, kind, block
        self.waiting: list[np.ndarray] = []
        self.n = 0
        self.chunks: list[list[int]] = []
        self.docs: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[bytes]:
        self.docs.append((doc_id, len(ids)))
        self.waiting.append(ids)
        self.n += len(ids)
        if self.n >= self.block:
            every = np.concatenate(self.waiting)
            whole = self.n - self.n % self.block
            for k in range(0, whole, self.block):
                yield self._chunk(every[k : k + self.block])
            self.waiting, self.n = [every[whole:]], self.n - whole

    def _chunk(self, ids: np.ndarray) -> bytes:
        planes = [self.pack(p) for p in to_planes(ids, self.kind)]
        self.chunks.append([len(ids), *map(len, planes)])
        return b"".join(planes)

    def end(self) -> Iterator[bytes]:
        if self.n:
            yield self._chunk(np.concatenate(self.waiting))
        index = {"shard": self.shard, "planes": self.kind, "chunks": self.chunks, "docs": self.docs}
        body = self.pack(json.dumps(index, separators=(",", ":")).encode())
        yield body + struct.pack("<Q", len(body)) + MAGIC


def read_index(file) -> dict:
    import zstandard

    file.seek(0, 2)
    end = file.tell()
    file.seek(end - TAIL)
    tail = file.read(TAIL)
    if tail[8:-1] != MAGIC:
        raise ValueError("not a token-id file")
    size = struct.unpack("<Q", tail[:8])[0]
    file.seek(end - TAIL - size)
    return json.loads(zstandard.ZstdDecompressor().decompress(file.read(size)))


def read_chunk(file, index: dict, k: int, offset: int) -> np.ndarray:
    """The ids of chunk ``k``, which begins at ``offset``."""
    import zstandard

    n, *sizes = index["chunks"][k]
    file.seek(offset)
    raw, unpack, planes, at = file.read(sum(sizes)), zstandard.ZstdDecompressor().decompress, [], 0
    for size in sizes:
        planes.append(unpack(raw[at : at + size]))
        at += size
    return from_planes(planes, n, index["planes"])


def offsets(index: dict) -> list[int]:
    """Where the chunks begin; a newline follows each."""
    return [0, *np.cumsum([sum(c[1:]) + 1 for c in index["chunks"]]).tolist()]


def read_document(path: str, position: int) -> np.ndarray:
    """Ids of the document at ``position`` of a file; reads only the chunks it lies in."""
    with open_ranged(path) as file:
        index = read_index(file)
        sizes = [n for _, n in index["docs"]]
        start, at, parts = sum(sizes[:position]), 0, []
        stop = start + sizes[position]
        for k, (offset, chunk) in enumerate(zip(offsets(index), index["chunks"])):
            if at < stop and at + chunk[0] > start:
                parts.append(read_chunk(file, index, k, offset)[max(0, start - at) : stop - at])
            at += chunk[0]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, planes: str = "byte", block: int = BLOCK) -> str:
    """Encode ``docs(doc_id, text)`` and write their ids in ascending ``doc_id`` order.

    Null texts count as empty, so such a document has ``end_id`` alone.  A null ``doc_id``
    comes first; rows that share a ``doc_id`` are all kept, by text.  Other columns
    are ignored.  Only the texts are shuffled, once, by ranges of ``doc_id``; each range is
    encoded and written chunk by chunk by the same task.
    """
    from segmentry.llm.common import write_bytes

    def encode(batches):
        ids_of = encoder(tokenizer_path).encode
        out = _Writer(TaskContext.get().partitionId(), planes, block)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(texts), 512):
                for key, ids in zip(keys[k : k + 512], ids_of(texts[k : k + 512])):
                    for row in out.add(key, np.append(ids, np.uint32(end_id))):
                        yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["value"])
        if out.docs:
            for row in out.end():
                yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["value"])

    rows = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    write_bytes(rows.mapInArrow(encode, "value binary"), folder)
    return folder


def read_ids(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, path, position)`` per document of the files in ``folder``.

    ``start`` counts the ids of all documents before it; ``keep_ids`` adds the ids themselves.
    """
    files = files_below(spark, folder).where("length > 0").select("path")

    def totals(batches):
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                with open_ranged(path) as file:
                    index = read_index(file)
                rows.append({"path": path, "shard": index["shard"], "ids": sum(c[0] for c in index["chunks"])})
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("path", pa.string()), ("shard", pa.int64()), ("ids", pa.int64())])
    shards = files.mapInArrow(totals, "path string, shard bigint, ids bigint")
    # One row per file: the only ordering over all files is over their totals.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = written(shards.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")), "id-shards")

    extra = [("ids", pa.list_(pa.int64()))] if keep_ids else []
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("path", pa.string()), ("position", pa.int64())]
    out = pa.schema(fields + extra)

    def documents(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_ranged(path) as file:
                    index = read_index(file)
                    starts, k, have, at, rows = offsets(index), 0, np.zeros(0, np.uint32), base, []
                    for position, (doc_id, n) in enumerate(index["docs"]):
                        crc, left, parts = 0, n, []
                        while left:
                            if not len(have):
                                have, k = read_chunk(file, index, k, starts[k]), k + 1
                            part, have = have[:left], have[left:]
                            left -= len(part)
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                            if keep_ids:
                                parts.append(part)
                        row = {"doc_id": doc_id, "start": at, "n_tokens": n, "ids_crc32": crc, "path": path, "position": position}
                        if keep_ids:
                            row["ids"] = np.concatenate(parts).tolist() if parts else []
                        rows.append(row)
                        at += n
                        if len(rows) >= 2048:
                            yield pa.RecordBatch.from_pylist(rows, out)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, out)

    kinds = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, path string, position bigint"
    tasks = shards.repartition(max(1, shards.count()))
    return tasks.mapInArrow(documents, kinds + (", ids array<bigint>" if keep_ids else ""))


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, **options) -> DataFrame:
    """Write the ids of ``docs`` and read them back from the files."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-ids")
    return read_ids(spark, write_ids(docs, tokenizer_path, end_id, folder, **options))
