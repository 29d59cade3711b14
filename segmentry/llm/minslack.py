"""Packing whole documents into as few sequences as possible by minimum bin slack.

Per sequence, the longest piece that is left is taken, and a subset-sum dynamic program over the lengths that
are left, on bitsets with one bit per number of tokens, finds the combination that fills the sequence most.
It is then removed.  A fullest combination stays one as long as its pieces last, since removing pieces makes no
fuller one: it is removed as often as it can be at once.  So the search works on the histogram of lengths, of at most
``capacity`` numbers whatever the input, and its combinations are dealt to pieces by their rank among those
of the same length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.common import text_or_empty, written
from segmentry.llm.tokens import encoder

#: Keys of intervals are ``length * SPAN + rank``.
SPAN = 1 << 48


def fullest(have: dict[int, int], capacity: int) -> dict[int, int]:
    """``{length: pieces}`` of the sum nearest below ``capacity`` of ``have[length]`` pieces, with a longest piece in it.

    Of equally full combinations, the one whose sum is reachable with the longest pieces is taken.
    """
    lengths = sorted(have, reverse=True)
    seed = lengths[0]
    room = capacity - seed
    within = (1 << (room + 1)) - 1
    bits, steps = 1, []  # bit s: the lengths so far can add up to s
    for w in lengths:
        times = min(have[w] - (w == seed), room // w)
        if times <= 0:
            continue
        steps.append((w, bits))
        block = 1
        while times:  # 1, 2, 4, ... pieces at a time, then the rest
            take = min(block, times)
            bits |= (bits << (take * w)) & within
            times -= take
            block *= 2
        if bits >> room & 1:
            break
    rest = bits.bit_length() - 1
    chosen = {seed: 1}
    for w, before in reversed(steps):
        while not before >> rest & 1:
            chosen[w] = chosen.get(w, 0) + 1
            rest -= w
    return chosen


def combinations(demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """``({length: pieces}, times)`` that use up ``demand[w]`` pieces of each length ``w``."""
    have = {int(w): int(demand[w]) for w in np.flatnonzero(demand)}
    out = []
    while have:
        chosen = fullest(have, capacity)
        times = min(have[w] // n for w, n in chosen.items())
        for w, n in chosen.items():
            have[w] -= n * times
            if not have[w]:
                del have[w]
        out.append((chosen, times))
    return out


def intervals(demand: np.ndarray, capacity: int) -> np.ndarray:
    """Rows ``(first key, first sequence, pieces per sequence, offset)`` sorted by key, ``length * SPAN + rank``."""
    dealt, sequence, rows = np.zeros(capacity + 1, np.int64), 0, []
    for chosen, times in combinations(demand, capacity):
        offset = 0
        for w, n in sorted(chosen.items(), reverse=True):
            rows.append((w * SPAN + int(dealt[w]), sequence, n, offset))
            dealt[w] += n * times
            offset += n * w
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, keep_ids: bool) -> DataFrame:
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("task", pa.int64()), ("rank", pa.int64())] + ([("ids", pa.binary())] if keep_ids else [])
    schema = pa.schema(fields)

    def cut(batches):
        ids_of, task, seen = encoder(tokenizer_path).encode, TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(texts), 512):
                rows = []
                for key, ids in zip(keys[k : k + 512], ids_of(texts[k : k + 512])):
                    raw = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                    for piece, start in enumerate(range(0, len(raw) // 4, capacity)):
                        part = raw[4 * start : 4 * (start + capacity)]
                        size = len(part) // 4
                        rows.append((key, piece, start, size, zlib.crc32(part), task, seen[size], *([part] if keep_ids else [])))
                        seen[size] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task bigint, rank bigint"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(cut, kinds + (", ids binary" if keep_ids else ""))


def pack_whole(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, keep_ids: bool = False) -> DataFrame:
    """Pieces ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of all ``docs(doc_id, text)``.

    A document of up to ``capacity`` tokens, its end id included, is one piece; a longer one is cut into pieces of
    ``capacity`` tokens, of which the last may be shorter.  Every row is a document of its own, also when rows or
    ``doc_id`` repeat or are null; a null or empty text is ``end_id`` alone.  An empty table gives no pieces.  Other
    columns are ignored.  Among pieces of equal length, any may take any place.  ``keep_ids`` adds the ids
    (little-endian unsigned 32-bit).
    """
    pieces = written(_pieces(docs, tokenizer_path, end_id, capacity, keep_ids), "whole-pieces", texts=True)
    # Rank of a piece among those of its length: its rank within the task that cut it, plus what earlier tasks have.
    counts = pieces.groupBy("task", "length").agg((F.max("rank") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "whole-piece-counts")
    demand = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        demand[length] = n
    first, sequence, copies, offset = intervals(demand, capacity).T

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    kept = ["doc_id bigint", "piece int", "start bigint", "length bigint", "ids_crc32 bigint"] + (["ids binary"] if keep_ids else [])

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            key = length * SPAN + rank
            k = np.searchsorted(first, key, "right") - 1
            turn = key - first[k]
            at = {"sequence_id": sequence[k] + turn // copies[k], "offset": offset[k] + turn % copies[k] * length}
            arrays = [batch.column(n) for n in range(len(names))] + [pa.array(v, pa.int64()) for v in at.values()]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *at])

    ranked = pieces.join(counts.drop("n"), ["task", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    return ranked.select(*names, "rank").mapInArrow(place, ", ".join([*kept, "sequence_id bigint", "offset bigint"]))
