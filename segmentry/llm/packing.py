"""Packing documents into fixed-length sequences by cutting-stock column generation.

Documents are cut into full sequences and one remainder each.  The histogram of piece
lengths (at most ``capacity`` numbers) is all the driver sees: a linear program over
patterns of lengths, priced by a knapsack dynamic program, says how often to use each
pattern.  Patterns rounded down are dealt to the pieces by their rank among pieces of the
same length, which is plain arithmetic on every executor.  What rounding leaves, less than
one sequence per pattern whatever the input, is laid end to end and cut at the capacity;
the tail is cut at powers of two, so it takes no padding.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.common import text_or_empty, written
from segmentry.llm.tokens import encoder

#: The linear program ends when it is this close to its lower bound, or after so many pivots.
GAP = 0.0005
MAX_PIVOTS = 1000
#: Keys of intervals are ``length * SPAN + rank``.
SPAN = 1 << 48


def knapsack(values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value and last item for every capacity; ``values[w]`` is what a piece of length w is worth."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        worth = best[c - 1 :: -1] + values[1 : c + 1] if c < len(values) else best[c - 1 : c - len(values) : -1] + values[1:]
        k = int(worth.argmax())
        best[c], last[c] = (worth[k], k + 1) if worth[k] > best[c - 1] else (best[c - 1], 0)
    return best, last


def _pattern(last: np.ndarray, room: int, size: int) -> np.ndarray:
    counts = np.zeros(size, np.int64)
    while room > 0:
        if last[room]:
            counts[last[room]] += 1
            room -= last[room]
        else:
            room -= 1
    return counts


def first_basis(sizes: np.ndarray, need: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """First-fit-decreasing patterns, each used until it exhausts one of its lengths.

    An exhausted length is in no later pattern, so the matrix is triangular up to order: a feasible basis.
    """
    m = len(sizes)
    left, alive = need.copy(), list(range(m))
    columns, x = np.zeros((m, m)), np.zeros(m)
    while alive:
        room, top, used = capacity, len(alive) - 1, {}
        while top >= 0 and room >= sizes[alive[0]]:
            top = min(top, int(np.searchsorted(sizes[alive], room, "right")) - 1)
            k = alive[top]
            take = int(min(room // sizes[k], max(1, left[k] // 1)))
            used[k] = take
            room -= take * int(sizes[k])
            top -= 1
        out = min(used, key=lambda k: left[k] / used[k])
        times = left[out] / used[out]
        for k, take in used.items():
            columns[k, out] = take
            left[k] = max(0.0, left[k] - times * take)
        x[out] = times
        alive.remove(out)
    return columns, x


def column_generation(demand: np.ndarray, capacity: int, gap: float = GAP, max_pivots: int = MAX_PIVOTS):
    """Patterns and how often to use each (a basic solution of the linear program).

    ``demand[w]`` pieces of length ``w`` must be covered exactly with the fewest sequences.
    """
    sizes = np.flatnonzero(demand[: capacity + 1])
    m = len(sizes)
    if not m:
        return np.zeros((0, capacity + 1), np.int64), np.zeros(0)
    need = demand[sizes].astype(float)
    columns, x = first_basis(sizes, need, capacity)
    inverse = np.linalg.inv(columns)
    pivots, bound = 0, need @ sizes / capacity
    while pivots < max_pivots:
        prices = inverse.sum(axis=0)
        values = np.full(capacity + 1, -1.0)
        values[sizes] = prices
        best, last = knapsack(values, capacity)
        if best[capacity] > 0:
            bound = max(bound, x.sum() / max(1.0, best[capacity]))
        if best[capacity] <= 1 + 1e-9 or x.sum() <= bound * (1 + gap):
            break
        # One table prices the best pattern around every length: take the best few before pricing anew.
        around = prices + best[capacity - sizes]
        improved = False
        for k in np.argsort(-around)[:16]:
            if around[k] <= 1 + 1e-9:
                break
            full = _pattern(last, capacity - sizes[k], capacity + 1)
            full[sizes[k]] += 1
            column = full[sizes].astype(float)
            if inverse.sum(axis=0) @ column <= 1 + 1e-9:
                continue
            d = inverse @ column
            able = d > 1e-6
            if not able.any():
                continue
            ratio = np.full(m, np.inf)
            ratio[able] = np.maximum(x[able], 0) / d[able]
            out = int(np.where(ratio <= ratio.min() + 1e-9, d, 0).argmax())
            columns[:, out] = column
            row = inverse[out] / d[out]
            inverse -= np.outer(d, row)
            inverse[out] = row
            step = ratio[out]
            x -= d * step
            x[out] = step
            pivots, improved = pivots + 1, True
            if pivots % 256 == 0:
                try:
                    inverse = np.linalg.inv(columns)
                except np.linalg.LinAlgError:  # the basis has degenerated: its last solution still holds
                    pivots = max_pivots
                    break
                x = inverse @ need
        if not improved:
            break
    patterns = np.zeros((m, capacity + 1), np.int64)
    patterns[:, sizes] = columns.T.round().astype(np.int64)
    return patterns, np.maximum(x, 0)


@dataclass
class Plan:
    """Where the piece of a given length and rank goes; arithmetic on a few arrays of bounded size."""

    capacity: int
    low: np.ndarray  # interval starts as length * SPAN + rank, sorted
    high: np.ndarray  # interval ends, in the same form
    sequence: np.ndarray  # first sequence of the interval
    copies: np.ndarray  # pieces of the length in one sequence of the pattern
    offset: np.ndarray  # where the first of them begins there
    covered: np.ndarray  # by length: ranks from here on are left over
    stream: np.ndarray  # by length: where the left-over pieces begin in the stream
    total: int  # tokens in the stream
    first_stream: int  # sequence of the stream's beginning

    def place(self, length: np.ndarray, rank: np.ndarray):
        """``(placed, sequence, offset)``; left-over pieces get their place in the stream as the offset."""
        if not len(self.low):
            k = np.zeros(len(length), np.int64)
            placed = np.zeros(len(length), bool)
            sequence, offset = k, k.copy()
        else:
            key = length * SPAN + rank
            k = np.maximum(np.searchsorted(self.low, key, "right") - 1, 0)
            placed = (self.low[k] <= key) & (key < self.high[k])
            turn = key - self.low[k]
            sequence = self.sequence[k] + turn // self.copies[k]
            offset = self.offset[k] + turn % self.copies[k] * length
        left = self.stream[length] + (rank - self.covered[length]) * length
        return placed, np.where(placed, sequence, -1), np.where(placed, offset, left)

    def cuts(self) -> list[int]:
        """Where the stream's last, unfilled sequence is cut: powers of two, the largest first."""
        at, out = self.total - self.total % self.capacity, []
        power = 1 << max(0, (self.total - at).bit_length() - 1)
        while at < self.total:
            while power > self.total - at:
                power >>= 1
            out.append(at)
            at += power
        return out

    def split(self, at: int, length: int):
        """``(sequence, offset, from, to)`` for the parts of a left-over piece at ``at`` in the stream."""
        tail = self.cuts()
        whole = self.total - self.total % self.capacity
        done = 0
        while done < length:
            here = at + done
            if here < whole:
                sequence, begin = divmod(here, self.capacity)
                end, start = (sequence + 1) * self.capacity, here - begin
                begin = here - start
            else:
                k = max(i for i, c in enumerate(tail) if c <= here)
                sequence, start = whole // self.capacity + k, tail[k]
                end, begin = (tail[k + 1] if k + 1 < len(tail) else self.total), here - tail[k]
            take = min(length - done, end - here)
            yield self.first_stream + sequence, begin, done, done + take
            done += take


def make_plan(demand: np.ndarray, capacity: int) -> Plan:
    """``demand[w]`` pieces of each length from 1 to ``capacity``."""
    short = demand.copy()
    short[capacity] = 0
    patterns, times = column_generation(short, capacity)
    covered = np.zeros(capacity + 1, np.int64)
    covered[capacity] = demand[capacity]
    rows = [(capacity * SPAN, capacity * SPAN + int(demand[capacity]), 0, 1, 0)] if demand[capacity] else []
    sequence = int(demand[capacity])
    for pattern, time in zip(patterns, times):
        used = np.flatnonzero(pattern)
        n = int(time + 1e-6)
        if len(used):
            n = min(n, int(((short[used] - covered[used]) // pattern[used]).min()))
        if n <= 0 or not len(used):
            continue
        offset = 0
        for w in used[::-1].tolist():
            a = int(pattern[w])
            rows.append((w * SPAN + int(covered[w]), w * SPAN + int(covered[w]) + a * n, sequence, a, offset))
            covered[w] += a * n
            offset += a * w
        sequence += n
    left = (demand - covered) * np.arange(capacity + 1)
    arrays = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Plan(capacity, *arrays, covered, np.cumsum(left) - left, int(left.sum()), sequence)


def _pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, keep_ids: bool) -> DataFrame:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        + [("doc_tokens", pa.int64()), ("task", pa.int64()), ("rank", pa.int64()), ("ids", pa.binary())]
    )

    def cut(batches):
        ids_of, task, seen = encoder(tokenizer_path).encode, TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(0, len(texts), 512):
                rows = []
                for key, ids in zip(keys[k : k + 512], ids_of(texts[k : k + 512])):
                    raw, n = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes(), len(ids) + 1
                    for start in range(0, n, capacity):
                        part = raw[4 * start : 4 * (start + capacity)]
                        size = len(part) // 4
                        kept = part if keep_ids or size < capacity else None
                        rows.append((key, start, size, zlib.crc32(part), n, task, seen[size], kept))
                        seen[size] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    kinds = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task bigint, rank bigint, ids binary"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(cut, kinds)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 1024, keep_ids: bool = False) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of all ``docs(doc_id, text)``.

    Every row is a document of its own, also when rows or ``doc_id`` repeat or are null; a
    null or empty text is ``end_id`` alone.  An empty table gives no pieces.  Other columns
    are ignored.  ``keep_ids`` adds the ids (little-endian unsigned 32-bit).
    """
    pieces = written(_pieces(docs, tokenizer_path, end_id, capacity, keep_ids), "pieces", texts=True)
    # Rank of a piece among those of its length: its rank within the task that cut it, plus what earlier tasks have.
    counts = pieces.groupBy("task", "length").agg((F.max("rank") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "piece-counts")
    demand = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        demand[length] = n
    plan = make_plan(demand, capacity)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    ranked = pieces.join(counts.drop("n"), ["task", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    limits = F.array(*map(F.lit, plan.covered.tolist()))  # one number per length
    is_left = F.col("rank") >= F.get(limits, F.col("length").cast("int"))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.binary())] if keep_ids else []))
    kinds = ", ".join(f"{n} {'binary' if n == 'ids' else 'bigint'}" for n in schema.names)

    def place(batches):
        for batch in batches:
            at = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            length, rank = (at[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in ("length", "rank"))
            _, sequence, offset = plan.place(length, rank)
            arrays = [at["doc_id"], at["start"], at["length"], at["ids_crc32"], at["doc_tokens"], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays + ([at["ids"]] if keep_ids else []), schema=schema)

    def divide(batches):
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 6))
            _, _, stream = plan.place(length, rank)
            rows = []
            columns = [batch.column(k).to_pylist() for k in (0, 1, 4, 5)]
            for doc_id, start, tokens, ids, at, n in zip(*columns, stream.tolist(), length.tolist()):
                for sequence, offset, a, b in plan.split(at, n):
                    part = ids[4 * a : 4 * b]
                    rows.append((doc_id, start + a, b - a, zlib.crc32(part), tokens, sequence, offset, *([part] if keep_ids else [])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    dealt = ranked.where(~is_left).select(*(names if keep_ids else names[:5]), "rank").mapInArrow(place, kinds)
    return dealt.union(ranked.where(is_left).select(*names, "rank").mapInArrow(divide, kinds))


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the joined ids of each sequence of ``pack(..., keep_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most one sequence of ids
    return pieces.groupBy("sequence_id").agg(F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "").alias("h")).select(
        "sequence_id", F.unhex("h").alias("ids")
    )
