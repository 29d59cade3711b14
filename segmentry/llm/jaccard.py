"""Exact Jaccard join of word n-gram sets in size-banded tiles, with bitmap bounds before exact intersection.

Sets fall into geometric size bands.  Within the tile of a band, two sets above the threshold
differ in at most ``H`` shingles, so that of ``H + 1 + spare`` hash ranges at least ``spare + 1`` hold the same
shingles in both: tiles are keyed by ``(band, range, hash of the shingles in the range)``.  As there are
``spare`` more than needed, each set leaves its ``spare`` most frequent tiles: empty ranges, then those that the most
sets share.  The rarest tile that two such sets share is left by neither.  Only sets
that share a tile are compared: by size, by the bit counts of hashed bitmaps (an upper bound of
the overlap), and last by exact intersection of the sorted arrays.  No pair above the threshold is
lost, up to collisions of the hashes.

Pairs are tried in two rounds: every set with the set that leads most of its tiles, then whatever shares
a tile without being connected yet.  A tile is led by the set that meets the most others, as the original
of edited copies does, so groups of copies cost a pair per member, not all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry.functions.graph import connected_components
from segmentry.llm.common import passing_tables, remove, shared_folder, sized, text_or_empty, written
from segmentry.llm.tokens import release

#: Bits of a bitmap per shingle, at least, and of the narrower one that rows of tiles carry; the number of bits is
#: a power of two from ``LEAST_BITS`` on.
DENSITY, SLIM, LEAST_BITS = 8, 2, 512
RATIO = 1.5
#: Tiles beyond those that are needed, as a share of them: as many frequent ones are left.
SPARE = 0.25
#: The band of a tile is in the low bits of its key.
BAND_BITS = 6
#: Rows of a block of one tile.
BLOCK_ROWS = 1024
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept for repeated words up to ``most`` of them."""

    most = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; of the whole sequence if it is shorter."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        out = mix(out * _MIX[2] + h[k : len(h) - n + 1 + k])
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


class Tiles:
    """Which tiles a set belongs to, for a similarity of ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]
        self.ranges: dict[int, tuple[np.ndarray, int]] = {}

    def _band(self, size: int) -> int:
        while self.edges[-1] <= size:
            self.edges.append(max(self.edges[-1] + 1, math.ceil(self.edges[-1] * RATIO)))
        return int(np.searchsorted(self.edges, size, "right")) - 1

    def _cut(self, band: int) -> tuple[np.ndarray, int]:
        """Bounds of the hash ranges of a band, and how many tiles a set may leave."""
        if band not in self.ranges:
            largest = self.edges[band + 1] - 1
            differ = 2 * largest * (100 - self.percent) // (100 + self.percent)
            k, spare = differ + 1, 0
            if differ:
                spare = int(SPARE * differ)
                empty = (k + spare) * math.exp(-largest / 1.2 / (k + spare))
                spare += math.ceil(empty + 3 * math.sqrt(empty))
                k += spare
            bounds = np.array([(i << 64) // k for i in range(1, k)], np.uint64)
            self.ranges[band] = bounds, spare
        return self.ranges[band]

    def keys(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal keys for every tile that two sets share; ``(band, tiles it may still leave)`` in a row per band.

        Empty ranges are the most frequent tiles, so the first of them are the first to be left.
        """
        size = len(shingles)
        own = self._band(size)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles))])
        out, left = [], []
        band = own
        while band == own or 100 * size >= self.percent * self.edges[band]:
            self._band(self.edges[band])  # the band's end is known from here on
            bounds, spare = self._cut(band)
            if len(bounds):  # with a single range only equal sets share it, and those are one set here
                at = np.concatenate([[0], np.searchsorted(shingles, bounds), [size]])
                content = total[at[1:]] - total[at[:-1]]
                part = np.arange(len(content), dtype=np.uint64)
                empty = np.flatnonzero(at[1:] == at[:-1])
                stays = np.ones(len(content), bool)
                stays[empty[:spare]] = False
                key = mix(mix(content[stays] + part[stays] * _MIX[2]) + np.uint64(band + 1))
                in_band = band % (1 << BAND_BITS)
                out.append(key >> np.uint64(BAND_BITS) << np.uint64(BAND_BITS) | np.uint64(in_band))
                left.append((in_band, max(0, spare - len(empty))))
            band += 1
        keys = np.concatenate(out) if out else np.zeros(0, np.uint64)
        return keys, np.array(left, np.int64).reshape(-1, 2)


def bitmap(shingles: np.ndarray, density: int = DENSITY) -> bytes:
    """Hashed bitmap, as wide as its set asks for; a wider one folds onto a narrower one."""
    width = max(LEAST_BITS, 1 << (density * len(shingles) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, all as wide as the narrowest."""
    width = min(map(len, bits)) // 8
    wide = (np.frombuffer(b, np.uint64) for b in bits)
    return np.stack([b if len(b) == width else np.bitwise_or.reduce(b.reshape(-1, width)) for b in wide])


def may_link(n: np.ndarray, m: np.ndarray, p: np.ndarray, q: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` shingles may link, with ``p`` and ``q`` bits set, ``both`` of them in common.

    Each bit that only one has stands for at least one shingle that the other lacks.
    """
    most = np.minimum(n - p, m - q) + both
    return (100 + percent) * most >= percent * (n + m)


def _described(docs: DataFrame, n: int, percent: int) -> DataFrame:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())]
        + [("bits", pa.binary()), ("slim", pa.binary()), ("keys", pa.list_(pa.int64())), ("spare", pa.map_(pa.int64(), pa.int64()))]
    )

    def describe(batches):
        release()
        hashes, tiles, seen = WordHashes(), Tiles(percent), set()
        for batch in batches:
            ids, texts, keys = (batch.column(k).to_pylist() for k in range(3))
            for k in range(0, len(texts), 256):
                rows = []
                for doc_id, text, key in zip(ids[k : k + 256], texts[k : k + 256], keys[k : k + 256]):
                    shingles = shingle_set(text, n, hashes)
                    if not len(shingles):
                        rows.append((doc_id, key, 0, 0, 0, None, None, None, None))
                        continue
                    with np.errstate(over="ignore"):
                        h1, h2 = (int(mix(shingles + np.uint64(k)).sum(dtype=np.uint64).view(np.int64)) for k in (1, 2))
                    first = h1 not in seen  # copies within a task bring their tiles once
                    seen.add(h1)
                    keys_of, spare = tiles.keys(shingles) if first else (None, None)
                    keys_of, spare = (keys_of.view(np.int64), [tuple(x) for x in spare.tolist()]) if first else (None, None)
                    slim = bitmap(shingles, SLIM)
                    rows.append((doc_id, key, len(shingles), h1, h2, bitmap(shingles), slim, keys_of, spare))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    kinds = "doc_id bigint, text_key bigint, n_shingles bigint, h1 bigint, h2 bigint, bits binary, slim binary, keys array<bigint>, "
    kinds += "spare map<bigint,bigint>"
    return docs.mapInArrow(describe, kinds)


def _shared(rows: DataFrame) -> DataFrame:
    """The ``(key, row)`` of keys with more than one row, from rows dealt and sorted by key; streams."""
    schema = pa.schema([("key", pa.int64()), ("row", pa.int64())])

    def scan(batches):
        release()
        last = None  # (key, row) that is held back until the next row is known
        told = None  # key of which some row has been put out
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            row = batch.column(1).to_numpy(zero_copy_only=False)
            if last is not None:
                key, row = np.append(last[0], key), np.append(last[1], row)
            if not len(key):
                continue
            same = np.concatenate([[told is not None and key[0] == told], key[1:] == key[:-1]])
            keep = same.copy()
            keep[:-1] |= same[1:]
            if keep[:-1].any():
                yield pa.RecordBatch.from_arrays([pa.array(key[:-1][keep[:-1]]), pa.array(row[:-1][keep[:-1]])], schema=schema)
            last = key[-1:], row[-1:]
            told = key[-1] if same[-1] else None
        if last is not None and told is not None:
            yield pa.RecordBatch.from_arrays([pa.array(last[0]), pa.array(last[1])], schema=schema)

    return rows.mapInArrow(scan, "key bigint, row bigint")


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sizes and bit counts allow an intersection that is large enough."""

    def side(x: str) -> DataFrame:
        return nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))

    def bound(batches):
        release()
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            n, m = (batch.column(k).to_numpy() for k in (2, 3))
            keep = np.zeros(len(n), bool)
            for k, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
                two = folded([x, y])
                p, q = np.bitwise_count(two).sum(axis=1, dtype=np.int64)
                keep[k] = may_link(n[k], m[k], p, q, np.bitwise_count(two[0] & two[1]).sum(dtype=np.int64), percent)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], schema=schema)

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    joined = joined.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return joined.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(bound, "a bigint, b bigint")


def _bounded_pairs(mixed: DataFrame, percent: int, across: bool) -> DataFrame:
    """``(a, b)`` of nodes with the same ``key`` but in different components that size and bit counts allow to link.

    A key's rows are cut into blocks; each pair of blocks is a group of its own, compared as a whole, and only
    the pairs that pass come out.  ``across`` leaves out the pairs of one family.
    """
    blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
    placed = mixed.withColumn("mine", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.withColumns({"lo": F.least("mine", "other"), "hi": F.greatest("mine", "other")})
    placed = placed.select("key", "lo", "hi", "mine", "node", "component", "family", "n", "bits")
    placed = placed.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "mine")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(group: pa.Table):
        mine, node, component, family, n = (group.column(k).to_numpy() for k in ("mine", "node", "component", "family", "n"))
        bits = folded(group.column("bits").to_pylist())
        full = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        lo, hi = (np.flatnonzero(mine == group.column(k)[0].as_py()) for k in ("lo", "hi"))
        found = [np.zeros((0, 2), np.int64)]
        other = bits[hi].T.copy()
        for k in range(0, len(lo), 256):
            part = lo[k : k + 256]
            able = component[part, None] != component[None, hi]
            able &= 100 * np.minimum(n[part, None], n[None, hi]) >= percent * np.maximum(n[part, None], n[None, hi])
            if across:
                able &= family[part, None] != family[None, hi]
            rows, columns = np.flatnonzero(able.any(axis=1)), np.flatnonzero(able.any(axis=0))
            if not len(rows):
                continue
            part, able, against = part[rows], able[np.ix_(rows, columns)], hi[columns]
            both = np.zeros(able.shape, np.int32)
            for w in range(bits.shape[1]):
                both += np.bitwise_count(bits[part, w, None] & other[w, columns][None])
            able &= may_link(n[part, None], n[None, against], full[part, None], full[None, against], both, percent)
            x, y = np.nonzero(able)
            found.append(np.stack([node[part[x]], node[against[y]]], axis=1))
        pairs = np.concatenate(found)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    def scan(batches):
        release()
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            name = np.stack([table.column(k).to_numpy() for k in ("key", "lo", "hi")])
            cuts = np.flatnonzero((name[:, 1:] != name[:, :-1]).any(axis=0)) + 1
            parts = [table.slice(a, b - a) for a, b in zip([0, *cuts], [*cuts, len(table)])]
            for part in parts:
                if held and any(held[-1].column(k)[0] != part.column(k)[0] for k in ("key", "lo", "hi")):
                    yield compare(pa.concat_tables(held))
                    held = []
                held.append(part)
        if held:
            yield compare(pa.concat_tables(held))

    return placed.mapInArrow(scan, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose sets are similar enough."""

    pairs = written(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = nodes.join(ends, "node", "left_semi").select("node", "doc_id", "h2")
    ids = sized(written(wanted.select(F.col("doc_id").alias("wanted")).distinct(), "wanted-documents"))
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")

    def sets(batches):
        release()
        hashes = WordHashes()
        schema = pa.schema([("s1", pa.int64()), ("s2", pa.int64()), ("shingles", pa.binary())])
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for k in range(0, len(texts), 256):
                rows = []
                for text in texts[k : k + 256]:
                    s = shingle_set(text, n, hashes)
                    with np.errstate(over="ignore"):
                        h1, h2 = (int(mix(s + np.uint64(j)).sum(dtype=np.uint64).view(np.int64)) for j in (1, 2))
                    rows.append((h1, h2, s.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    found = texts.select("text").mapInArrow(sets, "s1 bigint, s2 bigint, shingles binary")
    # A doc_id may stand in several rows, so a set is known by its hashes.
    named = nodes.join(ends, "node", "left_semi").select("node", F.col("h1").alias("s1"), F.col("h2").alias("s2"))
    sets_of = written(found.join(named, ["s1", "s2"]).dropDuplicates(["node"]).select("node", "shingles"), "sets")

    def compare(batches):
        release()
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = np.zeros(len(a), bool)
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                p, q = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                both = int((q[at] == p).sum())
                keep[k] = 100 * both >= percent * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], schema=schema)

    def named_set(x: str) -> DataFrame:
        return sets_of.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"))

    both = pairs.join(named_set("b"), "b").join(named_set("a"), "a").select("a", "b", "set_a", "set_b")
    return written(both.mapInArrow(compare, "a bigint, b bigint"), "links")


def ngram_jaccard(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, text_key, group)`` for each row of ``docs(doc_id, text)``.

    Two rows link when their sets of ``n``-word shingles have a Jaccard similarity of at least
    ``percent`` / 100; ``component_id`` is the smallest ``doc_id`` that links reach.  Words are runs without
    ASCII white space, with A-Z in lower case.  A text with fewer words is one shingle; null texts
    and texts without words have no shingle, link with nothing and keep their own ``doc_id``.  Rows that share
    a ``doc_id`` are rows of their own; a null ``doc_id`` takes part but is never the smallest.  Other
    columns are ignored, and an empty table gives no rows.  ``text_key`` is ``xxhash64`` of the text, ``group`` a
    number of the component (null without shingles).
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("text_key"))
    with passing_tables(docs.sparkSession):
        return written(_joined(docs, n, percent), "ngram-components", stays=True)


def _rarest(shared: DataFrame) -> DataFrame:
    """``(key, node, size)`` of the tiles ``(key, node, spare)`` that sets do not leave and that others share."""

    def sized_tiles(rows: DataFrame) -> DataFrame:
        return rows.join(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "key")

    band = F.col("key").bitwiseAND((1 << BAND_BITS) - 1).alias("band")
    often = Window.partitionBy("node", "band").orderBy(F.desc("size"), "key")
    ranked = sized_tiles(shared).withColumn("band", band).withColumn("at", F.row_number().over(often))
    return sized_tiles(ranked.where(F.col("at") > F.col("spare")).select("key", "node"))


def _joined(docs: DataFrame, n: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    path = shared_folder(spark, "shingle-sets")
    full = written(_described(docs, n, percent).withColumn("row", F.monotonically_increasing_id()), "shingle-sets", path, texts=True)
    rows = written(full.select("doc_id", "text_key", "n_shingles", "h1", "h2", "row"), "described-rows")

    # A node stands for all rows with the same set.
    nodes = (
        rows.where("n_shingles > 0")
        .groupBy("h1", "h2")
        .agg(F.min("row").alias("node"), F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
    )
    nodes = written(nodes, "nodes")
    tiles = full.where("keys is not null").select(F.explode("keys").alias("key"), "row")
    shared = written(_shared(tiles.repartition("key").sortWithinPartitions("key")), "shared-rows")
    named = full.where("keys is not null").select("row", "h1", "h2", "spare").join(nodes.select("h1", "h2", "node"), ["h1", "h2"])
    spare = F.col("spare")[F.col("key").bitwiseAND((1 << BAND_BITS) - 1)].alias("spare")
    shared = shared.join(named.select("row", "node", "spare"), "row").select("key", "node", spare)
    members = written(_rarest(written(shared.distinct(), "shared-tiles")), "rarest-tiles")
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    lead = members.join(met, "node").groupBy("key").agg(F.max_by("node", F.struct("met", -F.col("node"))).alias("a"))
    members = written(members.join(lead, "key"), "tiles")

    involved = members.select("node").distinct()
    bits = full.join(involved.withColumnRenamed("node", "row"), "row", "left_semi").select(F.col("row").alias("node"), "bits", "slim")
    described = written(nodes.join(bits, "node"), "described-nodes")
    remove(spark, [path])  # the widest table; nothing below reads it

    # First round: each node with the node that leads most of its tiles.
    often = members.where("node <> a").groupBy("node", "a").agg(F.count(F.lit(1)).alias("times"))
    family = written(often.groupBy("node").agg(F.max_by("a", F.struct("times", -F.col("a"))).alias("a")), "families")
    first = written(family.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), "first-pairs")
    links = _verified(_plausible(first, described, percent), described, docs, n, percent)
    groups = written(connected_components(links), "components")

    # Second round: nodes that share a tile and are not connected yet.  Those led by the same node are a family, which is
    # compared once instead of in each of the tiles it shares; tiles are compared across families only.
    of_node = described.join(groups.select("node", "component"), "node", "left").join(family, "node", "left")
    of_node = of_node.select("node", F.coalesce("component", "node").alias("component"), F.coalesce("a", "node").alias("family"))
    of_node = written(of_node, "placed-nodes")

    def unsettled(rows: DataFrame, spread: str, bits: str) -> DataFrame:
        """Rows of the keys with more than one component and more than one ``spread``, with their bitmaps."""
        ends = [f(c).alias(f"{f.__name__}_{c}") for c in {"component", spread} for f in (F.min, F.max)]
        keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), *ends)
        keys = keys.where(f"min_component < max_component and min_{spread} < max_{spread}").select("key", "size")
        return rows.join(keys, "key").join(described.select("node", "n", F.col(bits).alias("bits")), "node")

    within = unsettled(of_node.withColumn("key", F.col("family")), "component", "bits")
    between = unsettled(written(members.select("key", "node").join(of_node, "node"), "placed-tiles"), "family", "slim")
    # Rows of tiles are many and carry the narrow bitmaps only; their pairs are bounded by the wide ones after that.
    across = written(_bounded_pairs(between, percent, True).join(first, ["a", "b"], "left_anti"), "pairs-across")
    pairs = _bounded_pairs(within, percent, False).union(_plausible(across, described, percent)).distinct()
    more = _verified(pairs.join(first, ["a", "b"], "left_anti"), described, docs, n, percent)
    if not more.isEmpty():
        groups = written(connected_components(links.union(more)), "components")

    # Smallest doc_id of each component, by way of the nodes.
    placed = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = placed.select("h1", "h2", "component").join(smallest, "component").select("h1", "h2", "component_id", "component")
    linked = rows.where("n_shingles > 0").join(of_set, ["h1", "h2"])
    linked = linked.select("doc_id", "n_shingles", "component_id", "text_key", F.col("component").alias("group"))
    none = F.lit(None).cast("bigint").alias("group")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_key", none)
    return linked.union(alone)


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when one of each group does: the smallest ``doc_id``, nulls last.

    Texts without words are no group and all stay.  Of rows with the same ``doc_id`` and text, one stays.
    """
    found = ngram_jaccard(docs, n, percent).where("group is not null").groupBy("group", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("times"))
    found = written(found, "grouped-rows")
    best = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("best"))
    marked = found.join(best, "group").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_key") == F.col("best.text_key")))
    marked = written(marked.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "times", "stays"), "kept-rows")
    key = F.xxhash64(text_or_empty())
    same = F.col("__id").eqNullSafe(F.col("doc_id").cast("bigint")) & (F.col("__key") == key)
    gone = sized(written(marked.where("not stays or times > 1").select("__id", "__key"), "dropped-rows"))
    rows = docs.join(gone, same, "left_anti")
    again = written(marked.where("stays and times > 1").select("__id", "__key"), "repeated-rows")
    if again.isEmpty():
        return rows
    repeated = docs.join(sized(again), same, "left_semi").withColumn("__key", key).dropDuplicates(["doc_id", "__key"])
    return rows.union(repeated.drop("__key"))
