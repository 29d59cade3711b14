"""K-means for many settings at once.

A K sweep with restarts, or a bootstrap study, is dozens of K-means fits over
the same rows.  Here every pass over the cached rows advances all of them: the
centres of every running model go out with the pass, each task returns weighted
sums per (model, centre), and those are added up by key.  One sweep costs as
many passes as its slowest model, not the sum over models.  The rows are cached
as NumPy blocks, so a pass is a job without a plan of its own to be made.

Random draws are functions of a hash of the row id, so results do not depend on
the partitioning (beyond the order of floating-point sums).
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions.vectors import matrix, squared_distances, uniforms, vector_size
from segmentry.session import gathered, materialize


@dataclass(frozen=True)
class Spec:
    """One fit: ``k`` centres from ``seed``; ``bootstrap`` >= 0 resamples the rows."""

    k: int
    seed: int = settings.SEED
    bootstrap: int = -1


@dataclass(frozen=True)
class KMeansFit:
    spec: Spec
    centers: np.ndarray
    cost: float = float("nan")
    iterations: int = 0

    def assign(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        return assign(df, {out: self.centers})

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, [float(v) for v in c], self.cost, self.iterations, self.spec.seed) for i, c in enumerate(self.centers)]
        schema = "cluster int, centre array<double>, cost double, iterations int, seed bigint"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> KMeansFit:
        rows = spark.read.parquet(path).orderBy("cluster").collect()
        centers = np.array([r["centre"] for r in rows])
        return KMeansFit(Spec(len(rows), rows[0]["seed"]), centers, rows[0]["cost"], rows[0]["iterations"])


#: Keys that one task adds up where several tasks return sums.
KEYS_PER_TASK = 512


@dataclass
class _Points:
    """``(id, hash, features)`` rows and their cached ``(hashes, matrix)`` blocks, with size, mean variance and number of partitions."""

    df: DataFrame
    blocks: RDD
    dims: int
    rows: int
    variance: float
    parts: int


def _prepare(df: DataFrame) -> _Points:
    spread = df.select("id", F.xxhash64("id").alias("hash"), "features").persist()
    dims = vector_size(spread)
    vector = array_to_vector("features")
    stats = spread.agg(Summarizer.metrics("variance", "count").summary(vector).alias("s")).select("s.*").first()
    # A checkpoint, so that no pass plans the steps behind the rows again.
    points = materialize(gathered(spread, stats["count"]))
    spread.unpersist()
    blocks = cached_blocks(points)
    return _Points(points, blocks, dims, stats["count"], float(np.mean(stats["variance"].toArray())), blocks.getNumPartitions())


def cached_blocks(points: DataFrame) -> RDD:
    """``(hash, features)`` rows as cached ``(hashes, matrix)`` blocks."""
    return points.mapInArrow(_packed, "hashes binary, features binary").rdd.map(_unpacked).persist(StorageLevel.MEMORY_AND_DISK)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch of rows as one row of bytes."""
    for batch in batches:
        if batch.num_rows:
            parts = batch.column("hash").to_numpy().tobytes(), np.ascontiguousarray(matrix(batch)).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in parts], names=["hashes", "features"])


def _unpacked(row) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.frombuffer(row["hashes"], np.int64)
    return hashes, np.frombuffer(row["features"], np.float64).reshape(len(hashes), -1)


def _added_up(points: _Points, partial: RDD, add, keys: int) -> list:
    """What the tasks return, ``add``-ed by key on the executors; one task's is reduced already."""
    if points.parts > 1:
        partial = partial.reduceByKey(add, min(points.parts, -(-keys // KEYS_PER_TASK)))
    return partial.collect()


def poisson_weights(hashes: np.ndarray, bootstrap: int, rate: float = settings.BOOTSTRAP_FRACTION) -> np.ndarray:
    """How often each row enters a resample with replacement of ``rate`` times the rows."""
    u, weight = uniforms(hashes, 7919, bootstrap), np.zeros(len(hashes))
    term = total = np.exp(-rate)
    for count in range(1, 40):
        more = u > total
        if not more.any():
            break
        weight[more] = count
        term *= rate / count
        total += term
    return weight


def _weights(hashes: np.ndarray, specs) -> dict[int, np.ndarray]:
    """Row weights per bootstrap number in use."""
    numbers = {s.bootstrap for s in specs}
    return {b: poisson_weights(hashes, b) if b >= 0 else np.ones(len(hashes)) for b in numbers}


def _seed_centers(points: _Points, streams: list[Spec]) -> dict[tuple[int, int], np.ndarray]:
    """Greedy k-means++ centres of every (seed, bootstrap) stream, one pass per centre.

    Drawing a row with probability proportional to weight x squared distance is
    an exponential race: the smallest ``-log(u) / (w d2)`` wins, which is a plain
    minimum and needs no running totals.  Each step tries a few drawn candidates
    and keeps the one that leaves the least total distance.  A pass measures that
    for every candidate and also draws the next ones as if it were chosen.
    """
    chosen: list[list[np.ndarray]] = [[] for _ in streams]
    tried: list[list[np.ndarray]] = [[] for _ in streams]
    trials, dims = [2 + int(np.log(s.k)) for s in streams], points.dims
    for step in range(max(s.k for s in streams) + 1):
        # Step 0 draws the first centre; step 1 draws candidates for the second.
        live = [i for i, s in enumerate(streams) if len(chosen[i]) < s.k and (step < 2 or tried[i])]
        if not live:
            break
        options = {i: [[*chosen[i], c] for c in tried[i]] or [list(chosen[i])] for i in live}
        drawn = {i: 1 if step == 0 else trials[i] for i in live}

        def race(blocks: Iterator[tuple[np.ndarray, np.ndarray]], options=options, drawn=drawn, step=step) -> Iterator[tuple]:
            best: dict[tuple[int, int, int], tuple[float, np.ndarray]] = {}
            left: dict[tuple[int, int], float] = {}
            for hashes, x in blocks:
                weights = _weights(hashes, [streams[i] for i in options])
                for i, sets in options.items():
                    s = streams[i]
                    draws = [-np.log(uniforms(hashes, s.seed, s.bootstrap + 1, step, j)) for j in range(drawn[i])]
                    for o, centers in enumerate(sets):
                        mass = weights[s.bootstrap]
                        if centers:
                            mass = mass * squared_distances(x, np.array(centers)).min(axis=1)
                        left[i, o] = left.get((i, o), 0.0) + float(mass.sum())
                        with np.errstate(divide="ignore", invalid="ignore"):
                            keys = [np.where(mass > 1e-12, draw / mass, np.inf) for draw in draws]
                        for j, key in enumerate(keys):
                            at = int(key.argmin())
                            if key[at] < best.get((i, o, j), (np.inf, None))[0]:
                                best[i, o, j] = float(key[at]), x[at].copy()
            # A first draw always goes out, as it carries the distance left.
            best |= {(i, o, 0): (np.inf, np.zeros(dims)) for i, o in left if (i, o, 0) not in best}
            for (i, o, j), (key, row) in best.items():
                yield (i, o, j), (key, left[i, o] if j == 0 else 0.0, row)

        def nearer(a: tuple, b: tuple) -> tuple:
            first = a if a[0] <= b[0] else b
            return first[0], a[1] + b[1], first[2]

        partial = points.blocks.mapPartitions(race)
        keys = sum(len(sets) * drawn[i] for i, sets in options.items())
        won: dict[tuple[int, int, int], tuple[float, np.ndarray]] = {}
        total: dict[int, dict[int, float]] = {i: {} for i in live}
        for at, (key, left, row) in _added_up(points, partial, nearer, keys):
            if key < np.inf:
                won[at] = key, row
            sums = total[at[0]]
            sums[at[1]] = sums.get(at[1], 0.0) + left
        for i in live:
            keep = min(total[i], key=lambda o: (total[i][o], o))
            if tried[i]:
                chosen[i].append(tried[i][keep])
            found = [won[i, keep, j][1] for j in range(drawn[i]) if (i, keep, j) in won]
            if step == 0:
                chosen[i] = found
            else:
                tried[i] = found
    return {(s.seed, s.bootstrap): np.array(c) for s, c in zip(streams, chosen)}


def _lloyd_sums(points: _Points, specs: list[Spec], centers: list[np.ndarray]):
    """Per (model, centre): weight, cost and vector sum of the rows nearest to it."""
    starts = np.cumsum([0, *[len(c) for c in centers]])
    stacked = np.vstack(centers)

    def step(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        weight = np.zeros(len(stacked))
        cost = np.zeros(len(stacked))
        total = np.zeros_like(stacked)
        for hashes, x in blocks:
            row_weights = _weights(hashes, specs)
            d2 = squared_distances(x, stacked)
            every = np.arange(len(x))
            for m, spec in enumerate(specs):
                block = slice(starts[m], starts[m + 1])
                nearest = d2[:, block].argmin(axis=1)
                w = row_weights[spec.bootstrap]
                cost[block] += np.bincount(nearest, w * d2[every, nearest + starts[m]], starts[m + 1] - starts[m])
                weight[block] += np.bincount(nearest, w, starts[m + 1] - starts[m])
                # Sums of the rows in order of their centre.
                order = np.argsort(nearest, kind="stable")
                used, first = np.unique(nearest[order], return_index=True)
                total[used + starts[m]] += np.add.reduceat(x[order] * w[order, None], first, axis=0)
        used = np.nonzero(weight)[0]
        yield from zip(used.tolist(), np.column_stack([weight[used], cost[used], total[used]]))

    # Added up on the executors: one row per centre comes back, as one task returns it anyway.
    weight, cost, total = np.zeros(len(stacked)), np.zeros(len(stacked)), np.zeros_like(stacked)
    for at, sums in _added_up(points, points.blocks.mapPartitions(step), operator.add, len(stacked)):
        weight[at], cost[at], total[at] = sums[0], sums[1], sums[2:]
    return [(weight[a:b], cost[a:b], total[a:b]) for a, b in zip(starts[:-1], starts[1:])]


def fit_many(
    df: DataFrame, specs: list[Spec], max_iter: int = settings.MAX_ITER, tol: float = settings.TOL
) -> list[KMeansFit]:
    """Fit every spec over ``(id, features)``; results come back in order.

    A stream's k-means++ draw for the largest K starts with its draws for the
    smaller ones, so K values share the seeding passes.  Iteration stops per
    model once its centres move by at most ``tol`` times the mean variance.
    """
    points = _prepare(df)
    try:
        widest: dict[tuple[int, int], Spec] = {}
        for s in specs:
            at = (s.seed, s.bootstrap)
            if at not in widest or s.k > widest[at].k:
                widest[at] = s
        seeds = _seed_centers(points, list(widest.values()))
        fits = [KMeansFit(s, seeds[s.seed, s.bootstrap][: s.k]) for s in specs]
        running, limit = list(range(len(fits))), tol * points.variance
        for _ in range(max_iter):
            if not running:
                break
            sums = _lloyd_sums(points, [specs[i] for i in running], [fits[i].centers for i in running])
            moving = []
            for i, (weight, _, total) in zip(running, sums):
                old = fits[i].centers
                new = np.where(weight[:, None] > 0, total / np.maximum(weight, 1e-300)[:, None], old)
                fits[i] = replace(fits[i], centers=new, iterations=fits[i].iterations + 1)
                if ((new - old) ** 2).sum() > limit:
                    moving.append(i)
            running = moving
        final = _lloyd_sums(points, specs, [f.centers for f in fits])
        return [replace(f, cost=float(cost.sum())) for f, (_, cost, _) in zip(fits, final)]
    finally:
        points.blocks.unpersist()


def lloyd(df: DataFrame, centers: np.ndarray, steps: int) -> KMeansFit:
    """A fixed number of steps from given centres; an empty cluster keeps its centre."""
    points, spec = _prepare(df), Spec(len(centers), settings.SEED)
    fit = KMeansFit(spec, np.asarray(centers, float))
    try:
        for _ in range(steps):
            ((weight, _, total),) = _lloyd_sums(points, [spec], [fit.centers])
            moved = np.where(weight[:, None] > 0, total / np.maximum(weight, 1e-300)[:, None], fit.centers)
            fit = replace(fit, centers=moved, iterations=fit.iterations + 1)
        ((_, cost, _),) = _lloyd_sums(points, [spec], [fit.centers])
        return replace(fit, cost=float(cost.sum()))
    finally:
        points.blocks.unpersist()


def best_of(fits: list[KMeansFit]) -> KMeansFit:
    return min(fits, key=lambda f: f.cost)


def kmeans(df: DataFrame, k: int = settings.DEFAULT_K, n_init: int = settings.N_INIT, seed: int = settings.SEED, **options) -> KMeansFit:
    """The cheapest of ``n_init`` k-means++ starts."""
    return best_of(fit_many(df, [Spec(k, seed + i) for i in range(n_init)], **options))


def sweep(df: DataFrame, k_range: list[int], n_init: int = settings.N_INIT, seed: int = settings.SEED, **options) -> dict[int, KMeansFit]:
    """Best fit for every K, all K and starts in the same passes."""
    return best_of_every_k(fit_many(df, sweep_specs(k_range, n_init, seed), **options), k_range)


def sweep_specs(k_range: list[int], n_init: int = settings.N_INIT, seed: int = settings.SEED) -> list[Spec]:
    return [Spec(k, seed + i) for k in k_range for i in range(n_init)]


def best_of_every_k(fits: list[KMeansFit], k_range: list[int]) -> dict[int, KMeansFit]:
    return {k: best_of([f for f in fits if f.spec.k == k]) for k in k_range}


def assign(df: DataFrame, centers: dict[str, np.ndarray]) -> DataFrame:
    """Add the index of the nearest centre, one int column per entry of ``centers``."""
    names, tables = list(centers), list(centers.values())

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch)
            labels = [pa.array(squared_distances(x, c).argmin(axis=1).astype(np.int32)) for c in tables]
            yield pa.RecordBatch.from_arrays([*batch.columns, *labels], names=[*batch.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(nearest, f"{schema}, " + ", ".join(f"`{n}` int" for n in names))
