"""Neighbour joins: the k nearest points of each query, and what lies within a fixed distance.

Points are dealt once to the block of their nearest pivot; large blocks are cut into sub-blocks.  A query goes to
the blocks that the triangle inequality cannot rule out, given how far it has to look: for nearest neighbours, up to
the k-th neighbour that it has found so far.  So it sees the blocks around it first, then the next ones, then whatever
that distance still reaches.  A group compares a bounded number of queries with a bounded number of points and
returns at most k rows per query; they are merged by a top-k per query, which combines before it shuffles.

In many dimensions the last step reaches nearly all blocks.  It then deals queries to a few large blocks, each made of
neighbouring ones, so that the copies of a query are as few as the groups allow, and only what is nearer than the
k-th neighbour found so far comes back.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry.functions.vectors import matrix, row_chunks, squared_distances, within
from segmentry.session import materialize

#: Points of a sub-block, and queries of a group.
BLOCK_ROWS, QUERY_ROWS = 8_192, 8_192
#: Pivots at most, and points per pivot below that.
PIVOTS, POINTS_PER_PIVOT = 1_024, 512
#: Blocks that a query sees before those that only its distance decides on.
NEXT_BLOCKS = 16
#: Blocks and groups of queries of the last step hold this share of all rows, and up to so many times the rows above.
SHARE, LARGEST = 16, 4
#: Rows by pivots that are held at once, rows that one batch returns, and distances that a group holds at once.
ROUTE_CELLS, ROUTE_ROWS, GROUP_CELLS = 250_000, 4_096, 1_000_000


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


class Blocks:
    """``points(id, features, ...)`` in blocks around pivots; further columns stay with their point."""

    def __init__(self, points: DataFrame):
        self.rows = points.count()
        wanted = max(1, min(PIVOTS, math.isqrt(self.rows), -(-self.rows // POINTS_PER_PIVOT)))
        picked = points.orderBy(F.xxhash64("id"), "id").limit(wanted).select("features").collect()
        self.pivots = np.unique(np.array([r["features"] for r in picked]), axis=0) if picked else np.zeros((0, 0))
        pivots = self.pivots

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch)
                    block, far = np.empty(len(x), np.int32), np.empty(len(x))
                    for part in row_chunks(len(x), len(pivots), ROUTE_CELLS):
                        d2 = squared_distances(x[part], pivots)
                        block[part], far[part] = d2.argmin(axis=1), np.sqrt(d2.min(axis=1))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block), pa.array(far)], [*batch.schema.names, "block", "far"])

        self.members = materialize(points.mapInArrow(nearest, f"{_columns(points)}, block int, far double"))
        self.sizes, self.radii = np.zeros(len(pivots), np.int64), np.full(len(pivots), -np.inf)
        for r in self.members.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect():
            self.sizes[r["block"]], self.radii[r["block"]] = r["n"], r["radius"]  # a row per pivot

    def large(self, rows: int) -> np.ndarray:
        """Per block the number of the large block that it is part of: neighbouring ones, of about ``rows`` points together."""
        part, left = np.full(len(self.pivots), -1), np.ones(len(self.pivots), bool)
        for number in range(len(self.pivots)):
            if not left.any():
                break
            free = np.flatnonzero(left)
            order = free[np.argsort(squared_distances(self.pivots[free[:1]], self.pivots[free])[0], kind="stable")]
            some = order[: max(1, int(np.searchsorted(np.cumsum(self.sizes[order]), rows, side="right")))]
            part[some], left[some] = number, False
        return part

    def _routed(self, queries: DataFrame, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray], part_of: np.ndarray, again: bool, what: str) -> DataFrame:
        """``queries(id, features, reach)`` with ``block``, once for each that may hold a point within ``reach``.

        ``wanted`` says by a block's rank in nearness to the query, and by the points in nearer blocks, whether it takes part.
        With ``again``, a query that wants any goes to all that are in reach.  ``what`` is "rows", or "counts" for ``(block, n)``,
        or "ids" for the queries that go anywhere.
        """
        pivots, radii, sizes = self.pivots, self.radii, self.sizes

        def pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            x, reach = matrix(batch), batch.column("reach").to_numpy()[:, None]
            # Slack covers rounding: a block too many costs time, one too few a neighbour.
            slack = 1e-6 * (1.0 + np.abs(x).max())
            for part in row_chunks(len(x), len(pivots), ROUTE_CELLS):
                away = np.sqrt(squared_distances(x[part], pivots))
                order = np.argsort(away, axis=1, kind="stable")
                inner = np.cumsum(sizes[order], axis=1) - sizes[order]
                rank, before = np.empty_like(order), np.empty_like(order)
                np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :].repeat(len(away), 0), axis=1)
                np.put_along_axis(before, order, inner, axis=1)
                within_reach = (away - radii[None, :] <= reach[part] + slack) & (sizes > 0)
                taking = within_reach & wanted(rank, before)
                rows, blocks = np.nonzero(within_reach & taking.any(axis=1)[:, None] if again else taking)
                rows, blocks = np.divmod(np.unique(rows * len(pivots) + part_of[blocks]), len(pivots))
                yield rows + part.start, blocks.astype(np.int32)

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows and len(pivots):
                    for rows, blocks in pairs(batch):
                        for at in range(0, len(rows), ROUTE_ROWS):
                            some = batch.take(pa.array(rows[at : at + ROUTE_ROWS]))
                            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(blocks[at : at + ROUTE_ROWS])], [*names, "block"])

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = np.zeros(len(pivots), np.int64)
            for batch in batches:
                if batch.num_rows and len(pivots):
                    for _, blocks in pairs(batch):
                        asked += np.bincount(blocks, minlength=len(pivots))
            used = np.flatnonzero(asked)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(asked[used])], ["block", "n"])

        def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows and len(pivots):
                    for rows, _ in pairs(batch):
                        yield batch.select(["id"]).take(pa.array(np.unique(rows)))

        queries = queries.select("id", "features", "reach")
        names, id_type = queries.columns, dict(queries.dtypes)["id"]
        schema = {"rows": f"{_columns(queries)}, block int", "counts": "block int, n bigint", "ids": f"id {id_type}"}
        return queries.mapInArrow({"rows": route, "counts": count, "ids": ids}[what], schema[what])

    def going(self, queries: DataFrame, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
        """``id`` of the queries that want a block within their reach."""
        return self._routed(queries, wanted, np.arange(len(self.pivots)), False, "ids")

    def meet(
        self, queries: DataFrame, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray], compare: Callable[[pa.Table, pa.Table], pa.Table], schema: str, asked_rows: int | None = None
    ) -> DataFrame:
        """``compare(queries, points)`` of every block's queries with its points, a bounded number of each at a time.

        With ``asked_rows``, the number of queries, blocks are large ones, and a query that wants any goes to all in its reach.
        """
        points_each, queries_each, part_of = BLOCK_ROWS, QUERY_ROWS, np.arange(len(self.pivots))
        again = asked_rows is not None
        if again:
            points_each, queries_each = (min(max(n // SHARE, least), LARGEST * least) for n, least in ((self.rows, BLOCK_ROWS), (asked_rows, QUERY_ROWS)))
            part_of = self.large(points_each)
        sizes = np.bincount(part_of, self.sizes, len(part_of)).astype(np.int64)
        counts = self._routed(queries, wanted, part_of, again, "counts").groupBy("block").agg(F.sum("n").alias("n")).collect()  # a row per pivot
        cuts = {r["block"]: (-(-int(sizes[r["block"]]) // points_each), -(-r["n"] // queries_each)) for r in counts}
        spark, cut = self.members.sparkSession, "block int, n_s int, n_t int"
        of_query = F.broadcast(spark.createDataFrame([(b, *c) for b, c in cuts.items()], cut))
        parts = [(i, b, *cuts[b]) for i, b in enumerate(part_of.tolist()) if b in cuts]
        of_point = F.broadcast(spark.createDataFrame(parts, f"_block int, {cut}"))
        members = self.members.withColumnRenamed("block", "_block").join(of_point, "_block").withColumn("reach", F.lit(None).cast("double"))
        routed = self._routed(queries, wanted, part_of, again, "rows").join(of_query, "block")
        none = [c for c in self.members.columns if c not in ("id", "features", "block", "far")]

        def dealt(rows: DataFrame, role: str, own: str, over: str) -> DataFrame:
            mine = F.pmod(F.xxhash64("id", F.lit(3)), F.col(f"n_{own}")).cast("int").alias(own)
            every = F.explode(F.sequence(F.lit(0), F.col(f"n_{over}") - 1)).alias(over)
            kinds = dict(self.members.dtypes)
            extra = [F.col(c) if role == "point" else F.lit(None).cast(kinds[c]).alias(c) for c in none]
            return rows.select("block", F.lit(role).alias("role"), "id", "features", "reach", *extra, mine, every)

        def group(rows: pa.Table) -> pa.Table:
            role = rows.column("role").to_numpy(zero_copy_only=False)
            queries, points = (rows.filter(pa.array(role == name)).combine_chunks() for name in ("query", "point"))
            return compare(queries, points)

        both = dealt(members, "point", "s", "t").unionByName(dealt(routed, "query", "t", "s"))
        return both.groupBy("block", "s", "t").applyInArrow(group, schema)


def _features(rows: pa.Table) -> np.ndarray:
    return matrix(rows.to_batches()[0]) if len(rows) else np.zeros((0, 0))


def _nearest(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Per query the ``k`` nearest of the points, itself excluded, by squared distance and then id."""

    def compare(queries: pa.Table, points: pa.Table) -> pa.Table:
        ids, others = (t.column("id").to_numpy(zero_copy_only=False) for t in (queries, points))
        found = []
        if len(ids) and len(others):
            x, y = _features(queries), _features(points)
            at = min(k + 1, len(y)) - 1  # one more, as a query may be among the points
            reach = queries.column("reach").to_numpy() ** 2
            shift, largest = y.mean(axis=0), (y**2).sum(axis=1).max()
            moved = y - shift
            norms = (moved**2).sum(axis=1)
            for part in row_chunks(len(x), len(y), GROUP_CELLS):
                near = x[part] - shift
                d2 = (near**2).sum(axis=1)[:, None] + norms[None, :] - 2.0 * (near @ moved.T)
                # What is farther than the k-th neighbour so far is not looked at again.
                kth, new = reach[part].copy(), np.flatnonzero(np.isinf(reach[part]))
                if len(new):
                    kth[new] = np.partition(d2[new], at, axis=1)[:, at]
                scale = (x[part] ** 2).sum(axis=1) + largest
                row, column = np.nonzero(d2 <= (np.maximum(kth, 0.0) + 1e-9 * scale)[:, None])
                row = row + part.start
                own = ids[row] == others[column]
                row, column = row[~own], column[~own]
                exact = np.empty(len(row))
                for p in range(0, len(row), 100_000):
                    some = slice(p, p + 100_000)
                    exact[some] = ((x[row[some]] - y[column[some]]) ** 2).sum(axis=1)
                order = np.lexsort((others[column], exact, row))
                row, column, exact = row[order], column[order], exact[order]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                found.append((ids[row[keep]], others[column[keep]], exact[keep]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [ids[:0], others[:0], np.zeros(0)]
        return pa.table(columns, names=["id", "neighbour", "d2"])

    return compare


def knn_edges(points: DataFrame, k: int = 10, queries: DataFrame | None = None) -> DataFrame:
    """``(id, neighbour, rank, distance)``: the ``k`` points nearest to each of ``queries(id, features)``, exactly.

    A query's own id is not its neighbour; ties go to the smaller id.  Without ``queries``, every point is one.  With
    no more than ``k`` other points, all of them are its neighbours.
    """
    blocks = Blocks(points.select("id", "features"))
    id_type = dict(points.dtypes)["id"]
    asked = materialize((points if queries is None else queries).select("id", "features"))
    infinite = F.lit(float("inf"))
    best = Window.partitionBy("id").orderBy("d2", "neighbour")
    # Enough nearer blocks to have k neighbours; then the next ones; then all that are still in reach.
    steps = [
        lambda rank, before: before < k + 1,
        lambda rank, before: (before >= k + 1) & (rank < NEXT_BLOCKS),
        lambda rank, before: (before >= k + 1) & (rank >= NEXT_BLOCKS),
    ]
    found = None
    for step, wanted in enumerate(steps):
        if step and len(blocks.pivots) <= (1, NEXT_BLOCKS)[step - 1]:
            break
        looking, last = asked.withColumn("reach", infinite), step == 2
        if found is not None:
            full = found.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.sqrt(F.max("d2"))).alias("reach"))
            looking = materialize(asked.join(full, "id", "left").withColumn("reach", F.coalesce("reach", infinite)))
        met = blocks.meet(looking, wanted, _nearest(k), f"id {id_type}, neighbour {id_type}, d2 double", asked.count() if last else None)
        if last:  # who goes on sees all in reach again
            found = found.join(blocks.going(looking, wanted).distinct(), "id", "left_anti")
        met = met if found is None else found.select("id", "neighbour", "d2").union(met)
        found = materialize(met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
    return found.select("id", "neighbour", "rank", F.sqrt("d2").alias("distance"))


def lowest_within(points: DataFrame, queries: DataFrame, eps: float, value: str) -> DataFrame:
    """``(id, value)``: the lowest ``value`` of the points within ``eps`` of each query that has any."""
    id_type, kind = dict(queries.dtypes)["id"], dict(points.dtypes)[value]

    def compare(asked: pa.Table, some: pa.Table) -> pa.Table:
        ids, values = asked.column("id"), some.column(value).to_numpy(zero_copy_only=False)
        low = np.full(len(ids), np.iinfo(np.int64).max)
        if len(ids) and len(values):
            x, y = _features(asked), _features(some)
            for part in row_chunks(len(x), len(y)):
                low[part] = np.where(within(x[part], y, eps), values[None, :], low.max()).min(axis=1)
        hit = low < np.iinfo(np.int64).max
        return pa.table([ids.filter(pa.array(hit)), pa.array(low[hit]).cast(pa.int32() if kind == "int" else pa.int64())], names=["id", value])

    blocks = Blocks(points.select("id", "features", value))
    looking = queries.select("id", "features").withColumn("reach", F.lit(float(eps)))
    if not blocks.rows:
        return queries.select("id", F.lit(None).cast(kind).alias(value)).limit(0)
    met = blocks.meet(looking, lambda rank, before: rank >= 0, compare, f"id {id_type}, {value} {kind}")
    return met.groupBy("id").agg(F.min(value).alias(value))
