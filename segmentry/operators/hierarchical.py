"""Hierarchical clustering: from the top down by bisecting K-means, from the bottom up in rounds of merges."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions.graph import connected_components
from segmentry.functions.vectors import list_array, matrix, squared_distance
from segmentry.operators.neighbours import _nearest, knn_edges
from segmentry.session import RoundTables, materialize

LINKAGES = ("ward", "average", "complete", "single")
#: Neighbours that a point may merge with.
NEIGHBOURS = 10
#: So few clusters, with so many edges at most, go through all rounds that are left in one task.
LAST_CLUSTERS, LAST_EDGES = 4_096, 262_144


def fit_bisecting(df: DataFrame, k: int = settings.DEFAULT_K, seed: int = settings.SEED) -> BisectingKMeansModel:
    """Spark ML's tree of splits over ``(id, features)``."""
    rows = df.select(array_to_vector("features").alias("_vector")).persist()
    try:
        return BisectingKMeans(k=k, seed=seed, featuresCol="_vector", predictionCol="cluster").fit(rows)
    finally:
        rows.unpersist()


def predict_bisecting(model: BisectingKMeansModel, df: DataFrame) -> DataFrame:
    """``(id, cluster)``."""
    rows = df.withColumn("_vector", array_to_vector("features"))
    model = model.copy().setFeaturesCol("_vector").setPredictionCol("cluster")
    return model.transform(rows).select("id", F.col("cluster").cast("int").alias("cluster"))


def bisecting(df: DataFrame, k: int = settings.DEFAULT_K, seed: int = settings.SEED) -> DataFrame:
    """``(id, cluster)`` by top-down bisecting K-means."""
    return predict_bisecting(fit_bisecting(df, k, seed), df)


def _ward(n_a: str, n_b: str, a: str, b: str) -> Column:
    """How far a merge of two clusters is, by the growth of squared distances to the centre; of two points, their distance."""
    grown = 2 * F.col(n_a) * F.col(n_b) / (F.col(n_a) + F.col(n_b))
    return F.sqrt(grown * squared_distance(F.col(a), F.col(b)))


def _graph(points: DataFrame, neighbours: int) -> DataFrame:
    """``(a, b, low, high, total, n)``: undirected edges of the nearest-neighbour graph."""
    edges = knn_edges(points, neighbours).select(F.least("id", "neighbour").alias("a"), F.greatest("id", "neighbour").alias("b"), "distance")
    d = F.col("distance")
    return edges.distinct().select("a", "b", d.alias("low"), d.alias("high"), d.alias("total"), F.lit(1).cast("bigint").alias("n"))


def merge_rounds(points: DataFrame, linkage: str = "ward", neighbours: int = NEIGHBOURS) -> DataFrame:
    """The dendrogram of ``(id, features)`` as a table ``(round, kept, gone, height, size)``, one row per merge.

    Clusters may merge if a nearest-neighbour edge joins them, as points of a connectivity graph do.  In each round, every two
    clusters that are nearest to each other merge, which for these linkages comes to the same tree as one
    merge at a time: the ids of both ends are replaced, and edges that fall together are aggregated (``single``
    the least, ``complete`` the greatest, ``average`` the mean distance; ``ward`` goes by sizes and centres).  When no edge
    is left, the centres of what remains make the next graph, until one cluster is left.  A cluster is named by its
    smallest id.  ``height`` never falls on the way up: a merge is at least as high as those below it.
    """
    if linkage not in LINKAGES:
        raise ValueError(f"Unknown linkage: {linkage}")
    none = [F.lit(0).alias("round"), F.col("id").alias("kept"), F.col("id").alias("gone"), F.lit(0.0).alias("height"), F.lit(1).cast("bigint").alias("size")]
    every = points.select(*none).limit(0)
    with RoundTables(points.sparkSession, "merges") as tables:
        for some in _rounds(points, linkage, neighbours, tables):
            every = every.union(some)
        return materialize(every)


def _rounds(points: DataFrame, linkage: str, neighbours: int, tables: RoundTables) -> Iterator[DataFrame]:
    clusters = tables.write(
        points.select(F.col("id").alias("cluster"), F.lit(1).cast("bigint").alias("size"), F.col("features").alias("centre"), F.lit(0.0).alias("height"))
    )
    left, edges, number = clusters.count(), None, 0
    measure = {"single": F.col("low"), "complete": F.col("high"), "average": F.col("total") / F.col("n")}
    kind, vector = (dict(clusters.dtypes)[c] for c in ("cluster", "centre"))
    while left > 1:
        if left <= LAST_CLUSTERS and (edges is None or edges.count() <= LAST_EDGES) and clusters.agg(F.count_distinct("cluster")).first()[0] == left:
            none = {"a": kind, "b": kind, "low": "double", "high": "double", "total": "double", "n": "bigint"}
            rows = clusters.select("*", *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
            if edges is not None:
                no_cluster = {"cluster": kind, "size": "bigint", "centre": vector, "height": "double"}
                rows = rows.unionByName(edges.select(*(F.lit(None).cast(t).alias(c) for c, t in no_cluster.items()), *none))
            schema = f"round int, kept {kind}, gone {kind}, height double, size bigint"
            yield tables.write(rows.groupBy(F.lit(0).alias("all")).applyInArrow(_last_rounds(linkage, neighbours, number), schema))
            return
        if edges is None:
            edges = tables.write(_graph(clusters.select(F.col("cluster").alias("id"), F.col("centre").alias("features")), neighbours))
        if linkage == "ward":
            sides = [clusters.select(F.col("cluster").alias(x), F.col("size").alias(f"n_{x}"), F.col("centre").alias(f"c_{x}")) for x in "ab"]
            near = edges.select("a", "b").join(sides[0], "a").join(sides[1], "b").select("a", "b", _ward("n_a", "n_b", "c_a", "c_b").alias("d"))
        else:
            near = edges.select("a", "b", measure[linkage].alias("d"))
        # One order of all edges, so that the first of any group of edges is nearest for both of its ends.
        first = F.min(F.struct("d", "a", "b")).alias("e")
        of_end = near.select("*", F.explode(F.array("a", "b")).alias("end")).groupBy("end").agg(first)
        mutual = of_end.groupBy("e.a", "e.b", "e.d").agg(F.count(F.lit(1)).alias("ends")).where("ends = 2")
        sides = [clusters.select(F.col("cluster").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("size", "centre", "height"))) for x in "ab"]
        number += 1
        merges = mutual.join(sides[0], "a").join(sides[1], "b")
        size = F.col("size_a") + F.col("size_b")
        mean = F.zip_with("centre_a", "centre_b", lambda x, y: (x * F.col("size_a") + y * F.col("size_b")) / size)
        merges = merges.select(
            F.lit(number).alias("round"), F.col("a").alias("kept"), F.col("b").alias("gone"), F.greatest("d", "height_a", "height_b").alias("height"), size.alias("size"), mean.alias("centre")
        )
        merges = tables.write(merges)
        yield merges.drop("centre")
        touched = merges.select(F.explode(F.array("kept", "gone")).alias("cluster"))
        grown = merges.select(F.col("kept").alias("cluster"), "size", "centre", "height")
        clusters = tables.write(clusters.join(touched, "cluster", "left_anti").union(grown))
        left = clusters.count()
        for x in "ab":
            renamed = merges.select(F.col("gone").alias(x), F.col("kept").alias("_kept"))
            edges = edges.join(renamed, x, "left").withColumn(x, F.coalesce("_kept", x)).drop("_kept")
        ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
        joined = [F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.sum("n").alias("n")]
        edges = tables.write(edges.where("a <> b").groupBy(*ends).agg(*joined))
        if edges.isEmpty():
            edges = None


def _last_rounds(linkage: str, neighbours: int, number: int) -> Callable[[pa.Table], pa.Table]:
    """The rounds of ``_rounds`` after round ``number``, over clusters and edges that fit one task."""

    def nearest_edges(alive: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, ...]:
        reach = pa.array(np.full(len(alive), np.inf))
        rows = pa.table([pa.array(alive), list_array(centre[alive]), reach], ["id", "features", "reach"])
        found = _nearest(neighbours)(rows, rows)
        i, j, d = (found.column(c).to_numpy() for c in ("id", "neighbour", "d2"))
        return joined(np.minimum(i, j), np.maximum(i, j), np.sqrt(d), np.sqrt(d), None, None, len(centre))

    def joined(a, b, low, high, total, n, ids: int) -> tuple[np.ndarray, ...]:
        """Edges between the same ends as one; those of a new graph come from either end."""
        if not len(a):
            return a, b, low, high, low, np.zeros(0, np.int64)
        order = np.argsort(a * ids + b, kind="stable")
        keys, first = np.unique((a * ids + b)[order], return_index=True)
        low, high = np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)
        if total is None:
            total, n = low, np.ones(len(keys), np.int64)
        else:
            total, n = np.add.reduceat(total[order], first), np.add.reduceat(n[order], first)
        return keys // ids, keys % ids, low, high, total, n

    def rounds(rows: pa.Table) -> pa.Table:
        is_cluster = rows.column("cluster").is_valid()
        some, links = rows.filter(is_cluster).combine_chunks(), rows.filter(pc.invert(is_cluster))
        # Numbers in the order of the ids stand for them.
        ids = np.sort(some.column("cluster").to_numpy())
        at = np.argsort(some.column("cluster").to_numpy(), kind="stable")
        size, height = some.column("size").to_numpy()[at], some.column("height").to_numpy()[at]
        centre, alive = matrix(some.to_batches()[0], "centre")[at], np.arange(len(ids))
        a, b = (np.searchsorted(ids, links.column(c).to_numpy()) for c in "ab")
        low, high, total, n = (links.column(c).to_numpy() for c in ("low", "high", "total", "n"))
        made, now = [], number
        while len(alive) > 1:
            if not len(a):
                a, b, low, high, total, n = nearest_edges(alive, centre)
            if linkage == "ward":
                gap = (centre[a] - centre[b]) ** 2
                d = np.sqrt(2 * size[a] * size[b] / (size[a] + size[b]) * np.cumsum(gap, axis=1)[:, -1])
            else:
                d = {"single": low, "complete": high, "average": total / n}[linkage]
            order = np.lexsort((b, a, d))
            rank = np.empty(len(a), np.int64)
            rank[order] = np.arange(len(a))
            best = np.full(len(ids), len(a))
            np.minimum.at(best, a, rank)
            np.minimum.at(best, b, rank)
            both = np.flatnonzero((best[a] == rank) & (best[b] == rank))
            kept, gone, now = a[both], b[both], now + 1
            whole = size[kept] + size[gone]
            centre[kept] = (centre[kept] * size[kept, None] + centre[gone] * size[gone, None]) / whole[:, None]
            height[kept] = np.maximum(d[both], np.maximum(height[kept], height[gone]))
            size[kept] = whole
            made.append((np.full(len(both), now), kept, gone, height[kept], whole))
            alive = np.setdiff1d(alive, gone)
            to = np.arange(len(ids))
            to[gone] = kept
            a, b = np.minimum(to[a], to[b]), np.maximum(to[a], to[b])
            apart = a != b
            a, b, low, high, total, n = joined(*(v[apart] for v in (a, b, low, high, total, n)), len(ids))
        step, kept, gone, high, whole = (np.concatenate(c) for c in zip(*made))
        columns = [pa.array(step.astype(np.int32)), pa.array(ids[kept]), pa.array(ids[gone]), pa.array(high), pa.array(whole)]
        return pa.table(columns, ["round", "kept", "gone", "height", "size"])

    return rounds


def cut(points: DataFrame, merges: DataFrame, k: int) -> DataFrame:
    """``(id, cluster)``: the ``k`` clusters that are left without the ``k - 1`` highest merges, numbered by smallest id."""
    highest = merges.orderBy(F.desc("height"), F.desc("round"), F.desc("kept")).limit(k - 1).select("gone")
    kept = merges.join(F.broadcast(highest), "gone", "left_anti").select(F.col("kept").alias("a"), F.col("gone").alias("b"))
    alone = points.select(F.col("id").alias("a"), F.col("id").alias("b"))
    groups = materialize(connected_components(kept.union(alone)))
    numbers = groups.select("component").distinct().withColumn("cluster", F.row_number().over(Window.orderBy("component")) - 1)  # k rows
    return groups.join(F.broadcast(numbers), "component").select(F.col("node").alias("id"), F.col("cluster").cast("int").alias("cluster"))


def agglomerative(df: DataFrame, k: int = settings.DEFAULT_K, linkage: str = "ward", neighbours: int = NEIGHBOURS) -> DataFrame:
    """``(id, cluster)`` by bottom-up clustering on the nearest-neighbour graph, cut at ``k`` clusters."""
    points = df.select("id", "features")
    return cut(points, merge_rounds(points, linkage, neighbours), k)
