"""DBSCAN with exact neighbourhoods, spread by distance to pivots.

Every point has one home block, that of its nearest pivot.  A block also gets
the points of other blocks that the triangle inequality cannot rule out as
neighbours of its own, so all neighbours of a home point are present.  Blocks
with many points are cut into sub-blocks, so no task holds more than a bounded
number of rows.  Groups return neighbour counts and the edges of a star per
local component, never the pairs.

Equal rows are one weighted point, and the labels go back to them by value.
"""

from __future__ import annotations

import math

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.functions.graph import connected_components, dense_codes
from segmentry.functions.ranks import ValueCounts, lookup_join
from segmentry.functions.vectors import matrix, row_chunks, squared_distances, within
from segmentry.operators.neighbours import lowest_within
from segmentry.session import materialize

HOME_ROWS = 4_096
CANDIDATE_ROWS = 8_192
#: Where every block needs most points, each goes to every block: larger ones, up to so many times the rows above, keep
#: the copies of a point down.  A task still holds a bounded number of rows.
BLOCKS, LARGEST = 6, 8


def distinct_points(df: DataFrame) -> ValueCounts:
    """``(value = features, ties, id)``, one row per distinct vector; ``id`` is the smallest."""
    table = (
        df.groupBy(F.col("features").alias("value")).agg(F.count(F.lit(1)).alias("ties"), F.min("id").alias("id")).persist()
    )
    distinct, rows = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("ties"), F.lit(0))).first()
    return ValueCounts(table, distinct, rows)


class _Blocks:
    """Pivots, block radii and the number of sub-blocks of each block."""

    def __init__(self, points: DataFrame, n: int, eps: float):
        larger = min(max(1, n // (BLOCKS * HOME_ROWS)), LARGEST)
        self.home_rows, self.candidate_rows = HOME_ROWS * larger, CANDIDATE_ROWS * larger
        wanted, self.eps = -(-n // self.home_rows), eps
        if wanted <= 1:
            # Everything fits one block: no pivot has to be found.
            self.pivots, self.radii, self.splits = None, None, [(0, 1, 1)]
            return
        picked = points.orderBy(F.xxhash64("id"), "id").limit(min(wanted, math.isqrt(n) + 1)).select("features").collect()
        self.pivots, self.splits = np.array([r["features"] for r in picked]), None
        home = points.transform(self._with_home)
        stats = home.groupBy("home").agg(F.max("distance").alias("radius")).collect()
        self.radii = np.full(len(self.pivots), -np.inf)
        for r in stats:
            self.radii[r["home"]] = r["radius"]

    def _with_home(self, points: DataFrame) -> DataFrame:
        pivots = self.pivots

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    d2 = squared_distances(matrix(batch), pivots)
                    home = d2.argmin(axis=1)
                    far = np.sqrt(d2[np.arange(len(home)), home])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(home.astype(np.int32)), pa.array(far)], names=["home", "distance"]
                    )

        return points.mapInArrow(nearest, "home int, distance double")

    def place(self, points: DataFrame) -> DataFrame:
        """Point columns plus ``block`` and ``at_home``, one row per block that needs the point."""
        if self.pivots is None:
            return points.withColumns({"block": F.lit(0), "at_home": F.lit(True)})
        pivots, reach = self.pivots, self.radii + self.eps

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = matrix(batch)
                d2 = squared_distances(x, pivots)
                home = d2.argmin(axis=1)
                # Slack covers rounding: an extra candidate costs time, a missing one a neighbour.
                slack = 1e-6 * (1.0 + np.abs(x).max())
                near = np.sqrt(d2) <= reach[None, :] + slack
                near[np.arange(len(x)), home] = True
                rows, which = np.nonzero(near)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(x)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(which.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(home.astype(np.int32)), lists],
                    names=[*batch.schema.names, "home", "blocks"],
                )

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
        placed = points.mapInArrow(blocks, f"{schema}, home int, blocks array<int>")
        return placed.withColumn("block", F.explode("blocks")).withColumn("at_home", F.col("block") == F.col("home")).drop(
            "blocks", "home"
        )

    def grouped(self, points: DataFrame) -> DataFrame:
        """Rows keyed ``(block, s, t)``: home sub-block ``s`` against candidate sub-block ``t``."""
        placed = self.place(points)
        if self.splits is None:
            counts = placed.groupBy("block").agg(
                F.count_if("at_home").alias("homes"), F.count(F.lit(1)).alias("candidates")
            )
            # One row per pivot.
            self.splits = [
                (r["block"], -(-r["homes"] // self.home_rows), -(-r["candidates"] // self.candidate_rows)) for r in counts.collect()
            ]
        splits = points.sparkSession.createDataFrame(self.splits, "block int, n_s int, n_t int")
        rows = placed.join(F.broadcast(splits), "block")
        mine = F.xxhash64(F.col("id"), F.lit(1))
        s, t = F.pmod(mine, F.col("n_s")).cast("int"), F.pmod(mine, F.col("n_t")).cast("int")

        def copies(role: str, over: str, fixed, free: str):
            every = F.explode(F.sequence(F.lit(0), F.col(over) - 1)).alias(free)
            return [*points.columns, "block", F.lit(role).alias("role"), fixed, every]

        homes = rows.where("at_home").select(*copies("home", "n_t", s.alias("s"), "t"))
        others = rows.where("n_s > 0").select(*copies("candidate", "n_s", t.alias("t"), "s"))
        return homes.unionByName(others)


def _stack(rows: pd.DataFrame) -> np.ndarray:
    return np.stack(rows["features"].to_numpy())


def _neighbour_weights(eps: float):
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        homes, others = pdf[pdf["role"] == "home"], pdf[pdf["role"] == "candidate"]
        if not len(homes) or not len(others):
            return pd.DataFrame({"id": [], "degree": []})
        x, y, w = _stack(homes), _stack(others), others["weight"].to_numpy(float)
        degree = np.concatenate([within(x[part], y, eps) @ w for part in row_chunks(len(x), len(y))])
        return pd.DataFrame({"id": homes["id"].to_numpy(), "degree": degree.astype(np.int64)})

    return count


def _merged(label: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Component labels after all columns that share a row of ``near`` are joined; a component is its lowest label."""
    if not len(near):
        return label
    rows, columns = np.nonzero(near)
    codes = np.unique(label)
    at = np.searchsorted(codes, label)
    ends = np.unique(rows * len(codes) + at[columns])  # rows by components, each once
    rows, of = np.divmod(ends, len(codes))
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    root = np.arange(len(codes))
    while True:
        lowest = np.repeat(np.minimum.reduceat(root[of], starts), np.diff(np.append(starts, len(of))))
        new = root.copy()
        np.minimum.at(new, of, lowest)
        np.minimum.at(new, root[of], lowest)
        new = new[new]
        if (new == root).all():
            return codes[root[at]]
        root = new


def _local_links(eps: float):
    """Star edges of the core points joined inside a group, and the cores next to border points."""

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        homes, others = pdf[pdf["role"] == "home"], pdf[(pdf["role"] == "candidate") & pdf["core"]]
        if not len(homes) or not len(others):
            return pd.DataFrame({"a": [], "b": [], "border": []})
        x, y = _stack(homes), _stack(others)
        home_ids, other_ids, core = homes["id"].to_numpy(), others["id"].to_numpy(), homes["core"].to_numpy(bool)
        # Local component of every candidate core; a home core merges those it touches.
        label, first, touched = np.arange(len(y)), np.full(len(x), -1), []
        for part in row_chunks(len(x), len(y)):
            near = within(x[part], y, eps)
            any_near = near.any(axis=1)
            first[part] = np.where(any_near, near.argmax(axis=1), -1)
            rows, reached = np.nonzero(near & ~core[part, None])
            touched.append((rows + part.start, reached))  # fewer than min_samples of each border point
            label = _merged(label, near[core[part] & any_near])
        lowest = pd.Series(other_ids).groupby(label).transform("min").to_numpy()
        joined = np.flatnonzero(core & (first >= 0))
        a, b, border = [other_ids, home_ids[joined]], [lowest, lowest[first[joined]]], [len(y) + len(joined), 0]
        rows, reached = (np.concatenate(c) for c in zip(*touched))
        beside = np.unique(np.stack([rows, np.searchsorted(np.unique(lowest), lowest[reached])]), axis=1)
        a.append(home_ids[beside[0]])
        b.append(np.unique(lowest)[beside[1]])
        border[1] = beside.shape[1]
        border = [np.repeat([False, True], border)]
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b), "border": np.concatenate(border)})

    return link


def _cluster_numbers(links: DataFrame) -> DataFrame:
    """``(rep, cluster)`` for every local component, numbered by smallest core id.

    Local components that share a core belong together; that graph has one node per local component.
    """
    reps = links.where("not border").groupBy("a").agg(F.collect_set("b").alias("reps"))
    edges = reps.select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")).distinct()
    components = materialize(connected_components(edges))
    return dense_codes(components, "component", "cluster", "node").select(F.col("node").alias("b"), "cluster")


@dataclass(frozen=True)
class DbscanModel:
    """Core points ``(id, features, cluster)``, one per distinct vector, and the radius they reach."""

    core: DataFrame
    eps: float

    def assign(self, df: DataFrame) -> DataFrame:
        """``(id, cluster)``: the lowest-numbered cluster with a core point within ``eps``, else -1."""
        found = lowest_within(self.core, df, self.eps, "cluster")
        return df.select("id").join(found, "id", "left").fillna(-1, ["cluster"])

    def save(self, path: str) -> None:
        self.core.withColumn("eps", F.lit(self.eps)).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, eps: float) -> DbscanModel:
        return DbscanModel(spark.read.parquet(path).drop("eps"), eps)


def dbscan(df: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """``(id, cluster)`` for ``(id, features)``; -1 is noise.

    A point with at least ``min_samples`` rows within ``eps``, itself included, is
    core.  Clusters are numbered by their smallest core id, and a border point
    takes the lowest-numbered cluster it touches.
    """
    return fit_dbscan(df, eps, min_samples)[0]


def fit_dbscan(df: DataFrame, eps: float, min_samples: int) -> tuple[DataFrame, DbscanModel]:
    """The labels of ``dbscan`` and what it takes to place new rows."""
    counts = distinct_points(df)
    id_type = dict(df.dtypes)["id"]
    points = counts.table.select("id", F.col("value").alias("features"), F.col("ties").alias("weight"))
    blocks = _Blocks(points, counts.distinct, eps)
    degrees = (
        blocks.grouped(points)
        .groupBy("block", "s", "t")
        .applyInPandas(_neighbour_weights(eps), f"id {id_type}, degree bigint")
        .groupBy("id")
        .agg(F.sum("degree").alias("degree"))
    )
    flagged = points.join(degrees, "id").withColumn("core", F.col("degree") >= min_samples).drop("degree").persist()
    links = (
        blocks.grouped(flagged)
        .groupBy("block", "s", "t")
        .applyInPandas(_local_links(eps), f"a {id_type}, b {id_type}, border boolean")
        .persist()
    )
    numbers = _cluster_numbers(links)
    labels = links.join(numbers, "b").groupBy(F.col("a").alias("id")).agg(F.min("cluster").alias("cluster"))
    coded = flagged.select("id").join(labels, "id", "left").fillna(-1, ["cluster"])
    model = DbscanModel(flagged.where("core").select("id", "features").join(labels, "id"), eps)
    if counts.distinct == counts.rows:
        return coded, model
    # Copies take the label of their vector; a vector holding many rows does not meet in one task.
    by_value = counts.table.join(coded, "id").select("value", "ties", "cluster")
    found = lookup_join(df.select("id", "features"), F.col("features"), counts, by_value, "cluster", F.col("id"))
    return found.select("id", "cluster"), model
