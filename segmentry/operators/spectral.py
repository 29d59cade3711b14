"""Spectral clustering on an RBF kernel by the Nystroem method.

Rows only ever meet a bounded set of landmarks.  Two passes collect sums over
all rows (kernel column sums for the degrees, then an m x m Gram matrix), a
third projects each row, and K-means runs on the projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions.vectors import list_array, matrix, squared_distances
from segmentry.operators.kmeans import assign, kmeans

MAX_LANDMARKS = 512


@dataclass(frozen=True)
class SpectralModel:
    """Landmarks, the basis that the kernel to them is projected on, and the centres of the clusters there."""

    gamma: float
    marks: np.ndarray
    root: np.ndarray
    to_degree: np.ndarray
    project: np.ndarray
    centers: np.ndarray | None = None

    def kernel(self, x: np.ndarray) -> np.ndarray:
        return np.exp(-self.gamma * squared_distances(x, self.marks))

    def normalised(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self.kernel(x)
        degree = np.sqrt(np.maximum(rows @ self.to_degree, 1e-12))
        return (rows @ self.root) / degree[:, None], degree

    def embed(self, points: DataFrame) -> DataFrame:
        """``(id, features)`` in the space of the leading eigenvectors."""

        def embedded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    y, degree = self.normalised(matrix(batch))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), list_array((y @ self.project) / degree[:, None])], names=["id", "features"]
                    )

        rows = points.select("id", "features")
        return rows.mapInArrow(embedded, f"id {dict(points.dtypes)['id']}, features array<double>")

    def assign(self, df: DataFrame) -> DataFrame:
        """``(id, cluster)``, also of rows that were not there at the fit."""
        return assign(self.embed(df), {"cluster": self.centers}).select("id", "cluster")

    _PARTS = ("marks", "root", "to_degree", "project", "centers")

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(n, i, [float(v) for v in row]) for n in self._PARTS for i, row in enumerate(np.atleast_2d(getattr(self, n)))]
        spark.createDataFrame(rows, "part string, at int, row array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, gamma: float) -> SpectralModel:
        rows = spark.read.parquet(path).orderBy("part", "at").collect()  # as many rows as landmarks, a few times
        parts = {n: np.array([r["row"] for r in rows if r["part"] == n]) for n in SpectralModel._PARTS}
        return SpectralModel(gamma, **parts | {"to_degree": parts["to_degree"][0]})


def spectral(df: DataFrame, k: int = settings.DEFAULT_K, **options) -> DataFrame:
    """``(id, cluster)``; with at most ``landmarks`` distinct points the kernel is complete."""
    return fit_spectral(df, k, **options).assign(df)


def fit_spectral(
    df: DataFrame,
    k: int = settings.DEFAULT_K,
    gamma: float = 1.0,
    landmarks: int = MAX_LANDMARKS,
    n_init: int = settings.N_INIT,
    seed: int = settings.SEED,
) -> SpectralModel:
    points = df.select("id", "features").persist()
    try:
        model = _fit_embedding(points, k, gamma, landmarks, seed)
        embedded = model.embed(points).persist()
        try:
            return replace(model, centers=kmeans(embedded, k, n_init, seed).centers)
        finally:
            embedded.unpersist()
    finally:
        points.unpersist()


def _fit_embedding(points: DataFrame, k: int, gamma: float, landmarks: int, seed: int) -> SpectralModel:
    """The ``k`` leading eigenvectors of the normalised kernel."""
    distinct = points.groupBy("features").agg(F.min("id").alias("id"))
    picked = distinct.orderBy(F.xxhash64(F.lit(seed), F.col("id")), "id").limit(landmarks).collect()
    none = np.zeros((0, 0))
    model = SpectralModel(gamma, np.array([r["features"] for r in picked]), none, none, none)
    values, vectors = np.linalg.eigh(model.kernel(model.marks))
    kept = values > 1e-10 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])  # kernel(x) @ root has the kernel as its Gram matrix
    column_sums = _sum_rows(points, lambda x: model.kernel(x).sum(axis=0)[None, :])[0]
    based = replace(model, root=root, to_degree=root @ (root.T @ column_sums))

    def gram(x: np.ndarray) -> np.ndarray:
        y = based.normalised(x)[0]
        return y.T @ y

    values, vectors = np.linalg.eigh(_sum_rows(points, gram))
    lead = np.argsort(values)[::-1][:k]
    project = vectors[:, lead] / np.sqrt(np.maximum(values[lead], 1e-12))
    project = project * np.where(project[np.abs(project).argmax(axis=0), np.arange(len(lead))] < 0, -1.0, 1.0)
    return replace(based, project=project)


def _sum_rows(points: DataFrame, part) -> np.ndarray:
    """Sum over all batches of a small matrix computed from each of them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                add = part(matrix(batch))
                total = add if total is None else total + add
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), list_array(total)], names=["i", "v"]
            )

    rows = (
        points.mapInArrow(partial, "i int, v array<double>")
        .groupBy("i")
        .agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v"))
        .orderBy("i")
        .collect()
    )
    return np.array([r["v"] for r in rows])
