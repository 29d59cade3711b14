"""Gaussian mixture (full covariance) with restarts: Spark ML draws the starts and holds the model.

Every pass over the cached rows advances all starts by one step of expectation and maximisation, as the passes of
``kmeans`` do: a task returns weighted sums per start and component, which are added up by key.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import RDD, inheritable_thread_target
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions.vectors import row_chunks
from segmentry.operators.kmeans import cached_blocks
from segmentry.session import gathered

MAX_ITER = 100
TOL = 1e-3
#: Added to every density, as Spark ML does, so that a row far from all components counts for each of them.
EPSILON = float(np.finfo(float).eps)


@dataclass
class _State:
    """One start: its Spark ML model, the mixture as it is by now and its last two log likelihoods."""

    start: GaussianMixtureModel
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    likelihood: float = -np.inf
    before: float = 0.0
    collapsed: bool = False

    def densities(self) -> list[tuple[np.ndarray, np.ndarray, float]] | None:
        """Per component its mean, the root of the pseudo-inverse of its covariance and the log of its constant; None where it is not finite."""
        found = []
        for mean, covariance in zip(self.means, self.covariances):
            if not np.isfinite(covariance).all():
                return None
            values, vectors = np.linalg.eigh(covariance)
            kept = values > EPSILON * values.max() * len(values)  # none where all rows are equal
            root = np.where(kept, vectors / np.sqrt(np.where(kept, values, 1.0)), 0.0)
            found.append((mean, root, -0.5 * (len(values) * math.log(2 * math.pi) + np.log(values[kept]).sum())))
        return found


def _pass(blocks: RDD, parts: int, states: dict[int, _State], shapes: dict[int, list]) -> dict[int, tuple]:
    """Per start: log likelihood, and per component the sum of its shares, of rows and of their products."""
    names, (k, dims) = list(states), next(iter(states.values())).means.shape
    every = [shape for i in names for shape in shapes[i]]
    weights = np.concatenate([states[i].weights for i in names])
    roots, constants = np.hstack([root for _, root, _ in every]), np.array([c for *_, c in every])
    offsets = np.concatenate([mean @ root for mean, root, _ in every])

    def step(rows: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        held = None
        for _, block in rows:
            for part in row_chunks(len(block), len(offsets)):
                x = block[part]
                away = (x @ roots - offsets).reshape(len(x), len(every), dims)
                away = np.einsum("nkd,nkd->nk", away, away)
                shares = (EPSILON + weights * np.exp(constants - 0.5 * away)).reshape(len(x), len(names), k)
                total = shares.sum(axis=2)
                shares = (shares / total[:, :, None]).reshape(len(x), -1)
                products = np.array([((x * share[:, None]).T @ x).ravel() for share in shares.T])
                new = [np.log(total).sum(axis=0), shares.sum(axis=0), shares.T @ x, products]
                held = new if held is None else [a + b for a, b in zip(held, new)]
        if held is not None:
            for j, i in enumerate(names):
                own = slice(j * k, (j + 1) * k)
                yield i, np.concatenate([held[0][j : j + 1], *(h[own].ravel() for h in held[1:])])

    partial = blocks.mapPartitions(step)
    if parts > 1:
        partial = partial.reduceByKey(operator.add, min(parts, len(names)))
    out = {}
    for i, sums in partial.collect():  # a row per start
        shares, rows, products = np.split(sums[1:], [k, k + k * dims])
        out[i] = float(sums[0]), shares, rows.reshape(k, dims), products.reshape(k, dims, dims)
    return out


def _advance(state: _State, sums: tuple) -> None:
    likelihood, shares, rows, products = sums
    state.before, state.likelihood = state.likelihood, likelihood
    state.means = rows / shares[:, None]
    state.covariances = products / shares[:, None, None] - state.means[:, :, None] * state.means[:, None, :]
    state.weights = shares / shares.sum()


def _model(state: _State, estimator: GaussianMixture, spark) -> GaussianMixtureModel:
    """The mixture as a Spark ML model."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    normal = jvm.org.apache.spark.ml.stat.distribution.MultivariateGaussian
    k, dims = state.means.shape
    shapes, weights = sc._gateway.new_array(normal, k), sc._gateway.new_array(jvm.double, k)
    for i in range(k):
        mean, covariance = DenseVector(state.means[i]), DenseMatrix(dims, dims, state.covariances[i].T.ravel())
        shapes[i], weights[i] = normal(_py2java(sc, mean), _py2java(sc, covariance)), float(state.weights[i])
    made = jvm.org.apache.spark.ml.clustering.GaussianMixtureModel(state.start.uid, weights, shapes)
    return estimator._copyValues(GaussianMixtureModel(made))


def fit_mixture(
    df: DataFrame,
    k: int = settings.DEFAULT_K,
    n_init: int = settings.N_INIT,
    seed: int = settings.SEED,
    parallelism: int = 8,
) -> GaussianMixtureModel:
    """The restart with the highest log likelihood over ``(id, features)``.

    Spark ML draws the starts, a few at a time; all of them go through the rows together.
    """
    spark = df.sparkSession
    spread = df.select(array_to_vector("features").alias("features")).persist()
    rows = gathered(spread, spread.count()).persist()

    def start(i: int) -> _State:
        model = GaussianMixture(k=k, seed=seed + i, maxIter=0, tol=TOL).fit(rows)
        shapes = model.gaussians
        means, covariances = np.array([g.mean.toArray() for g in shapes]), np.array([g.cov.toArray() for g in shapes])
        return _State(model, np.array(model.weights), means, covariances)

    blocks = None
    try:
        rows.count()
        spread.unpersist()
        with ThreadPool(min(parallelism, n_init)) as pool:
            states = dict(enumerate(pool.map(inheritable_thread_target(spark)(start), range(n_init))))
        blocks = cached_blocks(rows.select(F.lit(0).cast("bigint").alias("hash"), vector_to_array("features").alias("features")))
        running, parts = dict(states), blocks.getNumPartitions()
        for _ in range(MAX_ITER):
            shapes = {i: s.densities() for i, s in running.items()}
            for i, shape in shapes.items():
                running[i].collapsed = shape is None
            running = {i: s for i, s in running.items() if not s.collapsed}
            if not running:
                break
            for i, sums in _pass(blocks, parts, running, shapes).items():
                _advance(running[i], sums)
            running = {i: s for i, s in running.items() if abs(s.likelihood - s.before) > TOL}
    finally:
        rows.unpersist()
        if blocks is not None:
            blocks.unpersist()
    good = [s for s in states.values() if not s.collapsed and s.likelihood == s.likelihood]
    if not good:
        raise RuntimeError("no start of the mixture converged: covariances are not finite")
    best = max(good, key=lambda s: s.likelihood)
    return _model(best, GaussianMixture(k=k, seed=best.start.getSeed(), maxIter=MAX_ITER, tol=TOL), spark)


def predict_mixture(model: GaussianMixtureModel, df: DataFrame, out: str = "cluster") -> DataFrame:
    """Most probable component per row."""
    rows = df.withColumn("_vector", array_to_vector("features"))
    model = model.copy().setFeaturesCol("_vector").setPredictionCol(out).setProbabilityCol("_probability")
    return model.transform(rows).drop("_vector", "_probability").withColumn(out, F.col(out).cast("int"))
