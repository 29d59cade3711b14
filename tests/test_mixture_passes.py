"""The starts of a mixture go through the rows together, and end where Spark ML ends."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import labels_of, points
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.ml.functions import array_to_vector

from segmentry.operators import mixture


def _blobs(rows: int):
    rng = np.random.default_rng(2)
    return np.vstack([rng.normal(c, s, (rows, 3)) for c, s in ((0, 1.0), (3, 0.5), (-4, 2.0))])


def test_every_start_ends_as_in_spark(spark, tmp_path):
    df = points(spark, _blobs(80), parts=1)
    vectors = df.select(array_to_vector("features").alias("features"))
    alone = [GaussianMixture(k=3, seed=s, maxIter=mixture.MAX_ITER, tol=mixture.TOL).fit(vectors) for s in (5, 6, 7)]
    best = max(alone, key=lambda m: m.summary.logLikelihood)
    got = mixture.fit_mixture(df, 3, n_init=3, seed=5)
    assert got.weights == pytest.approx(best.weights, rel=1e-6)
    for a, b in zip(got.gaussians, best.gaussians):
        assert np.allclose(a.mean.toArray(), b.mean.toArray()) and np.allclose(a.cov.toArray(), b.cov.toArray())
    got.write().save(str(tmp_path / "model"))
    kept = GaussianMixtureModel.load(str(tmp_path / "model"))
    labels = labels_of(mixture.predict_mixture(kept, df))
    assert (labels == labels_of(mixture.predict_mixture(best, df))).all() and got.getMaxIter() == mixture.MAX_ITER


def test_starts_share_their_passes(spark, monkeypatch):
    passes, through = [], mixture._pass
    monkeypatch.setattr(mixture, "_pass", lambda blocks, parts, states, shapes: passes.append(len(states)) or through(blocks, parts, states, shapes))
    monkeypatch.setattr("segmentry.session.ROWS_PER_TASK", 50)
    df = points(spark, _blobs(60), parts=3)
    model = mixture.fit_mixture(df, 3, n_init=6)
    assert passes[0] == 6 and len(passes) <= mixture.MAX_ITER and passes == sorted(passes, reverse=True)
    assert sorted(np.bincount(labels_of(mixture.predict_mixture(model, df)))) == pytest.approx([60, 60, 60], abs=3)


def test_equal_rows(spark):
    df = points(spark, np.ones((40, 2)), parts=2)
    alone = GaussianMixture(k=2, seed=1, maxIter=mixture.MAX_ITER, tol=mixture.TOL).fit(df.select(array_to_vector("features").alias("features")))
    got = mixture.fit_mixture(df, 2, n_init=2, seed=1)
    assert got.weights == pytest.approx(alone.weights)
    assert (labels_of(mixture.predict_mixture(got, df)) == labels_of(mixture.predict_mixture(alone, df))).all()
