"""Few tasks for few rows in steps that pass over them many times."""

from __future__ import annotations

import numpy as np
from conftest import points
from pyspark.ml.clustering import GaussianMixture

from segmentry.operators import kmeans, mixture


def test_few_rows_are_few_tasks_of_every_pass(spark):
    rows = points(spark, np.random.default_rng(0).normal(size=(60, 3)), parts=20)
    assert kmeans._prepare(rows).df.rdd.getNumPartitions() == 1


def test_few_rows_are_few_tasks_of_every_mixture(spark, monkeypatch):
    seen = []

    def fit(self, rows):
        seen.append(rows.rdd.getNumPartitions())
        raise ValueError("seen")

    monkeypatch.setattr(GaussianMixture, "fit", fit)
    try:
        mixture.fit_mixture(points(spark, np.random.default_rng(0).normal(size=(60, 3)), parts=20), 2, n_init=1)
    except ValueError:
        pass
    assert seen == [1]


def test_rows_enough_stay_spread(spark, monkeypatch):
    monkeypatch.setattr("segmentry.session.ROWS_PER_TASK", 10)
    rows = points(spark, np.random.default_rng(0).normal(size=(60, 3)), parts=5)
    assert kmeans._prepare(rows).df.rdd.getNumPartitions() == 5


def test_passes_over_one_partition_do_not_shuffle(spark, monkeypatch):
    x = np.random.default_rng(0).normal(size=(60, 3))
    rows, specs = points(spark, x, parts=4), [kmeans.Spec(3, 1), kmeans.Spec(4, 2)]
    tracker = spark.sparkContext.statusTracker()

    def jobs_of_a_pass():
        made = kmeans._prepare(rows)
        spark.sparkContext.setJobGroup(f"pass-{made.parts}", "one pass")
        try:
            sums = kmeans._lloyd_sums(made, specs, [x[:3], x[:4]])
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        return sums, len(tracker.getJobIdsForGroup(f"pass-{made.parts}"))

    one, jobs = jobs_of_a_pass()
    assert jobs == 1
    monkeypatch.setattr("segmentry.session.ROWS_PER_TASK", 10)
    many, _ = jobs_of_a_pass()
    for a, b in zip(one, many):
        assert all(np.allclose(p, q) for p, q in zip(a, b))
