"""K-means passes over cached blocks."""

from __future__ import annotations

import numpy as np
from conftest import points

from segmentry.operators import kmeans


def test_kmeans_passes_over_cached_blocks(spark, monkeypatch):
    x = np.random.default_rng(1).normal(size=(90, 3))
    rows = points(spark, x, parts=6)
    specs = [kmeans.Spec(3, 1), kmeans.Spec(4, 2, 0)]
    one = kmeans.fit_many(rows, specs)
    made = kmeans._prepare(rows)
    assert made.blocks.is_cached and made.parts == 1
    hashes, block = made.blocks.first()
    assert len(hashes) == 90 and sorted(map(tuple, block)) == sorted(map(tuple, x))
    monkeypatch.setattr("segmentry.session.ROWS_PER_TASK", 10)
    monkeypatch.setattr(kmeans, "KEYS_PER_TASK", 2)
    assert kmeans._prepare(rows).parts == 6
    for a, b in zip(one, kmeans.fit_many(rows, specs)):
        assert np.allclose(a.centers, b.centers) and np.isclose(a.cost, b.cost)
