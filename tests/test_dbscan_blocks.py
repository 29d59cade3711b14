"""Copies of points that DBSCAN deals to its blocks."""

from __future__ import annotations

import numpy as np
from conftest import points
from pyspark.sql import functions as F

from segmentry.operators import dbscan


def test_blocks_grow_with_the_points(spark, monkeypatch):
    monkeypatch.setattr(dbscan, "HOME_ROWS", 10)
    monkeypatch.setattr(dbscan, "CANDIDATE_ROWS", 20)
    x = np.random.default_rng(1).normal(size=(400, 8))
    rows = points(spark, x).withColumn("weight", F.lit(1))
    blocks = dbscan._Blocks(rows, 400, 2.0)
    # Each point goes to every block that needs it, here to nearly all.
    assert blocks.grouped(rows).count() < 20 * 400
    degree = ((np.linalg.norm(x[:, None] - x[None], axis=2) <= 2.0).sum(axis=1) >= 4)
    labels = {r["id"]: r["cluster"] for r in dbscan.dbscan(rows.drop("weight"), 2.0, 4).collect()}
    assert all(labels[i] >= 0 for i in np.flatnonzero(degree)) and len(labels) == 400
