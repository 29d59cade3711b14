"""The last rounds of bottom-up clustering."""

import numpy as np
import pytest
from conftest import points

from segmentry.operators.hierarchical import LINKAGES, merge_rounds


@pytest.mark.parametrize("linkage", LINKAGES)
def test_last_rounds_in_one_task(spark, monkeypatch, linkage):
    """The tree of a task that has all clusters, or those of the last rounds, is the tree of rounds of joins."""
    x = np.random.default_rng(9).normal(size=(70, 3))
    x[60:] = x[:10]
    df = points(spark, x)
    trees = []
    for few in (1, 25, 4_096):
        monkeypatch.setattr("segmentry.operators.hierarchical.LAST_CLUSTERS", few)
        rows = merge_rounds(df, linkage, 4).orderBy("round", "kept").collect()
        trees.append([(r["round"], r["kept"], r["gone"], round(r["height"], 9), r["size"]) for r in rows])
    assert trees[0] == trees[1] == trees[2] and len(trees[0]) == 69
