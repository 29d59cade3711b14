"""Neighbour joins and bottom-up clustering against brute force."""

import numpy as np
import pytest
from conftest import labels_of, points, same_partition

from segmentry.operators import neighbours
from segmentry.operators.hierarchical import LINKAGES, agglomerative, cut, merge_rounds
from segmentry.operators.neighbours import knn_edges, lowest_within


def brute_neighbours(x, asked, k):
    out = []
    for i in asked:
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i][:k]
        out += [(int(i), int(j), n + 1, pytest.approx(d[j], abs=1e-9)) for n, j in enumerate(order)]
    return out


@pytest.mark.parametrize("small", [False, True])
def test_knn_edges(spark, blobs, monkeypatch, small):
    x, _ = blobs
    if small:  # many pivots, sub-blocks and groups of queries; every step has work
        for name, value in (("POINTS_PER_PIVOT", 8), ("BLOCK_ROWS", 20), ("QUERY_ROWS", 15), ("NEXT_BLOCKS", 3)):
            monkeypatch.setattr(neighbours, name, value)
    df = points(spark, x)
    got = knn_edges(df, 7, df.where("id % 20 = 0")).orderBy("id", "rank").collect()
    assert [tuple(r) for r in got] == brute_neighbours(x, range(0, len(x), 20), 7)
    every = knn_edges(df, 3).orderBy("id", "rank").collect()
    assert [tuple(r) for r in every] == brute_neighbours(x, range(len(x)), 3)


def test_knn_edges_of_few_points(spark):
    df = points(spark, np.array([[0.0, 0.0], [0.0, 1.0], [0.0, 1.0]]), 1)
    got = [(r["id"], r["neighbour"], r["distance"]) for r in knn_edges(df, 10).orderBy("id", "rank").collect()]
    assert got == [(0, 1, 1.0), (0, 2, 1.0), (1, 2, 0.0), (1, 0, 1.0), (2, 1, 0.0), (2, 0, 1.0)]
    assert knn_edges(df.where("id = 0"), 2).count() == 0
    assert knn_edges(df.where("false"), 2, df).count() == 0
    new = df.selectExpr("id + 100 AS id", "features")
    assert knn_edges(df, 1, new).count() == 3


def test_lowest_within(spark, blobs, monkeypatch):
    monkeypatch.setattr(neighbours, "POINTS_PER_PIVOT", 16)
    x, _ = blobs
    df = points(spark, x).selectExpr("id", "features", "int(id % 7) AS value")
    got = {r["id"]: r["value"] for r in lowest_within(df.where("id % 3 = 0"), df.where("id % 3 = 1"), 0.4, "value").collect()}
    marks = np.arange(0, len(x), 3)
    for i in range(1, len(x), 3):
        near = marks[((x[marks] - x[i]) ** 2).sum(axis=1) <= 0.16]
        assert got.get(i) == (min(int(m) % 7 for m in near) if len(near) else None)
    assert lowest_within(df.where("false"), df, 0.4, "value").count() == 0


def brute_merges(x, linkage):
    """One merge at a time of the nearest two clusters: heights, and the clusters after each merge."""
    clusters, heights, states = [[i] for i in range(len(x))], [], []
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))

    def apart(a, b):
        if linkage == "ward":
            gap = ((x[a].mean(axis=0) - x[b].mean(axis=0)) ** 2).sum()
            return np.sqrt(2 * len(a) * len(b) / (len(a) + len(b)) * gap)
        between = d[np.ix_(a, b)]
        return {"single": between.min(), "complete": between.max(), "average": between.mean()}[linkage]

    while len(clusters) > 1:
        pairs = [(apart(a, b), i, j) for i, a in enumerate(clusters) for j, b in enumerate(clusters[:i])]
        height, i, j = min(pairs)
        heights.append(height)
        clusters[j] = clusters[j] + clusters[i]
        del clusters[i]
        states.append([list(c) for c in clusters])
    return heights, {len(s): s for s in states}


@pytest.mark.parametrize("linkage", LINKAGES)
def test_rounds_make_the_tree_of_single_merges(spark, linkage):
    """Where every two points have an edge, rounds of mutual nearest clusters give what merging one pair at a time does."""
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(c, 0.6, (9, 3)) for c in ((0, 0, 0), (5, 0, 0), (0, 6, 1))])
    df = points(spark, x)
    merges = merge_rounds(df, linkage, len(x) - 1)
    rows = merges.collect()
    heights, states = brute_merges(x, linkage)
    assert len(rows) == len(x) - 1 and len({r["gone"] for r in rows}) == len(rows) and all(r["kept"] < r["gone"] for r in rows)
    assert sorted(r["height"] for r in rows) == pytest.approx(sorted(heights))
    assert max(r["size"] for r in rows) == len(x) and max(r["round"] for r in rows) < len(x) - 1
    for k in (2, 3, 7):
        labels = labels_of(cut(df, merges, k))
        want = np.zeros(len(x), int)
        for n, members in enumerate(states[k]):
            want[members] = n
        assert same_partition(labels, want)


def test_agglomerative_on_a_sparse_graph(spark, blobs):
    x, truth = blobs
    df = points(spark, x[:450])
    labels = labels_of(agglomerative(df, 3, "ward", 5))  # the graph falls apart: centres join the parts
    assert len(labels) == 450 and same_partition(labels, truth)
    copies = points(spark, np.repeat(x[:2], 6, axis=0))
    assert len(set(labels_of(agglomerative(copies, 2)))) == 2
    assert labels_of(agglomerative(copies, 1)).tolist() == [0] * 12
    assert agglomerative(df.where("id = 4"), 3).collect()[0]["cluster"] == 0
    with pytest.raises(ValueError):
        merge_rounds(df, "nearest")


def test_large_blocks_and_small_batches(spark, monkeypatch):
    """In many dimensions a query reaches all blocks: it is copied to few large ones, and batches of copies stay small."""
    for name, value in (("POINTS_PER_PIVOT", 8), ("BLOCK_ROWS", 40), ("QUERY_ROWS", 40), ("NEXT_BLOCKS", 2), ("ROUTE_CELLS", 200), ("ROUTE_ROWS", 16), ("GROUP_CELLS", 500)):
        monkeypatch.setattr(neighbours, name, value)
    x = np.random.default_rng(5).normal(size=(400, 12))
    x[300:] = x[:100]  # copies
    df = points(spark, x)
    got = knn_edges(df, 4).orderBy("id", "rank").collect()
    assert [tuple(r) for r in got] == brute_neighbours(x, range(len(x)), 4)
    blocks = neighbours.Blocks(df)
    assert len(blocks.pivots) > 15
    part = blocks.large(100)
    assert part.min() == 0 and len(set(part.tolist())) <= 9 and np.bincount(part, blocks.sizes).max() <= 100
    looking = df.selectExpr("id", "features", "double('inf') AS reach")
    fine, coarse = (blocks._routed(looking, lambda rank, before: rank >= 0, p, False, "rows") for p in (np.arange(len(part)), part))
    assert coarse.count() == 400 * len(set(part.tolist())) < fine.count()
