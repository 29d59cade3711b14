"""Quantiles, ranks, lookups and components against NumPy, on their large-data paths too."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmentry.functions import average_rank_share, element_at, exact_quantiles, order_statistics, ranks
from segmentry.functions import quantiles as quantiles_module
from segmentry.functions.graph import connected_components, dense_codes
from segmentry.functions.vectors import uniforms, within
from segmentry.operators.rfm import rfm_scores

RFM_INPUT = "user_id bigint, total_events bigint, purchase_count bigint, total_spending double, days_since_last_event bigint"
PROBS = [0.0, 0.05, 0.25, 0.5, 0.6, 0.95, 1.0]


def frame(spark, **cols):
    n = len(next(iter(cols.values())))
    rows = [(i, *[None if v is None else float(v) for v in row]) for i, row in enumerate(zip(*cols.values()))]
    assert len(rows) == n
    return spark.createDataFrame(rows, "user_id bigint, " + ", ".join(f"{c} double" for c in cols)).repartition(4)


def test_quantiles_match_numpy(spark, monkeypatch):
    monkeypatch.setattr(quantiles_module, "FINISH_ROWS", 20)
    monkeypatch.setattr(quantiles_module, "COLUMNS_PER_PASS", 2)
    rng = np.random.default_rng(1)
    a = rng.normal(size=3000)
    b = np.where(rng.uniform(size=3000) < 0.4, 0.0, rng.exponential(size=3000))  # one hot value
    c = np.round(rng.uniform(0, 3, 3000))
    d = [None if i % 3 else v for i, v in enumerate(a)]
    got = exact_quantiles(frame(spark, a=a, b=b, c=c, d=d, e=[None] * 3000), list("abcde"), PROBS)
    for name, values in (("a", a), ("b", b), ("c", c), ("d", a[::3])):
        np.testing.assert_allclose(got[name], np.quantile(values, PROBS), rtol=1e-12, atol=1e-12)
    assert got["e"] == [None] * len(PROBS)


def test_order_statistics_are_elements_also_infinite_ones(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=400), [np.inf] * 150, [-np.inf] * 50])
    stats = order_statistics(frame(spark, a=values), ["a"], [i / 40 for i in range(41)])["a"]
    have, ordered = set(values), np.sort(values)
    for p, (low, high, _) in stats.points.items():
        assert low in have and high in have and low == ordered[int(p * 599 + 1e-9)]
    assert stats.quantile(0.0) == -np.inf and stats.quantile(1.0) == np.inf and stats.quantile(0.9) == np.inf
    assert element_at(frame(spark, a=values), "a", 60) == ordered[60] and element_at(frame(spark, a=values), "a", 600) is None


@pytest.mark.parametrize("n", [24, 27, 40, 72])
def test_ties_at_an_edge_keep_their_score(spark, n):
    ordered = sorted([i // 4 for i in range(n)])
    start = int(0.4 * (n - 1)) + 1
    ordered = ordered[:start] + [ordered[start - 1] + 1] * (n - start - 3) + [99, 100, 101]  # a tie group begins at the edge's rank
    df = spark.createDataFrame([(i, v, v, float(v), v) for i, v in enumerate(ordered)], RFM_INPUT).repartition(3)
    edges = sorted(set(np.quantile(ordered, [0, 0.2, 0.4, 0.6, 0.8, 1.0])))[1:-1]
    got = {r["user_id"]: r["frequency_score"] for r in rfm_scores(df).collect()}
    assert got == {i: 1 + sum(v > e for e in edges) for i, v in enumerate(ordered)}


def test_quantiles_of_a_clipped_column_need_no_second_pass(spark):
    values = np.random.default_rng(2).normal(size=101)
    stats = order_statistics(frame(spark, a=values), ["a"], [0.05, 0.95])["a"]
    clipped = np.clip(values, -1, 1)
    for p in (0.05, 0.95):
        assert stats.quantile(p, lambda v: min(max(v, -1), 1)) == pytest.approx(np.quantile(clipped, p))


def test_rank_share_matches_average_ties(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RANK_BUCKETS", 16)
    monkeypatch.setattr(ranks, "HOT_SHARE", 20)
    rng = np.random.default_rng(4)
    values = [0.0] * 300 + list(np.round(rng.uniform(0, 50, 500), 1)) + [None] * 40
    out = average_rank_share(frame(spark, v=values), "v", "pct", "user_id").orderBy("user_id").collect()
    known = np.array(values[:800])
    below = (known[None, :] < known[:, None]).sum(1)
    ties = (known[None, :] == known[:, None]).sum(1)
    np.testing.assert_allclose([r["pct"] for r in out[:800]], (below + (ties + 1) / 2) / 800)
    assert all(r["pct"] is None for r in out[800:])
    assert len(out) == 840


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(400 + i, 401 + i) for i in range(40)] + [(999, 999)]
    top = {n: n for e in edges for n in e}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        top[b] = a
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: root(n) for n in top}


def test_dense_codes(spark):
    df = spark.createDataFrame([(1, 50), (2, 7), (3, 50), (4, None), (5, 9)], "id bigint, c bigint")
    got = {r["id"]: r["code"] for r in dense_codes(df, "c", "code", "id").collect()}
    assert got == {1: 2, 2: 0, 3: 2, 4: None, 5: 1}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(-5, 5)), min_size=1, max_size=30), st.sampled_from([1.0, 2.0, 5.0]))
def test_within_is_exact_at_the_limit(cells, eps):
    x = np.array(cells, float)
    want = ((x[:, None] - x[None]) ** 2).sum(2) <= eps * eps
    assert (within(x, x, eps) == want).all()


def test_uniforms_are_uniform_and_repeatable():
    u = uniforms(np.arange(20_000), 7, 1)
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01
    assert (u == uniforms(np.arange(20_000), 7, 1)).all()
    assert not (u == uniforms(np.arange(20_000), 7, 2)).any()
