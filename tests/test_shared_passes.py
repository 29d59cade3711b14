"""A K selection with stability trains every model in the same passes."""

from __future__ import annotations

import numpy as np
from conftest import points

from segmentry import settings
from segmentry.operators import kselect


def test_stability_trains_with_the_sweep(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(30, 3)) + 6 * i for i in range(3)])
    rows, calls, fit = points(spark, x, parts=3), [], kselect.fit_many
    apart = {r["k"]: r["stability"] for r in kselect.stability_scores(rows, [2, 3]).collect()}
    alone = {k: f.cost for k, f in kselect.sweep(rows, [2, 3], 2).items()}

    def noted(df, specs, **options):
        calls.append(len(specs))
        return fit(df, specs, **options)

    monkeypatch.setattr(kselect, "fit_many", noted)
    table, fits = kselect.evaluate_k(rows, [2, 3], n_init=2)
    assert calls == [2 * 2 + 2 * settings.N_BOOTSTRAP]  # the full fit of a K is one of its starts
    got = {r["n_clusters"]: r for r in table.collect()}
    for k in (2, 3):
        assert np.isclose(got[k]["stability"], apart[k]) and np.isclose(got[k]["inertia"], alone[k]) and fits[k].spec.k == k


def test_fewer_rows_than_clusters_keep_their_scores(spark):
    rows = points(spark, np.arange(9.0).reshape(3, 3), parts=1)
    got = {r["n_clusters"]: r["stability"] for r in kselect.evaluate_k(rows, [2, 3], n_init=1)[0].collect()}
    assert got[2] is not None and got[3] is None
