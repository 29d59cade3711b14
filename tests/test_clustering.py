"""Clustering operators against brute force and on separated groups."""

import numpy as np
import pytest
from conftest import labels_of, points, same_partition
from pyspark.sql import functions as F

from segmentry.operators import dbscan as dbscan_module
from segmentry.operators import hierarchical, kmeans, kselect, metrics, mixture, segments, spectral
from segmentry.operators.dbscan import _merged, dbscan


def brute_dbscan(x, eps, min_samples):
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= eps
    core, label, number = near.sum(1) >= min_samples, np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack, label[i] = [i], number
            while stack:
                for q in np.flatnonzero(near[stack.pop()]):
                    if label[q] < 0:
                        label[q] = number
                        if core[q]:
                            stack.append(q)
            number += 1
    return label


@pytest.mark.parametrize("eps,min_samples", [(0.3, 5), (1.0, 10)])
@pytest.mark.parametrize("home,candidates", [(4096, 8192), (60, 130)])
def test_dbscan(spark, blobs, monkeypatch, eps, min_samples, home, candidates):
    monkeypatch.setattr(dbscan_module, "HOME_ROWS", home)
    monkeypatch.setattr(dbscan_module, "CANDIDATE_ROWS", candidates)
    x, _ = blobs
    assert (labels_of(dbscan(points(spark, x), eps, min_samples)) == brute_dbscan(x, eps, min_samples)).all()


def test_dbscan_all_noise(spark):
    x = np.arange(20, dtype=float)[:, None] * 10
    assert (labels_of(dbscan(points(spark, x), 1.0, 2)) == -1).all()


def test_dbscan_in_many_dimensions(spark, monkeypatch):
    monkeypatch.setattr(dbscan_module, "HOME_ROWS", 60)
    x = np.random.default_rng(8).normal(size=(300, 64)) + np.repeat(np.eye(64)[:3] * 9, 100, axis=0)
    assert (labels_of(dbscan(points(spark, x), 10.5, 4)) == brute_dbscan(x, 10.5, 4)).all()


def test_kmeans_recovers_groups_and_repeats(spark, blobs, tmp_path):
    x, truth = blobs
    df = points(spark, x[:450])
    fit = kmeans.kmeans(df, 3)
    labels = labels_of(fit.assign(df))
    assert same_partition(labels, truth)
    assert fit.cost == pytest.approx(sum(((x[:450][labels == c] - fit.centers[c]) ** 2).sum() for c in range(3)), rel=1e-6)
    again = kmeans.kmeans(points(spark, x[:450], 7), 3)
    np.testing.assert_allclose(again.centers, fit.centers)
    fit.save(spark, str(tmp_path / "m"))
    np.testing.assert_array_equal(kmeans.KMeansFit.load(spark, str(tmp_path / "m")).centers, fit.centers)


def test_more_starts_never_cost_more(spark, blobs):
    df = points(spark, blobs[0])
    specs = [kmeans.Spec(6, 42 + i) for i in range(5)]
    costs = [f.cost for f in kmeans.fit_many(df, specs)]
    assert kmeans.kmeans(df, 6, n_init=5).cost == pytest.approx(min(costs))


def test_lloyd_from_given_centres(spark, blobs):
    x, _ = blobs
    centres = x[[0, 200, 400]]
    fit = kmeans.lloyd(points(spark, x), centres, 2)
    for _ in range(2):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([x[near == c].mean(0) for c in range(3)])
    np.testing.assert_allclose(fit.centers, centres)


def test_poisson_weights_have_the_asked_rate():
    w = kmeans.poisson_weights(np.arange(50_000), 3)
    assert w.mean() == pytest.approx(0.8, abs=0.02) and w.var() == pytest.approx(0.8, abs=0.03)


def test_fewer_distinct_points_than_clusters(spark):
    fit = kmeans.kmeans(points(spark, np.repeat([[0.0], [1.0]], 10, axis=0)), 4, n_init=2)
    assert len(fit.centers) == 2 and fit.cost == pytest.approx(0.0)


def test_mixture_and_spectral_and_bisecting(spark, blobs):
    x, truth = blobs
    df = points(spark, x[:450])
    model = mixture.fit_mixture(df, 3, n_init=3)
    assert same_partition(labels_of(mixture.predict_mixture(model, df)), truth)
    assert same_partition(labels_of(spectral.spectral(df, 3, n_init=3)), truth)
    assert same_partition(labels_of(spectral.spectral(df, 3, landmarks=80, n_init=3)), truth)
    assert len(set(labels_of(hierarchical.bisecting(df, 3)))) == 3


def test_k_selection(spark, blobs):
    x, _ = blobs
    table, fits = kselect.evaluate_k(points(spark, x[:450]), [2, 3, 4], n_init=3, silhouette="exact")
    usual, _ = kselect.evaluate_k(points(spark, x[:450]), [2, 3, 4], n_init=3, stability=False)
    assert kselect.pick_k(usual) == 3
    for r, e in zip(table.orderBy("n_clusters").collect(), usual.orderBy("n_clusters").collect()):  # all rows are in the sample
        assert e["silhouette_estimate"] == pytest.approx(r["silhouette_score"], abs=1e-6) and e["silhouette_error"] == 0.0
    linear, _ = kselect.evaluate_k(points(spark, x[:450]), [2, 3, 4], n_init=3, stability=False, silhouette="squared")
    assert kselect.pick_k(linear, "silhouette_sq") == 3
    assert all(r["silhouette_score"] is None and r["stability"] is None for r in linear.collect())
    assert all(r["silhouette_sq"] is None for r in table.collect())
    for method in set(kselect.METHODS) - {"silhouette_sq", "silhouette_estimate"}:
        assert kselect.pick_k(table, method) == 3
    assert set(fits) == {2, 3, 4}
    rows = {r["n_clusters"]: r for r in table.collect()}
    assert rows[2]["inertia"] > rows[3]["inertia"] > rows[4]["inertia"]
    assert rows[3]["stability"] > 0.9
    with pytest.raises(ValueError):
        kselect.pick_k(table, "nothing")


def test_k_not_below_rows_has_no_scores(spark):
    table, _ = kselect.evaluate_k(points(spark, np.random.default_rng(0).normal(size=(3, 2))), [2, 3], n_init=2)
    rows = {r["n_clusters"]: r for r in table.collect()}
    assert rows[2]["silhouette_estimate"] is not None and rows[3]["silhouette_estimate"] is None


@pytest.mark.parametrize(
    "inertia,want",
    [([100, 50, 45, 40], 3), ([100, 90, 40, 30], 3), ([100, 60, 40, 30], 3), ([100, 50], 2), ([9, 8, 9, 9], 3)],
)
def test_elbow(spark, inertia, want):
    df = spark.createDataFrame([(k + 2, float(v)) for k, v in enumerate(inertia)], "k int, inertia double")
    assert kselect.elbow_reference(df).first()[0] == want


def test_elbow_knee(spark):
    df = spark.createDataFrame([(2, 100.0), (3, 30.0), (4, 20.0), (5, 15.0)], "k int, inertia double")
    assert kselect.elbow_knee(df).first()[0] == 3


def brute_silhouette(x, label):
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = gap[i][own].sum() / (own.sum() - 1)
        b = min(gap[i][label == c].mean() for c in set(label) - {label[i]})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(out)


def test_silhouette_with_copies_singletons_and_blocks(spark, blobs, monkeypatch):
    x, _ = blobs
    label = np.arange(len(x)) % 3
    label[0], label[5] = 7, 8  # a singleton, and one inside a pile of copies
    rows = [(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, label))]
    df = metrics.one_labelling(spark.createDataFrame(rows, "id bigint, features array<double>, cluster int"))
    want = brute_silhouette(x, label)
    assert metrics.silhouettes(df).first()["silhouette_score"] == pytest.approx(want, abs=1e-7)
    monkeypatch.setattr(metrics, "BLOCK_ROWS", 100)
    assert metrics.silhouettes(df).first()["silhouette_score"] == pytest.approx(want, abs=1e-7)


def test_quality_fallbacks_and_noise(spark):
    x = [[0.0], [0.1], [5.0], [5.1], [9.0]]
    rows = [(i, p, c) for i, (p, c) in enumerate(zip(x, [0, 0, 1, 1, -1]))]
    df = spark.createDataFrame(rows, "id bigint, features array<double>, cluster int")
    whole = metrics.quality_table(metrics.one_labelling(df), silhouette="exact").first()
    assert (whole["n_clusters"], whole["n_noise"], whole["n_samples"]) == (3, 1, 5)
    without = metrics.quality_table(metrics.one_labelling(df), exclude_noise=True, silhouette="exact").first()
    assert without["n_clusters"] == 2 and without["silhouette_score"] > whole["silhouette_score"]
    flat = metrics.quality_table(metrics.one_labelling(df.withColumn("cluster", F.lit(0))), silhouette="exact").first()
    assert (flat["silhouette_score"], flat["davies_bouldin"], flat["calinski_harabasz"]) == (-1.0, float("inf"), 0.0)
    squared = metrics.quality_table(metrics.one_labelling(df.where("cluster >= 0")), silhouette="squared").first()
    assert squared["silhouette_kind"] == "squared" and squared["silhouette_sq"] > 0.9 and squared["silhouette_score"] is None


def test_davies_bouldin_over_blocks_of_centroids(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x, label = rng.normal(size=(400, 3)), np.arange(400) % 150
    rows = [(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, label))]
    long = metrics.exploded(metrics.one_labelling(spark.createDataFrame(rows, "id bigint, features array<double>, cluster int")))
    centre = np.array([x[label == c].mean(0) for c in range(150)])
    s = np.array([np.sqrt(((x[label == c] - centre[c]) ** 2).sum(1)).mean() for c in range(150)])
    gap = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2)) + np.diag(np.full(150, np.inf))
    want = ((s[:, None] + s[None]) / gap).max(1).mean()
    assert metrics.between_scores(long).first()["davies_bouldin"] == pytest.approx(want)
    monkeypatch.setattr(metrics, "BLOCK_ROWS", 40)
    assert metrics.between_scores(long).first()["davies_bouldin"] == pytest.approx(want)


def test_adjusted_rand(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 1), (1, 2)], "a int, b int")
    assert metrics.adjusted_rand(df, "a", "b").first()[0] == pytest.approx(0.5714285714)
    assert metrics.adjusted_rand(df, "a", "a").first()[0] == 1.0


def test_fit_segments(spark, blobs, tmp_path):
    x, truth = blobs
    df = points(spark, x[:450])
    run = segments.fit_segments(df, "kmeans", auto_select_k=True, n_init=2)
    assert run.metrics["n_clusters"] == 3 and run.params["selection_method"] == "silhouette_estimate"
    assert same_partition(labels_of(run.predict(df)), truth)
    run.save(str(tmp_path / "s"))
    back = segments.Segmentation.load(spark, str(tmp_path / "s"))
    assert back.labels.count() == 450 and back.params == run.params and back.metrics["n_clusters"] == 3
    assert same_partition(labels_of(back.predict(df)), truth)
    with pytest.raises(ValueError):
        segments.fit_segments(df, "other")
    with pytest.raises(ValueError):
        segments.fit_segments(df, "agglomerative", 3).predict(df)


@pytest.mark.parametrize("algorithm", ["kmeans", "gmm", "bisecting", "spectral", "dbscan"])
def test_saved_models_place_the_rows_of_the_fit(spark, blobs, tmp_path, algorithm):
    x, _ = blobs
    df = points(spark, x)
    params = {"dbscan": {"eps": 0.5, "min_samples": 5}, "bisecting": {}}.get(algorithm, {"n_init": 2})
    made = segments.segment(df, algorithm, None if algorithm == "dbscan" else 3, **params)
    made.save(str(tmp_path / "m"))
    back = segments.Segmentation.load(spark, str(tmp_path / "m"))
    want = {r["id"]: r["cluster"] for r in back.labels.collect()}
    assert len(want) == len(x)
    assert {r["id"]: r["cluster"] for r in back.predict(df).collect()} == want
    far = spark.createDataFrame([(9_000, [500.0, 500.0]), (9_001, [float(v) for v in x[0]])], "id bigint, features array<double>")
    new = {r["id"]: r["cluster"] for r in back.predict(far).collect()}
    assert new[9_001] == want[0] and (algorithm != "dbscan" or new[9_000] == -1)


def test_components_of_shared_rows():
    rng = np.random.default_rng(1)
    for _ in range(50):
        near = rng.random((12, 30)) < 0.06
        label = rng.integers(0, 30, 30)
        label = np.array([np.flatnonzero(label == c).min() for c in label])  # lowest member
        want = label.copy()
        for row in near:
            want[np.isin(want, want[row])] = want[row].min(initial=99)
        got = _merged(label, near)
        assert same_partition(got, want) and (got <= label).all()
    assert _merged(np.arange(3), np.zeros((0, 3), bool)).tolist() == [0, 1, 2]


def test_silhouette_estimate(spark, blobs):
    """With part of the rows, the exact value is within three errors; noise, copies and lone rows count as they do there."""
    x, _ = blobs
    label = np.r_[np.repeat([0, 1, 2], 150), np.repeat([-1, 0, 4], [40, 200, 60])]
    label[5] = 7
    rows = [(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, label))]
    df = metrics.one_labelling(spark.createDataFrame(rows, "id bigint, features array<double>, cluster int")).repartition(3)
    whole = metrics.silhouette_estimate(df, 10_000)
    assert [r["n_rows"] == r["n_sampled"] and r["std_error"] == 0 for r in whole.collect()] == [True] * 6
    exact = brute_silhouette(x, label)
    assert metrics.overall_estimate(whole).first()["silhouette_estimate"] == pytest.approx(exact, abs=1e-6)
    part = metrics.silhouette_estimate(df, 240)
    assert {r["n_sampled"] for r in part.collect()} == {1, 40}
    found = metrics.overall_estimate(part).first()
    assert 0 < found["silhouette_error"] < 0.05
    assert abs(found["silhouette_estimate"] - exact) < 3 * found["silhouette_error"]
    assert metrics.silhouette_estimate(df.where("false")).count() == 0


def test_comparison(spark, blobs):
    x, _ = blobs
    table, runs = segments.compare_algorithms(points(spark, x[:450]), 3, n_init=2)
    names = [r["algorithm"] for r in table.orderBy("position").collect()]
    assert names == [
        "kmeans", "bisecting", "agglomerative", "dbscan_eps0.5_min3", "dbscan_eps0.5_min5", "dbscan_eps1.0_min3",
        "dbscan_eps1.0_min5", "gmm", "spectral",
    ]
    best = segments.best_algorithm(table)
    assert best in runs and runs[best].labels.count() == 450
