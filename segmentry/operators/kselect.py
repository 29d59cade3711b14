"""Choosing the number of clusters: scores per K, stability, elbow rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions.vectors import matrix, squared_distances
from segmentry.operators.kmeans import KMeansFit, Spec, assign, best_of_every_k, fit_many, poisson_weights, sweep, sweep_specs
from segmentry.operators.metrics import adjusted_rand, quality_table

METHODS = ("silhouette", "silhouette_estimate", "silhouette_sq", "davies_bouldin", "calinski_harabasz", "stability", "elbow")


def label_every_k(df: DataFrame, fits: dict[int, KMeansFit]) -> DataFrame:
    """``(id, features, labels map)`` with one entry per K, labelled in one pass."""
    named = assign(df.select("id", "features"), {f"k{k}": fit.centers for k, fit in fits.items()})
    entries = [x for k in fits for x in (F.lit(str(k)), F.col(f"k{k}"))]
    return named.select("id", "features", F.create_map(*entries).alias("labels"))


def evaluate_k(
    df: DataFrame,
    k_range: list[int] | None = None,
    n_init: int = settings.N_INIT,
    seed: int = settings.SEED,
    stability: bool = True,
    silhouette: str = "estimate",
) -> tuple[DataFrame, dict[int, KMeansFit]]:
    """``(n_clusters, inertia, silhouette_score, silhouette_sq, davies_bouldin, calinski_harabasz, stability, silhouette_estimate, silhouette_error)``.

    Every K is trained once and all scores come from that labelling.  Silhouettes,
    Davies-Bouldin and Calinski-Harabasz are NULL where K is not below the number
    of rows.  ``silhouette`` names which is worked out, as in ``quality_table``; the
    exact one is quadratic in the rows.  Stability is NULL if switched off.
    """
    k_range = list(k_range or settings.K_RANGE)
    df = df.select("id", "features").persist()
    rows = df.count()
    resamples: list[KMeansFit] = []
    if stability and k_range and max(k_range) < rows:
        # The resamples of the stability train in the passes of the sweep.
        starts, drawn = sweep_specs(k_range, n_init, seed), stability_specs(k_range, settings.N_BOOTSTRAP, seed)
        specs = list(dict.fromkeys(starts + drawn))
        fit_of = dict(zip(specs, fit_many(df, specs)))
        fits, resamples = best_of_every_k([fit_of[s] for s in starts], k_range), [fit_of[s] for s in drawn]
    else:
        fits = sweep(df, k_range, n_init, seed)
    scored = {k: fit for k, fit in fits.items() if k < rows}
    scores = {}
    if scored:
        scores = {int(r["labelling"]): r for r in quality_table(label_every_k(df, scored), silhouette=silhouette).collect()}
    stable = {}
    if stability:
        stable = {r["k"]: r["stability"] for r in stability_scores(df, k_range, seed=seed, fits=resamples).collect()}
    table = []
    for k in k_range:
        s = scores.get(k)
        values = (s["silhouette_score"], s["silhouette_sq"], s["davies_bouldin"], s["calinski_harabasz"]) if s else (None,) * 4
        estimate = (s["silhouette_estimate"], s["silhouette_error"]) if s else (None, None)
        table.append((k, fits[k].cost, *values, stable.get(k), *estimate))
    df.unpersist()
    schema = (
        "n_clusters int, inertia double, silhouette_score double, silhouette_sq double, davies_bouldin double, "
        "calinski_harabasz double, stability double, silhouette_estimate double, silhouette_error double"
    )
    return df.sparkSession.createDataFrame(table, schema), fits


def stability_specs(k_range: list[int], n_bootstrap: int = settings.N_BOOTSTRAP, seed: int = settings.SEED) -> list[Spec]:
    """The full fit of every K, then all its resamples."""
    return [Spec(k, seed) for k in k_range] + [Spec(k, seed + 1 + b, b) for k in k_range for b in range(n_bootstrap)]


def stability_scores(
    df: DataFrame,
    k_range: list[int],
    n_bootstrap: int = settings.N_BOOTSTRAP,
    seed: int = settings.SEED,
    fits: list[KMeansFit] | None = None,
) -> DataFrame:
    """``(k, stability)``: mean adjusted Rand index of resample labels against full-data labels.

    A resample weights each row by a Poisson count fixed by its id, which is how
    sampling with replacement distributes.  The full fit and every resample of
    every K are trained in the same passes, and one more pass counts how their
    labels coincide.  ``fits`` of ``stability_specs``, if given, are not trained again.
    """
    df = df.select("id", F.xxhash64("id").alias("hash"), "features").persist()
    rows = df.count()
    k_range = [k for k in k_range if k < rows]
    if not k_range:
        return df.sparkSession.createDataFrame([], "k int, stability double")
    fits = fits or fit_many(df, stability_specs(k_range, n_bootstrap, seed))
    reference = {f.spec.k: f.centers for f in fits[: len(k_range)]}
    resampled = fits[len(k_range) :]

    def coincide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros((len(reference[f.spec.k]), len(f.centers))) for f in resampled]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, hashes = matrix(batch), batch.column("hash").to_numpy()
            base = {k: squared_distances(x, c).argmin(axis=1) for k, c in reference.items()}
            weights = {b: poisson_weights(hashes, b) for b in range(n_bootstrap)}
            for table, f in zip(counts, resampled):
                mine = squared_distances(x, f.centers).argmin(axis=1)
                np.add.at(table, (base[f.spec.k], mine), weights[f.spec.bootstrap])
        cells = [(f.spec.k, f.spec.bootstrap, i, j, t[i, j]) for t, f in zip(counts, resampled) for i, j in np.argwhere(t)]
        if cells:
            columns = list(zip(*cells))
            kinds = [pa.int32()] * 4 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["k", "draw", "a", "b", "n"]
            )

    cells = df.mapInArrow(coincide, "k int, draw int, a int, b int, n double")
    per_draw = adjusted_rand(cells, "a", "b", by=["k", "draw"], weight="n")
    return per_draw.groupBy("k").agg(F.avg("adjusted_rand").alias("stability"))


def elbow_reference(scores: DataFrame) -> DataFrame:
    """``optimal_k`` of ``(k, inertia)`` by the rate of decrease.

    The first K after which the next drop is more than twice the current one;
    the second K when there is none, the first K with fewer than three.
    """
    order = Window.orderBy("k")  # one row per K
    drop = F.col("inertia") - F.lead("inertia").over(order)
    steps = scores.withColumns({"drop": drop, "next_k": F.lead("k").over(order), "at": F.row_number().over(order)})
    after = F.lead("drop").over(order)
    rate = F.when(after > 0, F.col("drop") / after).when(after.isNotNull(), 0.0)
    steps = steps.withColumn("rate", rate)
    found = F.min(F.when(F.col("rate") < 0.5, F.col("next_k")))
    second, first = F.min(F.when(F.col("at") == 2, F.col("k"))), F.min("k")
    return steps.agg(F.when(F.count(F.lit(1)) >= 3, F.coalesce(found, second)).otherwise(first).alias("optimal_k"))


def elbow_knee(scores: DataFrame) -> DataFrame:
    """``optimal_k`` furthest below the chord from the first to the last point."""
    ends = scores.agg(F.min_by("inertia", "k"), F.max_by("inertia", "k"), F.min("k"), F.max("k")).first()
    first, last, low, high = ends
    if high == low:
        return scores.select(F.col("k").alias("optimal_k"))
    share = (F.col("k") - low) / (high - low)
    below = F.lit(first) + share * (last - first) - F.col("inertia")
    return scores.withColumn("below", below).orderBy(F.desc("below"), "k").select(F.col("k").alias("optimal_k")).limit(1)


def method_of(silhouette: str) -> str:
    """The method that goes by the silhouette of this name."""
    return {"estimate": "silhouette_estimate", "squared": "silhouette_sq"}.get(silhouette, "silhouette")


def pick_k(table: DataFrame, method: str = "silhouette_estimate") -> int:
    """The K an ``evaluate_k`` table favours; the smaller K on ties."""
    if method not in METHODS:
        raise ValueError(f"Unknown method: {method}")
    if method == "elbow":
        scores = table.select(F.col("n_clusters").alias("k"), "inertia")
        return elbow_reference(scores).first()["optimal_k"]
    column = {"silhouette": "silhouette_score"}.get(method, method)
    order = F.asc(column) if method == "davies_bouldin" else F.desc(column)
    best = table.where(F.col(column).isNotNull()).orderBy(order, "n_clusters").first()
    if best is None:
        raise ValueError(f"No K has a {method} score")
    return best["n_clusters"]


def select_optimal_k(df: DataFrame, method: str = "silhouette_estimate", k_range: list[int] | None = None, **options) -> int:
    """Train the K range and return the favoured K."""
    if method not in METHODS:
        raise ValueError(f"Unknown method: {method}")
    kind = {"silhouette": "exact", "silhouette_sq": "squared"}.get(method, "estimate")
    table, _ = evaluate_k(df, k_range, stability=method == "stability", **{"silhouette": kind, **options})
    return pick_k(table, method)
