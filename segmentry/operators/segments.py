"""One entry point for every algorithm, and their comparison."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.clustering import BisectingKMeansModel, GaussianMixtureModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.operators import kselect
from segmentry.operators.dbscan import DbscanModel, fit_dbscan
from segmentry.operators.hierarchical import agglomerative, fit_bisecting, predict_bisecting
from segmentry.operators.kmeans import KMeansFit, kmeans
from segmentry.operators.metrics import one_labelling, quality_table
from segmentry.operators.mixture import fit_mixture, predict_mixture
from segmentry.operators.spectral import SpectralModel, fit_spectral
from segmentry.session import materialize

ALGORITHMS = ("kmeans", "dbscan", "bisecting", "agglomerative", "gmm", "spectral")


@dataclass
class Segmentation:
    """Labels ``(id, cluster)``, the parameters behind them and their model, if it has one."""

    algorithm: str
    labels: DataFrame
    params: dict[str, Any] = field(default_factory=dict)
    model: Any = None
    metrics: dict[str, Any] = field(default_factory=dict)

    def save(self, path: str) -> None:
        """Labels as a table, parameters and metrics as text, the model next to them."""
        spark = self.labels.sparkSession
        self.labels.write.mode("overwrite").parquet(f"{path}/labels")
        about = json.dumps({"algorithm": self.algorithm, "params": self.params, "metrics": self.metrics})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        if self.algorithm in ("kmeans", "spectral"):
            self.model.save(spark, f"{path}/model")
        elif self.algorithm == "dbscan":
            self.model.save(f"{path}/model")
        elif self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Segmentation:
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        load = {
            "kmeans": lambda: KMeansFit.load(spark, f"{path}/model"),
            "gmm": lambda: GaussianMixtureModel.load(f"{path}/model"),
            "bisecting": lambda: BisectingKMeansModel.load(f"{path}/model"),
            "spectral": lambda: SpectralModel.load(spark, f"{path}/model", about["params"]["gamma"]),
            "dbscan": lambda: DbscanModel.load(spark, f"{path}/model", about["params"]["eps"]),
        }
        model = load[about["algorithm"]]() if about["algorithm"] in load else None
        labels = spark.read.parquet(f"{path}/labels")
        return Segmentation(about["algorithm"], labels, about["params"], model, about["metrics"])

    def predict(self, df: DataFrame) -> DataFrame:
        """Clusters of new ``(id, features)`` rows; the rows of the fit get the labels they have."""
        if self.algorithm == "gmm":
            return predict_mixture(self.model, df).select("id", "cluster")
        if self.algorithm == "bisecting":
            return predict_bisecting(self.model, df)
        if self.model is not None:
            return self.model.assign(df).select("id", "cluster")
        raise ValueError(f"{self.algorithm} has no model for new rows")


def segment(df: DataFrame, algorithm: str, k: int | None = None, **params) -> Segmentation:
    """Run one algorithm over ``(id, features)`` without scoring it."""
    k = k or settings.DEFAULT_K
    if algorithm == "kmeans":
        model = kmeans(df, k, **params)
        return Segmentation(algorithm, model.assign(df).select("id", "cluster"), {"k": k, **params}, model)
    if algorithm == "gmm":
        model = fit_mixture(df, k, **params)
        labels = predict_mixture(model, df).select("id", "cluster")
        return Segmentation(algorithm, labels, {"k": k, "covariance_type": "full", **params}, model)
    if algorithm == "dbscan":
        params = {"eps": settings.DBSCAN_EPS[0], "min_samples": settings.DBSCAN_MIN_SAMPLES[0], **params}
        labels, model = fit_dbscan(df, **params)
        return Segmentation(algorithm, labels, params, model)
    if algorithm == "bisecting":
        model = fit_bisecting(df, k, **params)
        return Segmentation(algorithm, predict_bisecting(model, df), {"k": k, **params}, model)
    if algorithm == "agglomerative":
        params = {"linkage": "ward", **params}
        return Segmentation(algorithm, agglomerative(df, k, **params), {"k": k, **params})
    if algorithm == "spectral":
        model = fit_spectral(df, k, **params)
        return Segmentation(algorithm, model.assign(df), {"k": k, "affinity": "rbf", "gamma": model.gamma, **params}, model)
    raise ValueError(f"Unknown algorithm: {algorithm}")


def fit_segments(
    df: DataFrame,
    algorithm: str = "kmeans",
    k: int | None = None,
    auto_select_k: bool = False,
    method: str = "silhouette_estimate",
    exclude_noise: bool = False,
    silhouette: str = "estimate",
    **params,
) -> Segmentation:
    """Choose K if asked to, cluster, score."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"Unknown algorithm: {algorithm}")
    if auto_select_k and k is None:
        k = kselect.select_optimal_k(df, method)
        chosen = {"selection_method": method}
    else:
        chosen = {}
    result = segment(df, algorithm, k, **params)
    result.params |= chosen
    result.labels = materialize(result.labels)
    labelled = df.select("id", "features").join(result.labels, "id")
    row = quality_table(one_labelling(labelled, algorithm), exclude_noise, silhouette).first().asDict()
    if algorithm == "kmeans":
        row["inertia"] = result.model.cost
    else:
        row.pop("inertia")
    result.metrics = row
    return result


def compare_algorithms(
    df: DataFrame,
    k: int | None = None,
    with_spectral: bool = True,
    silhouette: str = "estimate",
    n_init: int = settings.N_INIT,
    seed: int = settings.SEED,
) -> tuple[DataFrame, dict[str, Segmentation]]:
    """Metric rows of every algorithm, and the segmentations they belong to.

    The segmentations are kept, so the best one needs no second fit.  All of them
    are scored in the same passes, by the silhouette that ``silhouette`` names.
    ``with_spectral=False`` leaves spectral clustering out.
    """
    df = df.select("id", "features").persist()
    if k is None:
        k = kselect.select_optimal_k(df, kselect.method_of(silhouette), n_init=n_init, seed=seed)
    runs = {
        "kmeans": segment(df, "kmeans", k, n_init=n_init, seed=seed),
        "bisecting": segment(df, "bisecting", k, seed=seed),
        "agglomerative": segment(df, "agglomerative", k),
    }
    for eps in settings.DBSCAN_EPS[:2]:
        for min_samples in settings.DBSCAN_MIN_SAMPLES[:2]:
            runs[f"dbscan_eps{eps}_min{min_samples}"] = segment(df, "dbscan", eps=eps, min_samples=min_samples)
    runs["gmm"] = segment(df, "gmm", k, n_init=n_init, seed=seed)
    if with_spectral:
        runs["spectral"] = segment(df, "spectral", k, n_init=n_init, seed=seed)
    tagged = None
    for name, run in runs.items():
        run.labels = materialize(run.labels)
        part = run.labels.select("id", F.lit(name).alias("name"), "cluster")
        tagged = part if tagged is None else tagged.union(part)
    # One entry per algorithm and row, so the collected maps are small.
    maps = tagged.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("name", "cluster"))).alias("labels"))
    table = quality_table(df.join(maps, "id"), silhouette=silhouette)
    order = F.array_position(F.array(*[F.lit(n) for n in runs]), F.col("labelling"))
    # Only K-means reports an inertia; it is the cost of its own centres.
    inertia = F.when(F.col("labelling") == "kmeans", F.lit(runs["kmeans"].model.cost))
    table = table.withColumns({"position": order.cast("int"), "inertia": inertia})
    return table.withColumnRenamed("labelling", "algorithm"), runs


def best_algorithm(table: DataFrame, by: str = "silhouette_estimate") -> str | None:
    """Highest silhouette ``by`` above -1; the earlier algorithm on ties."""
    best = table.where(F.col(by) > -1).orderBy(F.desc(by), "position").first()
    return best["algorithm"] if best else None
