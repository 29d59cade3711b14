"""The whole job: events in; customer segments, comparison tables and a report out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.operators import kselect, profiles, segments
from segmentry.operators.engineer import engineer_features, select_features
from segmentry.operators.metrics import SILHOUETTE_COLUMNS
from segmentry.operators.preprocess import Preprocessor, PreprocessModel
from segmentry.operators.rfm import aggregate_events
from segmentry.plans.report import cluster_report
from segmentry.session import materialize
from segmentry.sources import write_csv, write_feature_names, write_text


@dataclass
class Result:
    customers: DataFrame  # engineered features with their cluster
    preprocessor: PreprocessModel
    k: int
    k_table: DataFrame | None  # None when K was given
    comparison: DataFrame | None
    best: segments.Segmentation
    profiles: DataFrame
    report: str


def segment_customers(
    events: DataFrame,
    algorithm: str | None = None,
    k: int | None = None,
    k_range: list[int] | None = None,
    n_init: int = settings.N_INIT,
    stability: bool = True,
    silhouette: str = "estimate",
    with_spectral: bool = True,
    preprocessor: Preprocessor | None = None,
    exclude: tuple[str, ...] = ("user_id",),
) -> Result:
    """Aggregate, engineer, preprocess, choose K, cluster, profile.

    The K range is trained only if no ``k`` is given.  With ``algorithm`` given only that one
    runs; otherwise all are compared and the one with the best silhouette is kept as it was
    fitted.  ``silhouette`` names the one that decides ("estimate", "exact" or "squared").
    """
    engineered = materialize(engineer_features(aggregate_events(events)))
    features = select_features(engineered, exclude)
    model = (preprocessor or Preprocessor()).fit(features)
    points = materialize(model.vectors(features))
    method, column = kselect.method_of(silhouette), SILHOUETTE_COLUMNS[silhouette]
    k_table, chosen_by = None, "given"
    if k is None:
        k_table, _ = kselect.evaluate_k(points, k_range, n_init, stability=stability, silhouette=silhouette)
        k, chosen_by = kselect.pick_k(k_table, method), method
    comparison = None
    if algorithm is None:
        comparison, runs = segments.compare_algorithms(points, k, with_spectral, silhouette, n_init=n_init)
        comparison = comparison.persist()
        winner = segments.best_algorithm(comparison, column) or "kmeans"
        best = runs[winner]
        best.metrics = comparison.where(F.col("algorithm") == winner).first().asDict()
    else:
        winner = algorithm
        best = segments.fit_segments(points, algorithm, k, silhouette=silhouette, **({"n_init": n_init} if algorithm in ("kmeans", "gmm", "spectral") else {}))
    clustered = materialize(profiles.attach_labels(engineered, best.labels))
    names = [c for c in features.columns if c != "user_id"]
    means = profiles.cluster_profiles(clustered, names)
    spark = events.sparkSession
    scores = spark.createDataFrame([(best.metrics[column], best.metrics["davies_bouldin"])], f"{column} double, davies_bouldin double")
    graded = best.metrics | profiles.grade(scores, column).first().asDict()
    run = {"algorithm": winner, "k": k, "k chosen by": chosen_by, "algorithm chosen by": "given" if algorithm else column}
    run |= {"silhouette": silhouette, "features": len(model.feature_names)}
    report = cluster_report(graded, profiles.cluster_sizes(best.labels), means, run)
    return Result(clustered, model, k, k_table, comparison, best, means, report)


def write_result(spark: SparkSession, result: Result, path: str) -> None:
    """Tables, models and the report under ``path`` in shared storage."""
    result.customers.write.mode("overwrite").parquet(f"{path}/customers")
    result.preprocessor.save(spark, f"{path}/preprocessor")
    write_feature_names(spark, result.preprocessor.feature_names, f"{path}/feature_names")
    result.best.save(f"{path}/clusterer")
    if result.k_table is not None:
        write_csv(result.k_table, f"{path}/cluster_selection_comparison")
    if result.comparison is not None:
        write_csv(result.comparison.drop("position"), f"{path}/algorithm_comparison")
    write_csv(result.profiles, f"{path}/cluster_profiles")
    write_text(spark, result.report, f"{path}/cluster_report")
