"""Cluster profiles and the tables behind the cluster charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions import numeric_columns, quoted
from segmentry.operators.preprocess import principal_components, projection_sql


def attach_labels(customers: DataFrame, labels: DataFrame, key: str = "user_id") -> DataFrame:
    """Put ``cluster`` on the customer rows by key, never by position."""
    return customers.join(labels.select(F.col("id").alias(key), "cluster"), key)


def cluster_profiles(df: DataFrame, cols: list[str] | None = None, cluster: str = "cluster") -> DataFrame:
    """Mean of every feature per cluster, plus ``cluster_size``; NULLs are skipped."""
    cols = cols or numeric_columns(df, {cluster, "user_id", "id"})
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("cluster_size"))


def profile_long(profiles: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, feature, mean)``."""
    cols = [c for c in profiles.columns if c not in (cluster, "cluster_size")]
    wide = profiles.select(cluster, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot([cluster], cols, "feature", "mean")


def top_variance_features(profiles: DataFrame, n: int = 10, cluster: str = "cluster") -> DataFrame:
    """The ``n`` features whose cluster means vary most (sample variance)."""
    long = profile_long(profiles, cluster)
    return (
        long.groupBy("feature")
        .agg(F.var_samp("mean").alias("variance"))
        .orderBy(F.desc_nulls_last("variance"), "feature")
        .limit(n)
    )


def normalised_profiles(profiles: DataFrame, cols: list[str] | None = None, cluster: str = "cluster") -> DataFrame:
    """``(cluster, feature, mean, normalised)`` with min-max over the clusters."""
    long = profile_long(profiles.select(cluster, *cols) if cols else profiles, cluster)
    over = Window.partitionBy("feature")  # one row per cluster
    low, high = F.min("mean").over(over), F.max("mean").over(over)
    return long.withColumn("normalised", (F.col("mean") - low) / (high - low + settings.NORMALISE_EPSILON))


def radar_profiles(profiles: DataFrame, features: list[str], cluster: str = "cluster") -> DataFrame:
    """Normalised profile of at most the first eight features."""
    return normalised_profiles(profiles, features[:8], cluster)


def cluster_sizes(labels: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, cluster_size, share)``."""
    sizes = labels.groupBy(cluster).agg(F.count(F.lit(1)).alias("cluster_size"))
    total = sizes.agg(F.sum("cluster_size")).scalar()
    return sizes.withColumn("share", F.col("cluster_size") / total)


def size_summary(labels: DataFrame, cluster: str = "cluster") -> DataFrame:
    return (
        labels.groupBy(cluster)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.min("n").alias("min_cluster_size"),
            F.max("n").alias("max_cluster_size"),
            F.avg("n").alias("avg_cluster_size"),
        )
    )


def business_summary(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Size, share, mean activity, spend among spenders, revenue, conversion, mean RFM scores."""
    spend = F.col("total_spending")
    scores = [c for c in ("recency_score", "frequency_score", "monetary_score") if c in df.columns]
    out = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("cluster_size"),
        F.avg("total_events").alias("avg_events"),
        F.avg("purchase_count").alias("avg_purchases"),
        F.avg(F.when(spend > 0, spend)).alias("avg_spending"),
        F.sum("total_spending").alias("total_revenue"),
        F.avg("purchase_conversion_rate").alias("conversion_rate"),
        F.avg("unique_products_viewed").alias("avg_products"),
        F.avg("unique_categories").alias("avg_categories"),
        *[F.avg(c).alias(f"avg_{c}") for c in scores],
    )
    # The revenue total runs over one row per cluster.
    share = F.col("cluster_size") / F.sum("cluster_size").over(Window.partitionBy())
    return out.withColumn("share", share)


def grade(scores: DataFrame, silhouette: str = "silhouette_score") -> DataFrame:
    """``silhouette_grade`` and ``separation_grade`` of a metrics table."""

    def graded(hit, steps, last):
        out = F.lit(last)
        for limit, label in reversed(steps):
            out = F.when(hit(limit), label).otherwise(out)
        return out

    return scores.withColumns(
        {
            "silhouette_grade": graded(lambda v: F.col(silhouette) > v, *settings.SILHOUETTE_GRADES),
            "separation_grade": graded(lambda v: F.col("davies_bouldin") < v, *settings.DB_GRADES),
        }
    )


def pca_projection(df: DataFrame, cols: list[str], n_components: int = 2, keep: tuple[str, ...] = ()) -> tuple[DataFrame, list[float]]:
    """Rows in the plane or space of the first components, and the variance ratios."""
    if n_components not in (2, 3):
        raise ValueError("n_components must be 2 or 3")
    means, components, ratio = principal_components(df, cols, n_components)
    points = [f"{projection_sql(cols, means, row)} AS PC{i + 1}" for i, row in enumerate(components)]
    return df.selectExpr(*[quoted(c) for c in keep], *points), [float(r) for r in ratio]
