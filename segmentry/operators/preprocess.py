"""Impute, cap, drop correlated and flat columns, scale, optional PCA.

``Preprocessor.fit`` reads the frame a few times for small statistics and
returns a ``PreprocessModel`` whose ``transform`` is one projection.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions import OrderStats, finite_sql, number, numeric_columns, order_statistics, quoted
from segmentry.session import gathered

STRATEGIES = ("median", "mean", "mode", "drop")


@dataclass
class PreprocessModel:
    """Everything learnt at fit time; plain values, so it saves as one JSON line."""

    key: str
    strategy: str
    columns: list[str]
    empty: list[str]
    fills: dict[str, float]
    caps: dict[str, list[float]]
    correlated: list[str]
    low_variance: list[str]
    kept: list[str]
    centers: dict[str, float]
    scales: dict[str, float]
    pca_mean: list[float] = field(default_factory=list)
    pca_components: list[list[float]] = field(default_factory=list)
    pca_ratio: list[float] = field(default_factory=list)

    @property
    def feature_names(self) -> list[str]:
        if self.pca_components:
            return [f"PC{i + 1}" for i in range(len(self.pca_components))]
        return list(self.kept)

    # The projections span dozens of columns, so they are written as SQL text:
    # one call into the JVM instead of one per node of every expression.

    def filled(self, col: str) -> str:
        return self._fill(col, finite_sql(col))

    def capped(self, col: str) -> str:
        return self._cap(col, self.filled(col))

    def scaled(self, col: str) -> str:
        return self._scale(col, self.capped(col))

    def _fill(self, col: str, value: str) -> str:
        return f"coalesce({value}, {number(self.fills[col])})" if col in self.fills else value

    def _cap(self, col: str, value: str) -> str:
        if col not in self.caps:
            return value
        low, high = self.caps[col]
        return f"greatest({number(low)}, least({number(high)}, {value}))"

    def _scale(self, col: str, value: str) -> str:
        return f"({value} - {number(self.centers[col])}) / {number(self.scales[col])}"

    def stage(self, df: DataFrame, expression, cols: list[str]) -> DataFrame:
        """Key plus one of the stages above for some columns."""
        return self._rows(df).selectExpr(quoted(self.key), *[f"{expression(c)} AS {quoted(c)}" for c in cols])

    def _rows(self, df: DataFrame) -> DataFrame:
        if self.strategy != "drop":
            return df
        return df.where(" AND ".join(f"{finite_sql(c)} IS NOT NULL" for c in self.columns))

    def transform(self, df: DataFrame) -> DataFrame:
        """Key plus the scaled surviving columns, or the principal components."""
        scaled = self.stage(df, self.scaled, self.kept)
        if not self.pca_components:
            return scaled
        return scaled.selectExpr(
            quoted(self.key),
            *[
                f"{projection_sql(self.kept, self.pca_mean, loadings)} AS {name}"
                for name, loadings in zip(self.feature_names, self.pca_components)
            ],
        )

    def vectors(self, df: DataFrame) -> DataFrame:
        """``(id, features array<double>)`` for the clustering operators."""
        return to_vectors(self.transform(df), self.key, self.feature_names)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> PreprocessModel:
        return PreprocessModel(**json.loads(spark.read.text(path).first()["value"]))


@dataclass
class Preprocessor:
    scaling_method: str = "robust"
    correlation_threshold: float = settings.CORRELATION_THRESHOLD
    variance_threshold: float = settings.VARIANCE_THRESHOLD
    outlier_iqr_multiplier: float = settings.IQR_MULTIPLIER
    outlier_cap_percentiles: tuple[float, float] | None = settings.CAP_PERCENTILES
    use_pca: bool = False
    pca_variance_explained: float = settings.PCA_VARIANCE
    missing_value_strategy: str = "median"
    key: str = "user_id"

    def fit(self, df: DataFrame) -> PreprocessModel:
        if self.missing_value_strategy not in STRATEGIES:
            raise ValueError(f"Unknown missing value strategy: {self.missing_value_strategy}")
        cols = numeric_columns(df, {self.key})
        if not cols:
            raise ValueError("No numeric columns found for preprocessing")
        model = PreprocessModel(
            self.key, self.missing_value_strategy, cols, [], {}, {}, [], [], [], {}, {}
        )
        kept = df.selectExpr(*[f"{finite_sql(c)} AS {quoted(c)}" for c in cols]).persist()
        try:
            total = kept.count()
            plain = gathered(kept, total)
            stats = self._fit_fills(plain, total, model)
            self._fit_caps(stats, model)
            # Evaluated once, then read by the correlation, the moments and the PCA.
            capped = model._rows(plain).selectExpr(
                *[f"{model._cap(c, model._fill(c, quoted(c)))} AS {quoted(c)}" for c in model.columns]
            ).persist()
            model.correlated = correlated_columns(capped, model.columns, self.correlation_threshold)
            left = [c for c in model.columns if c not in model.correlated]
            moments = capped.selectExpr(
                *[f"var_pop({quoted(c)}) AS v{i}" for i, c in enumerate(left)],
                *[f"avg({quoted(c)}) AS m{i}" for i, c in enumerate(left)],
            ).first()
            variance = {c: moments[f"v{i}"] for i, c in enumerate(left)}
            mean = {c: moments[f"m{i}"] for i, c in enumerate(left)}
            model.kept = [c for c in left if variance[c] > self.variance_threshold]
            model.low_variance = [c for c in left if c not in model.kept]
            if not model.kept:
                raise ValueError("No feature varies enough to be kept")
            for c in model.kept:
                if self.scaling_method == "robust":
                    center, scale = self._robust(stats[c], model.caps.get(c))
                else:
                    center, scale = mean[c], variance[c] ** 0.5
                model.centers[c], model.scales[c] = center, scale if scale > 0 else 1.0
            if self.use_pca:
                self._fit_pca(capped, model)
            capped.unpersist()
        finally:
            kept.unpersist()
        return model

    def fit_transform(self, df: DataFrame) -> tuple[PreprocessModel, DataFrame]:
        model = self.fit(df)
        return model, model.transform(df)

    # -- parts of fit ---------------------------------------------------------

    def _probs(self) -> list[float]:
        caps = [p / 100 for p in self.outlier_cap_percentiles or ()]
        return sorted({0.25, 0.5, 0.75, *caps})

    def _fit_fills(self, plain: DataFrame, total: int, model: PreprocessModel) -> dict[str, OrderStats]:
        """Fill values, and order statistics of the columns after filling."""
        if model.strategy == "drop":
            counts = plain.selectExpr(*[f"count({quoted(c)}) AS {quoted(c)}" for c in model.columns]).first()
            model.empty = [c for c in model.columns if counts[c] == 0]
            model.columns = [c for c in model.columns if counts[c]]
            return order_statistics(model._rows(plain), model.columns, self._probs())
        stats = order_statistics(plain, model.columns, self._probs())
        model.empty = [c for c in model.columns if stats[c].n == 0]
        model.columns = [c for c in model.columns if stats[c].n]
        if model.strategy == "mean":
            means = plain.selectExpr(*[f"avg({quoted(c)}) AS {quoted(c)}" for c in model.columns]).first()
            model.fills = {c: means[c] for c in model.columns}
        elif model.strategy == "mode":
            model.fills = column_modes(plain, model.columns)
        else:
            model.fills = {c: stats[c].quantile(0.5) for c in model.columns}
        holed = [c for c in model.columns if stats[c].n < total]
        if holed:
            refilled = plain.selectExpr(*[f"{model._fill(c, quoted(c))} AS {quoted(c)}" for c in holed])
            stats |= order_statistics(refilled, holed, self._probs())
        return stats

    def _fit_caps(self, stats: dict[str, OrderStats], model: PreprocessModel) -> None:
        """IQR bounds, then percentiles of the column already clipped to them.

        Clipping keeps the order, so the second set comes from the same order
        statistics without another pass.
        """
        for c in model.columns:
            q1, q3 = stats[c].quantile(0.25), stats[c].quantile(0.75)
            spread = q3 - q1
            if spread <= 0:
                continue
            low, high = q1 - self.outlier_iqr_multiplier * spread, q3 + self.outlier_iqr_multiplier * spread
            if self.outlier_cap_percentiles:
                bounds = low, high
                low, high = (
                    stats[c].quantile(p / 100, via=lambda v: min(max(v, bounds[0]), bounds[1]))
                    for p in self.outlier_cap_percentiles
                )
            model.caps[c] = [low, high]

    @staticmethod
    def _robust(stats: OrderStats, cap: list[float] | None) -> tuple[float, float]:
        def clip(v):
            return min(max(v, cap[0]), cap[1]) if cap else v

        return stats.quantile(0.5, clip), stats.quantile(0.75, clip) - stats.quantile(0.25, clip)

    def _fit_pca(self, capped: DataFrame, model: PreprocessModel) -> None:
        scaled = capped.selectExpr(*[f"{model._scale(c, quoted(c))} AS {quoted(c)}" for c in model.kept])
        mean, components, ratio = principal_components(scaled, model.kept, len(model.kept))
        wanted = int(np.searchsorted(np.cumsum(ratio), self.pca_variance_explained, side="right")) + 1
        wanted = min(wanted, len(ratio))
        model.pca_mean, model.pca_components = mean, [list(map(float, row)) for row in components[:wanted]]
        model.pca_ratio = [float(r) for r in ratio[:wanted]]


def to_vectors(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return df.selectExpr(f"{quoted(key)} AS id", f"{array_sql(cols)} AS features")


def array_sql(cols: list[str]) -> str:
    return "array(" + ", ".join(f"CAST({quoted(c)} AS DOUBLE)" for c in cols) + ")"


def projection_sql(cols: list[str], means: list[float], loadings: list[float]) -> str:
    """Centred columns times loadings."""
    return " + ".join(f"({quoted(c)} - {number(m)}) * {number(w)}" for c, m, w in zip(cols, means, loadings))


def column_modes(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Most frequent value of each column, smallest on ties."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "feature", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("n"), "value"))["value"].alias("mode"))
    return {r["feature"]: r["mode"] for r in best.collect()}


def correlation_matrix(df: DataFrame, cols: list[str]) -> np.ndarray:
    """d x d Pearson matrix (NaN where a column is constant), summed on the executors."""
    vectors = df.select(array_to_vector(F.expr(array_sql(cols))).alias("v"))
    matrix = Correlation.corr(vectors, "v", "pearson").first()[0].toArray()
    return np.asarray(matrix)


def correlated_columns(df: DataFrame, cols: list[str], threshold: float) -> list[str]:
    """Columns too close to any earlier one, whether or not that one is dropped itself."""
    if len(cols) < 2:
        return []
    above = np.triu(np.abs(correlation_matrix(df, cols)), k=1) > threshold  # NaN compares false
    return [c for j, c in enumerate(cols) if above[:, j].any()]


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Lower triangle ``(feature_a, feature_b, r)`` with ``feature_b`` earlier than ``feature_a``."""
    matrix = correlation_matrix(df, cols)
    rows = [
        (a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(cols)
        for j, b in enumerate(cols[:i])
    ]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, r double")


def principal_components(df: DataFrame, cols: list[str], k: int) -> tuple[list[float], np.ndarray, np.ndarray]:
    """Column means, the first ``k`` components (rows) and their variance ratios.

    Each component's sign makes its largest loading positive.
    """
    means = df.selectExpr(*[f"avg({quoted(c)}) AS m{i}" for i, c in enumerate(cols)]).first()
    centered = F.expr("array(" + ", ".join(f"{quoted(c)} - {number(m)}" for c, m in zip(cols, means)) + ")")
    fitted = PCA(k=k, inputCol="v", outputCol="p").fit(df.select(array_to_vector(centered).alias("v")))
    components = fitted.pc.toArray().T
    lead = np.abs(components).argmax(axis=1)
    components = components * np.sign(components[np.arange(len(components)), lead])[:, None]
    return list(means), components, fitted.explainedVariance.toArray()
