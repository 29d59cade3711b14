"""Preprocessing against NumPy, its options, and its saved form."""

import numpy as np
import pytest

from segmentry.operators.preprocess import Preprocessor, PreprocessModel, correlation_pairs


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(42)
    x = rng.normal(size=(300, 6)) * [1, 5, 1, 0.01, 1, 1]
    x[:10, 1] = 1000.0
    x[:, 4] = x[:, 1] * 2  # copy of column 1
    x[:, 5] = 3.0  # constant
    x[20:30, 0] = np.nan
    return x


def frame(spark, x):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(x)]
    cols = ", ".join(f"c{j} double" for j in range(x.shape[1]))
    return spark.createDataFrame(rows, f"user_id bigint, {cols}, gap double".replace(", gap double", ""))


def capped(x):
    x = np.where(np.isnan(x), np.nanmedian(x, axis=0), x)
    out = x.copy()
    for j in range(x.shape[1]):
        q1, q3 = np.quantile(x[:, j], [0.25, 0.75])
        if q3 > q1:
            c = np.clip(x[:, j], q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
            out[:, j] = np.clip(c, *np.quantile(c, [0.05, 0.95]))
    return out


def values(df, cols):
    return np.array([[r[c] for c in cols] for r in df.orderBy("user_id").collect()])


def test_default_chain(spark, data):
    model, out = Preprocessor().fit_transform(frame(spark, data))
    assert model.correlated == ["c4"]
    assert model.low_variance == ["c3", "c5"]
    assert model.feature_names == ["c0", "c1", "c2"]
    want = capped(data)[:, :3]
    q1, mid, q3 = np.quantile(want, [0.25, 0.5, 0.75], axis=0)
    np.testing.assert_allclose(values(out, model.kept), (want - mid) / (q3 - q1), atol=1e-9)


def test_standard_scaling_uses_the_population_spread(spark, data):
    model, out = Preprocessor(scaling_method="standard").fit_transform(frame(spark, data))
    got = values(out, model.kept)
    np.testing.assert_allclose(got.mean(axis=0), 0, atol=1e-9)
    np.testing.assert_allclose(got.std(axis=0), 1, atol=1e-9)


def test_strategies(spark):
    x = np.array([[1.0, 1], [1, 2], [4, 3], [np.nan, 4], [6, 5]])
    fills = {s: Preprocessor(missing_value_strategy=s, variance_threshold=-1).fit(frame(spark, x)).fills for s in ("median", "mean", "mode")}
    assert fills["median"]["c0"] == 2.5 and fills["mean"]["c0"] == 3.0 and fills["mode"]["c0"] == 1.0
    model, out = Preprocessor(missing_value_strategy="drop", variance_threshold=-1).fit_transform(frame(spark, x))
    assert out.count() == 4
    with pytest.raises(ValueError):
        Preprocessor(missing_value_strategy="other").fit(frame(spark, x))


def test_empty_columns_are_recorded(spark, data):
    x = np.column_stack([data[:, :2], np.full(len(data), np.nan)])
    model = Preprocessor().fit(frame(spark, x))
    assert model.empty == ["c2"] and "c2" not in model.feature_names


def test_percentile_caps_can_be_off(spark, data):
    model = Preprocessor(outlier_cap_percentiles=None).fit(frame(spark, data))
    q1, q3 = np.quantile(data[:, 1], [0.25, 0.75])
    np.testing.assert_allclose(model.caps["c1"], [q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)])


def test_pca_centres_and_keeps_enough_variance(spark, data):
    model, out = Preprocessor(use_pca=True, scaling_method="standard").fit_transform(frame(spark, data))
    got = values(out, model.feature_names)
    assert model.feature_names[0] == "PC1"
    np.testing.assert_allclose(got.mean(axis=0), 0, atol=1e-8)
    want = np.linalg.eigvalsh(np.cov(values(Preprocessor(scaling_method="standard").fit_transform(frame(spark, data))[1], model.kept).T))[::-1]
    np.testing.assert_allclose(got.var(axis=0, ddof=1), want[: got.shape[1]], rtol=1e-6)
    assert sum(model.pca_ratio) > 0.95 or len(model.pca_ratio) == len(model.kept)


def test_saved_model_transforms_new_rows_alike(spark, data, tmp_path):
    df = frame(spark, data)
    model = Preprocessor(use_pca=True).fit(df)
    model.save(spark, str(tmp_path / "p"))
    loaded = PreprocessModel.load(spark, str(tmp_path / "p"))
    assert loaded == model
    few = df.where("user_id < 7")  # bounds come from the fit, not from these rows
    np.testing.assert_array_equal(values(loaded.transform(few), model.feature_names), values(model.transform(df), model.feature_names)[:7])
    assert loaded.vectors(few).count() == 7


def test_no_numbers(spark):
    with pytest.raises(ValueError, match="numeric"):
        Preprocessor().fit(spark.createDataFrame([(1, "x")], "user_id bigint, a string"))


def test_correlation_of_a_constant_is_null(spark, data):
    rows = {(r["feature_a"], r["feature_b"]): r["r"] for r in correlation_pairs(frame(spark, data[30:]), ["c1", "c4", "c5"]).collect()}
    assert rows["c4", "c1"] == pytest.approx(np.corrcoef(data[30:, 1], data[30:, 4])[0, 1])
    assert rows["c5", "c1"] is None
