"""Saved pipelines of the library's own ``pyspark.ml`` stages."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from segmentry.operators.preprocess import Preprocessor
from segmentry.operators.stages import CustomerSegments, FeaturePreprocessor


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(c, 0.5, (80, 3)) for c in ((0, 0, 0), (6, 0, 2), (0, 7, 5))])
    rows = [(i, float(a), float(b), float(a * 2), None if i % 17 == 0 else float(c), 1.0) for i, (a, b, c) in enumerate(x)]
    return spark.createDataFrame(rows, "user_id bigint, a double, b double, twice double, c double, flat double")


def test_a_saved_pipeline_places_new_customers(spark, customers, tmp_path):
    stages = [FeaturePreprocessor(scalingMethod="standard"), CustomerSegments(k=3, starts=3, predictionCol="segment")]
    model = Pipeline(stages=stages).fit(customers)
    want = {r["id"]: r["segment"] for r in model.transform(customers).collect()}
    assert len(want) == 240 and all(len({want[i] for i in range(a, a + 80)}) == 1 for a in (0, 80, 160))
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    assert {r["id"]: r["segment"] for r in back.transform(customers).collect()} == want
    assert back.stages[0].getOrDefault("scalingMethod") == "standard" and back.stages[1].getOrDefault("k") == 3
    assert back.stages[0].learnt.feature_names == model.stages[0].learnt.feature_names and len(back.stages[1].centers) == 3
    new = customers.where("user_id = 5").withColumn("user_id", F.lit(9_000).cast("bigint"))
    assert [(r["id"], r["segment"]) for r in back.transform(new).collect()] == [(9_000, want[5])]


def test_stages_do_what_the_preprocessor_does(spark, customers):
    plain = Preprocessor().fit(customers)
    staged = FeaturePreprocessor().fit(customers)
    a, b = (dict(m.collect()) for m in (plain.vectors(customers), staged.transform(customers)))
    assert a == b and plain.correlated == staged.learnt.correlated and plain.low_variance == ["flat"]


def test_unfitted_stages_are_kept(tmp_path):
    stages = [FeaturePreprocessor(missingValues="mean", pcaVariance=0.9), CustomerSegments(k=7)]
    Pipeline(stages=stages).write().overwrite().save(str(tmp_path / "p"))
    back = Pipeline.load(str(tmp_path / "p")).getStages()
    assert back[0].getOrDefault("missingValues") == "mean" and back[0].getOrDefault("pcaVariance") == 0.9
    assert back[1].getOrDefault("k") == 7 and back[1].uid == stages[1].uid
