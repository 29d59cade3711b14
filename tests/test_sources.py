"""Sources, samples, sinks and the whole job."""

import pytest
from pyspark.sql import functions as F

from segmentry.operators import eda, profiles
from segmentry.plans.pipeline import segment_customers, write_result
from segmentry.sources import (
    exact_sample,
    load_events,
    prepare_events,
    read_feature_names,
    row_count,
    take_rows,
    union_inputs,
    write_csv,
)
from segmentry.sources.warehouse import events_canonical

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    events = events_canonical(spark, SF_DIR).drop("event_id")
    events.write.mode("overwrite").parquet(f"{path}/parquet")
    events.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    return path


def test_formats_agree(spark, log):
    a = load_events(spark, f"{log}/parquet")
    b = load_events(spark, f"{log}/csv", "csv", header=True)
    assert row_count(a).first()[0] == row_count(b).first()[0] == events_canonical(spark, SF_DIR).count()
    kinds = dict(b.dtypes)
    assert kinds["event_time"] == "timestamp" and kinds["user_id"] == "bigint" and kinds["price"] == "double"
    assert a.agg({"price": "sum"}).first()[0] == pytest.approx(b.agg({"price": "sum"}).first()[0])


def test_caps_and_samples(spark, log):
    events = load_events(spark, f"{log}/parquet")
    n = events.count()
    assert load_events(spark, f"{log}/parquet", max_rows=100).count() == 100
    assert take_rows(events, 0).count() == n
    sampled = load_events(spark, f"{log}/parquet", sample_fraction=0.3)
    assert sampled.count() == int(n * 0.3)
    keyed = events_canonical(spark, SF_DIR)
    one = exact_sample(keyed, 0.25, order_key="event_id")
    two = exact_sample(keyed.repartition(5), 0.25, order_key="event_id")
    assert one.count() == int(n * 0.25) == one.select("event_id").distinct().count()
    assert exact_sample(events, 0.5).count() == int(n * 0.5)
    assert one.select("event_id").exceptAll(two.select("event_id")).isEmpty()
    assert union_inputs([events, events.drop("brand")]).count() == 2 * n


def test_caps_keep_whole_partitions(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("v", 1000 - F.col("id"))
    for cap in (1, 142, 143, 500, 999, 1000, 5000):
        assert take_rows(df, cap).count() == min(cap, 1000)
    lowest = [r["id"] for r in take_rows(df, 10, ["v"]).orderBy("id").collect()]
    assert lowest == list(range(990, 1000))


@pytest.mark.parametrize("fraction", [0.05, 0.1, 0.25, 0.5, 0.99])
def test_samples_have_the_exact_size(spark, fraction):
    for rows, seeds in ((50, range(3)), (10_000, range(20) if fraction == 0.1 else range(2))):
        df = spark.range(rows)
        for seed in seeds:
            assert exact_sample(df, fraction, seed, "id").count() == int(rows * fraction)


def test_prepare(spark, log):
    events, report = prepare_events(spark, f"{log}/parquet")
    assert report.first()["row_count"] == events.count()
    assert prepare_events(spark, f"{log}/parquet", validate=False)[1] is None


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([(2, 0.5), (3, 0.25)], "k int, score double")
    write_csv(df, str(tmp_path / "t"))
    back = spark.read.csv(str(tmp_path / "t"), header=True, inferSchema=True)
    assert sorted(map(tuple, back.collect())) == [(2, 0.5), (3, 0.25)]


def test_histogram_of_one_value(spark):
    rows = eda.histogram(spark.createDataFrame([(4.0,)] * 5, "v double"), "v", 10).orderBy("bin").collect()
    assert sum(r["n"] for r in rows) == 5 and rows[0]["bin_low"] == 3.5 and rows[-1]["bin_high"] == 4.5
    assert rows[5]["n"] == 5


def test_projection_rejects_other_dimensions(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0)], "a double, b double")
    with pytest.raises(ValueError):
        profiles.pca_projection(df, ["a", "b"], 4)


def test_whole_job(spark, log, tmp_path):
    events = load_events(spark, f"{log}/parquet")
    result = segment_customers(events, k_range=[2, 3], n_init=2, stability=False)
    users = events.select("user_id").distinct().count()
    assert result.customers.count() == users
    assert result.customers.where("cluster IS NULL").isEmpty()
    assert result.comparison.count() == 9
    assert result.best.algorithm in result.report or "dbscan" in result.report
    assert "| k chosen by | silhouette_estimate |" in result.report and "| silhouette | estimate |" in result.report
    given = segment_customers(events, "kmeans", k=3, n_init=2)
    assert given.k_table is None and "| k chosen by | given |" in given.report
    out = str(tmp_path / "out")
    write_result(spark, result, out)
    assert read_feature_names(spark, f"{out}/feature_names") == result.preprocessor.feature_names
    assert "# Segments" in [r["value"] for r in spark.read.text(f"{out}/cluster_report").collect()]
    assert spark.read.parquet(f"{out}/customers").count() == users
