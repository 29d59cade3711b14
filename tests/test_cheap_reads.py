"""Ranks and order statistics of few rows in few jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from segmentry.functions import quantiles, ranks


def test_order_statistics_of_many_columns_are_read_at_once(spark, monkeypatch):
    x = np.random.default_rng(2).normal(size=(50, 40))
    wide = spark.createDataFrame(x.tolist(), [f"f{i}" for i in range(40)])
    reads, read = [], quantiles._read
    monkeypatch.setattr(quantiles, "_read", lambda work, index, groups: (reads.append(len(groups)), read(work, index, groups)))
    found = quantiles.exact_quantiles(wide, wide.columns, [0.1, 0.5])
    assert reads == [40]
    assert all(np.allclose(found[f"f{i}"], np.quantile(x[:, i], [0.1, 0.5])) for i in range(40))
    monkeypatch.setattr(quantiles, "BRACKETS_PER_READ", 7)
    assert quantiles.exact_quantiles(wide, wide.columns, [0.1, 0.5]) == found and max(reads[1:]) == 7


def test_few_values_are_ranked_in_few_buckets(spark, monkeypatch):
    df = spark.range(300).select((F.col("id") * 7 % 100).cast("double").alias("v"))
    asked, sketch = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda col, grid, *more: (asked.append(len(grid)), sketch(col, grid, *more))[1])

    def ranked():
        return {r["value"]: r["avg_rank"] for r in ranks.value_ranks(ranks.count_values(df, F.col("v"))).collect()}

    one = ranked()
    assert asked == [] and one == {float(v): 3.0 * v + 2 for v in range(100)}
    monkeypatch.setattr(ranks, "VALUES_PER_BUCKET", 9)
    assert ranked() == one and asked == [11]
