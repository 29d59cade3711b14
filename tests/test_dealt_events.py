"""Events over tasks of a bounded number of rows."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from segmentry.operators import customers, rfm


def log(spark, n: int):
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (i, start + datetime.timedelta(minutes=37 * i), ("view", "cart", "purchase")[i % 3], i % 11, i % 4, f"c{i % 4}", f"b{i % 5}",
         float(i % 17), None if i % 50 == 0 else (0 if i % 3 else i % 13), f"s{i // 6}")
        for i in range(n)
    ]
    schema = (
        "event_id bigint, event_time timestamp, event_type string, product_id bigint, category_id bigint, category_code string, "
        "brand string, price double, user_id bigint, user_session string"
    )
    return spark.createDataFrame(rows, schema)


def test_distinct_values_of_bounded_events_per_task(spark, monkeypatch):
    events = log(spark, 600).coalesce(1)
    whole = customers.customer_features(events, preferred=True)
    columns = [F.round(c, 9).alias(c) if kind == "double" else F.col(c) for c, kind in whole.dtypes]
    expected = sorted(map(tuple, whole.select(*columns).collect()))
    monkeypatch.setattr(customers, "EVENTS_PER_TASK", 100)
    dealt = customers._dealt(events.withColumn("_t", F.col("event_time")), "user_id")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 200  # a customer with two thirds of the events is spread
    found = customers.customer_features(events, preferred=True).select(*columns).collect()
    assert sorted(map(tuple, found)) == expected


def test_customer_table_is_few_partitions(spark):
    assert rfm.aggregate_events(log(spark, 300).repartition(8)).rdd.getNumPartitions() == 1
