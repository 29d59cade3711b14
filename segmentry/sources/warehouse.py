"""Adapters from the warehouse tables (``events``, ``part``, ``orders``, ``embeddings``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table in the canonical event schema.

    The whole catalogue is joined; a product key it lacks keeps its event without type and
    brand.  Catalyst broadcasts the catalogue while it is small, and adaptive
    execution splits the events of a hot product beyond.
    """
    raw = F.regexp_extract("props", "[0-9]+", 0)
    events = table(spark, sf_dir, "events").withColumn("product_id", F.when(raw != "", raw.cast("bigint")))
    catalogue = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return events.join(catalogue, F.col("product_id") == F.col("p_partkey"), "left").select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        "product_id",
        (F.col("product_id") % 10).alias("category_id"),
        F.when(F.col("product_id") % 7 == 0, None).otherwise(F.col("p_type")).alias("category_code"),
        F.when(F.col("product_id") % 10 == 0, None).otherwise(F.col("p_brand")).alias("brand"),
        F.col("value").alias("price"),
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("user_session"),
    )


def events_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge-case form of the same events, none left out: by the last digit of the user, customers without
    views (1), purchases (2, 5, 6) or carts (3), a customer of its own for every event (4), equal times (8)."""
    events = events_canonical(spark, sf_dir)
    digit, kind = F.col("user_id") % 10, F.col("event_type")
    changed = (
        F.when((digit == 1) & (kind == "view"), "cart")
        .when(digit.isin(2, 5, 6) & (kind == "purchase"), "view")
        .when((digit == 3) & (kind == "cart"), "view")
        .otherwise(kind)
    )
    truncated = F.when(digit == 8, F.date_trunc("HOUR", "event_time").cast("timestamp_ntz"))
    return events.withColumns(
        {
            "event_type": changed,
            "event_time": F.coalesce(truncated, F.col("event_time")),
            "user_id": F.when(digit == 4, 1_000_000_000 + F.col("event_id")).otherwise(F.col("user_id")),
        }
    )


def order_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a customer table with the three columns RFM needs."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_custkey").isNotNull())
    start = orders.agg(F.min("o_orderdate")).scalar()
    days = F.floor(F.timestamp_diff("SECOND", start, F.max("o_orderdate")) / 86400)
    return orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count(F.lit(1)).alias("purchase_count"),
        F.sum("o_totalprice").alias("total_spending"),
        days.alias("days_since_last_event"),
    )


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as ``(id, features array<double>, cluster)``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").cast("int").alias("cluster"),
    )
