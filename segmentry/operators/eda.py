"""Descriptive tables: funnel, activity, distributions, histograms, box statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions import exact_quantiles
from segmentry.functions.ranks import BROADCAST_ROWS
from segmentry.session import materialize


def _row(spark, values: dict, schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(values.values())], schema)


def conversion_funnel(events: DataFrame) -> DataFrame:
    """Percent of carts per view, purchases per cart, purchases per view.

    A step is NULL when any of the three event types is missing from the log.
    """
    n = events.agg(
        *[F.count_if(F.col("event_type") == t).alias(t) for t in ("view", "cart", "purchase")]
    )
    complete = (F.col("view") > 0) & (F.col("cart") > 0) & (F.col("purchase") > 0)

    def percent(num: str, den: str) -> Column:
        return F.when(complete, F.col(num) / F.col(den) * 100)

    return n.select(
        percent("cart", "view").alias("view_to_cart_pct"),
        percent("purchase", "cart").alias("cart_to_purchase_pct"),
        percent("purchase", "view").alias("view_to_purchase_pct"),
    )


def date_range(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


def hourly_activity(events: DataFrame) -> DataFrame:
    """``(hour, n_events, is_peak)``; the earliest hour wins a tie for the peak."""
    hours = (
        events.where(F.col("event_time").isNotNull())
        .groupBy(F.hour("event_time").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    peak = hours.agg(F.min_by("hour", F.struct(-F.col("n_events"), "hour"))).scalar()
    return hours.withColumn("is_peak", F.col("hour") == peak)


def weekday_activity(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("event_time").isNotNull())
        .groupBy(F.date_format("event_time", "EEEE").alias("day_of_week"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def events_by_hour_and_type(events: DataFrame, types: list[str] | None = None) -> DataFrame:
    """One row per hour, one count column per event type, 0 where there is none."""
    known = events.where(F.col("event_time").isNotNull() & F.col("event_type").isNotNull())
    return known.groupBy(F.hour("event_time").alias("hour")).pivot("event_type", types).count().na.fill(0)


def distinct_entities(events: DataFrame) -> DataFrame:
    """Distinct users, products, categories and sessions.

    Each id is folded to its distinct values first (grouping sets over one scan),
    so the final count adds up partial counts instead of holding a set.
    """
    ids = ["user_id", "product_id", "category_id", "user_session"]
    sets = events.groupingSets([[F.col(c)] for c in ids], *ids).agg(F.grouping_id().alias("_gid"))
    full = (1 << len(ids)) - 1

    def distinct(i: int) -> Column:
        member = F.col("_gid") == full - (1 << (len(ids) - 1 - i))
        return F.count_if(member & F.col(ids[i]).isNotNull())

    names = ["unique_users", "unique_products", "unique_categories", "unique_sessions"]
    return sets.agg(*[distinct(i).alias(name) for i, name in enumerate(names)])


def events_per_user(events: DataFrame) -> DataFrame:
    return events.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))


def events_per_user_stats(events: DataFrame) -> DataFrame:
    """Mean, median and maximum number of events per user."""
    # Few counts differ, so the median is read off (count, users) and not off users.
    per_user = events_per_user(events).persist()
    head = per_user.agg(F.avg("n_events"), F.max("n_events")).first()
    median = exact_quantiles(per_user, ["n_events"], [0.5])["n_events"][0]
    per_user.unpersist()
    values = {"mean_events": head[0], "median_events": median, "max_events": head[1]}
    return _row(events.sparkSession, values, "mean_events double, median_events double, max_events bigint")


def purchase_stats(events: DataFrame) -> DataFrame:
    """Purchases, mean and median price, revenue."""
    bought = events.where(F.col("event_type") == "purchase").select("price")
    head = bought.agg(F.count(F.lit(1)), F.avg("price"), F.coalesce(F.sum("price"), F.lit(0.0))).first()
    median = exact_quantiles(bought, ["price"], [0.5])["price"][0]
    values = {"total_purchases": head[0], "avg_order_value": head[1], "median_order_value": median, "total_revenue": head[2]}
    return _row(
        events.sparkSession,
        values,
        "total_purchases bigint, avg_order_value double, median_order_value double, total_revenue double",
    )


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(feature, count, mean, std, min, q25, median, q75, max)`` with exact quartiles."""
    wide = df.agg(
        *[
            f(F.col(c).cast("double")).alias(f"{name}{i}")
            for i, c in enumerate(cols)
            for name, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_samp), ("lo", F.min), ("hi", F.max))
        ]
    ).first()
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = [
        (c, wide[f"n{i}"], wide[f"m{i}"], wide[f"s{i}"], wide[f"lo{i}"], *quartiles[c], wide[f"hi{i}"])
        for i, c in enumerate(cols)
    ]
    schema = "feature string, count bigint, mean double, std double, min double, q25 double, median double, q75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)


def _bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the maximum falls into the last bin."""
    position = F.floor((value - low) / (high - low) * bins)
    return F.when(high > low, F.least(position, F.lit(bins - 1))).otherwise(F.lit(bins // 2)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """``(bin, bin_low, bin_high, n)`` for every bin, empty ones included.

    A column with one value gets a unit-wide range centred on it.
    """
    values = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_low double, bin_high double, n bigint")
    index = _bin_index(F.col("v"), F.lit(low), F.lit(high), bins)
    counts = values.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    if high == low:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histogram_by_cluster(df: DataFrame, col: str, bins: int = 30, cluster: str = "cluster") -> DataFrame:
    """``(cluster, bin, n)`` over each cluster's own range, empty bins included."""
    values = df.select(F.col(cluster).alias("cluster"), F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    ranges = materialize(values.groupBy("cluster").agg(F.min("v").alias("low"), F.max("v").alias("high")))
    # Beyond the bound, adaptive execution splits the rows of a large cluster.
    side = F.broadcast(ranges) if ranges.count() <= BROADCAST_ROWS else ranges
    index = _bin_index(F.col("v"), F.col("low"), F.col("high"), bins)
    filled = values.join(side, "cluster").groupBy("cluster", index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = ranges.select("cluster", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(filled, ["cluster", "bin"], "left").select("cluster", "bin", F.coalesce("n", F.lit(0)).alias("n"))


def box_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR of the box) and outlier counts."""
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    cols = [c for c in cols if quartiles[c][0] is not None]
    fences = {c: (q[0] - 1.5 * (q[2] - q[0]), q[2] + 1.5 * (q[2] - q[0])) for c, q in quartiles.items() if c in cols}
    aggs = []
    for i, c in enumerate(cols):
        v, (low, high) = F.col(c).cast("double"), fences[c]
        aggs += [
            F.min(F.when(v >= low, v)).alias(f"lo{i}"),
            F.max(F.when(v <= high, v)).alias(f"hi{i}"),
            F.count_if((v < low) | (v > high)).alias(f"out{i}"),
        ]
    row = df.agg(*aggs).first()
    rows = [(c, *quartiles[c], row[f"lo{i}"], row[f"hi{i}"], row[f"out{i}"]) for i, c in enumerate(cols)]
    schema = "feature string, q25 double, median double, q75 double, whisker_low double, whisker_high double, n_outliers bigint"
    return df.sparkSession.createDataFrame(rows, schema)
