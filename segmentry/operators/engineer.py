"""Derived customer features: row-local expressions, one global rank, two value shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions import average_rank_share, finite_sql, numeric_columns, quoted, right_closed_bins, value_share


def behavioral_features(df: DataFrame, include_lowest: bool = False) -> DataFrame:
    """Intensity per day, loyalty and value scores, activity and spending levels.

    ``include_lowest`` puts zero spend into the first spending level; by default
    it falls below every bin and is NULL.
    """
    timed, spends = "time_span_hours" in df.columns, "total_spending" in df.columns
    days = F.col("time_span_hours") / 24 + 1 if timed else F.lit(1.0)
    buys = F.col("purchase_count")
    per_day = buys / days
    if spends:
        value = F.col("total_spending") * 0.7 + buys * 0.3
        level = right_closed_bins(F.col("total_spending"), *settings.SPENDING_BINS, include_lowest=include_lowest)
    else:
        value, level = buys.cast("double"), F.lit(settings.SPENDING_BINS[1][0])
    return df.withColumns(
        {
            "engagement_intensity": F.col("total_events") / days,
            "purchase_frequency": per_day,
            "loyalty_score": buys * 0.6 + per_day * 0.4,
            "value_score": value,
            "activity_level": right_closed_bins(F.col("total_events"), *settings.ACTIVITY_BINS),
            "spending_level": level,
        }
    )


def temporal_features(df: DataFrame) -> DataFrame:
    """Part-of-day flags from the peak hour and a session length class."""
    new = {}
    if "peak_activity_hour" in df.columns:
        hour = F.coalesce(F.col("peak_activity_hour"), F.lit(-1))
        night = hour.between(0, 5)
        new = {
            "is_morning_user": hour.between(6, 11).cast("int"),
            "is_afternoon_user": hour.between(12, 17).cast("int"),
            "is_evening_user": ((hour >= 18) | night).cast("int"),
        }
    if "avg_session_duration_hours" in df.columns:
        new["session_length_category"] = right_closed_bins(
            F.col("avg_session_duration_hours"), *settings.SESSION_BINS
        )
    else:
        new["session_length_category"] = F.lit(settings.SESSION_BINS[1][0])
    return df.withColumns(new)


def engagement_features(df: DataFrame) -> DataFrame:
    """Exploration against focus, breadth and brand loyalty."""
    have = set(df.columns)
    parts = [c for c in ("product_diversity", "category_diversity") if c in have]
    if len(parts) == 2:
        exploration = (F.col(parts[0]) + F.col(parts[1])) / 2
    else:
        exploration = F.col("product_diversity") if "product_diversity" in have else F.lit(0.0)
    breadth = F.col("unique_categories") if "unique_categories" in have else F.lit(0).cast("bigint")
    if {"unique_brands", "total_events"} <= have:
        loyalty = 1 - F.col("unique_brands") / (F.col("total_events") + 1)
    else:
        loyalty = F.lit(0.0)
    return df.withColumns(
        {
            "exploration_score": exploration,
            "focus_score": 1 - exploration,
            "is_multi_category_shopper": (breadth > 3).cast("int"),
            "category_breadth": breadth,
            "brand_loyalty_score": loyalty,
        }
    )


def price_features(df: DataFrame, key: str = "user_id", counted_on: DataFrame | None = None) -> DataFrame:
    """Price sensitivity, rank share of the mean viewed price and the flags cut from it."""
    have = set(df.columns)
    if {"price_std", "avg_price_viewed"} <= have:
        sensitivity = F.col("price_std") / (F.col("avg_price_viewed") + 1)
    else:
        sensitivity = F.lit(0.0)
    df = df.withColumns(
        {
            "price_sensitivity": sensitivity,
            "price_range_tolerance": F.col("price_range") if "price_range" in have else F.lit(0.0),
        }
    )
    share = "price_preference_percentile"
    if "avg_price_viewed" in have:
        df = average_rank_share(df, "avg_price_viewed", share, key, counted_on)
    else:
        df = df.withColumn(share, F.lit(0.5))
    above, below = F.col(share) > 0.75, F.col(share) < 0.25
    return df.withColumns(
        {
            "is_premium_shopper": F.coalesce(above, F.lit(False)).cast("int"),
            "is_budget_shopper": F.coalesce(below, F.lit(False)).cast("int"),
        }
    )


def frequency_encode(df: DataFrame, col: str, out: str, key: str = "user_id", counted_on: DataFrame | None = None) -> DataFrame:
    """Share of the row's value among the non-NULL values of ``col``; 0 for NULL."""
    return value_share(df, F.col(col), out, key, counted_on)


def pair_affinity(
    df: DataFrame, left: str, right: str, out: str, key: str = "user_id", counted_on: DataFrame | None = None
) -> DataFrame:
    """Share of rows with the same pair of values; NULL is a value of its own."""
    pair = F.struct(F.col(left).alias("a"), F.col(right).alias("b"))
    return value_share(df, pair, out, key, counted_on)


def categorical_features(df: DataFrame, key: str = "user_id", counted_on: DataFrame | None = None) -> DataFrame:
    """Frequency scores of brand and category code and their pair affinity.

    ``most_frequent_<col>`` is used where present, else ``<col>``; with neither,
    the frame is returned unchanged.
    """
    source = {}
    for name in ("brand", "category_code"):
        found = [c for c in (f"most_frequent_{name}", name) if c in df.columns]
        if found:
            source[name] = found[0]
    base = df if counted_on is None else counted_on
    for name, col in source.items():
        df = frequency_encode(df, col, f"{name}_frequency_score", key, base)
    if len(source) == 2:
        df = pair_affinity(df, source["brand"], source["category_code"], "brand_category_affinity", key, base)
    return df


def engineer_features(
    df: DataFrame,
    behavioral: bool = True,
    temporal: bool = True,
    engagement: bool = True,
    price: bool = True,
    categorical: bool = True,
    key: str = "user_id",
) -> DataFrame:
    """All derived features; each group can be switched off.

    Ranks and shares are counted on the frame as given, before the other
    features widen its plan.
    """
    given = df
    if behavioral:
        df = behavioral_features(df)
    if temporal:
        df = temporal_features(df)
    if engagement:
        df = engagement_features(df)
    if price:
        df = price_features(df, key, given)
    if categorical:
        df = categorical_features(df, key, given)
    return df


# Leaves out the category id, which is a name and not a quantity.
RECOMMENDED_EXCLUDES = ("user_id", "top_category_id")


def select_features(df: DataFrame, exclude: tuple[str, ...] | list[str] = ("user_id",), key: str = "user_id") -> DataFrame:
    """Key plus every numeric column not excluded, with infinities and NaN as NULL."""
    cols = numeric_columns(df, set(exclude) | {key})
    return df.selectExpr(quoted(key), *[f"{finite_sql(c)} AS {quoted(c)}" for c in cols])
