"""Data-quality checks and counts on the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions import numeric_columns
from segmentry.functions.ranks import BROADCAST_ROWS
from segmentry.session import materialize


def check_events(df: DataFrame) -> DataFrame:
    """Raise ``ValueError`` on a missing required column or an empty input."""
    missing = [c for c in settings.REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    if df.isEmpty():
        raise ValueError("DataFrame is empty")
    return df


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` for every column, in one aggregate."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_count")


def event_type_distribution(df: DataFrame) -> DataFrame:
    """``(event_type, n_events, proportion)``; the share is of rows with a type."""
    counts = df.where(F.col("event_type").isNotNull()).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))
    total = counts.agg(F.sum("n_events")).scalar()
    return counts.withColumn("proportion", F.col("n_events") / total)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows (NULLs compare equal).

    Only a 64-bit hash of each row is shuffled to find the hashes seen twice;
    whole rows are compared just for those, which also settles collisions.
    """
    cols = df.columns
    hashed = df.withColumn("_hash", F.xxhash64(*cols))
    twice = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    twice = materialize(twice)
    # Few suspects are broadcast, so the other rows are not shuffled again.
    side = F.broadcast(twice) if twice.count() <= BROADCAST_ROWS else twice
    copies = hashed.join(side, "_hash", "left_semi").groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def quality_counts(df: DataFrame) -> DataFrame:
    """One row: rows, negative prices, missing timestamps, duplicate rows."""
    duplicates = duplicate_count(df).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("price") < 0 if "price" in df.columns else F.lit(False)).alias("negative_prices"),
        F.count_if(F.col("event_time").isNull()).alias("invalid_timestamps"),
    ).withColumn("duplicate_rows", duplicates)


def inf_null_row_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows holding any infinity and rows holding any NULL among the numeric columns."""
    cols = cols or numeric_columns(df)
    is_inf = [F.coalesce(F.abs(F.col(c).cast("double")) == F.lit(float("inf")), F.lit(False)) for c in cols]
    is_null = [F.col(c).isNull() for c in cols]
    return df.agg(
        F.count_if(F.exists(F.array(*is_inf), lambda x: x)).alias("rows_with_inf"),
        F.count_if(F.exists(F.array(*is_null), lambda x: x)).alias("rows_with_null"),
    )
