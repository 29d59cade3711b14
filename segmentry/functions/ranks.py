"""Global ranks and value lookups that do not funnel rows through one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmentry.functions.expressions import number
from segmentry.session import materialize

RANK_BUCKETS = 1_000
VALUES_PER_BUCKET = 2_048  # fewer values make fewer buckets
HOT_SHARE = 1_000  # a value is hot when it holds more than 1/HOT_SHARE of the rows
SALTS = 64
#: Fixed-width rows (hashes, ranges) that callers broadcast after counting them; the same join runs shuffled beyond.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class ValueCounts:
    """Rows per distinct non-NULL value, computed once, with its size known."""

    table: DataFrame  # (value, ties)
    distinct: int
    rows: int


def count_values(df: DataFrame, value: Column) -> ValueCounts:
    """Copies of a value collapse map-side, so a hot value costs one row per task."""
    table = df.select(value.alias("value")).where(F.col("value").isNotNull())
    table = materialize(table.groupBy("value").agg(F.count(F.lit(1)).alias("ties")))
    distinct, rows = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("ties"), F.lit(0))).first()
    return ValueCounts(table, distinct, rows)


def lookup_join(df: DataFrame, value: Column, counts: ValueCounts, table: DataFrame, out: str, spread: Column) -> DataFrame:
    """Left join ``df`` to ``table`` (``value``, ``ties``, ``out``) on ``value``.

    The hot values, of which there can be at most ``HOT_SHARE``, are broadcast; the
    others are joined by key, where rows of hot values and of NULL keys are
    spread over salts instead of meeting in one task.
    """
    df = df.withColumn("_value", value)
    is_hot = F.col("ties") * HOT_SHARE > counts.rows
    hot = table.where(is_hot).select(F.col("value").alias("_value"), F.lit(True).alias("_hot"), F.col(out).alias("_hot_out"))
    cold = table.where(~is_hot).select(
        F.col("value").alias("_value"), F.lit(0).cast("bigint").alias("_salt"), F.col(out).alias("_cold_out")
    )
    marked = df.join(F.broadcast(hot), "_value", "left")
    aside = F.col("_hot").isNotNull() | F.col("_value").isNull()
    salt = F.when(aside, F.pmod(F.xxhash64(spread), F.lit(SALTS)) + 1).otherwise(F.lit(0))
    joined = marked.withColumn("_salt", salt.cast("bigint")).join(cold, ["_value", "_salt"], "left")
    return joined.withColumn(out, F.when(F.col("_hot"), F.col("_hot_out")).otherwise(F.col("_cold_out"))).drop(
        "_value", "_salt", "_hot", "_hot_out", "_cold_out"
    )


def value_ranks(counts: ValueCounts) -> DataFrame:
    """``(value, ties, avg_rank)``, average-tie rank from 1.

    The distinct values are cut into buckets at their approximate quantiles and cumulated
    inside each bucket; bucket totals, at most ``RANK_BUCKETS`` rows, give the offsets.
    """
    upto = F.col("_upto") - (F.col("ties") - 1) / 2
    running = (Window.unboundedPreceding, Window.currentRow)
    buckets = min(RANK_BUCKETS, -(-counts.distinct // VALUES_PER_BUCKET))
    grid = [i / buckets for i in range(1, buckets)]
    edges = sorted(set(counts.table.agg(F.percentile_approx("value", grid, 10_000)).first()[0] or [])) if grid else []
    # Number of edges at or below the value; rows of one value share a bucket.
    # As SQL text: one call into the JVM instead of one per edge.
    bucket = F.expr(f"size(filter(array({', '.join(number(float(e)) for e in edges)}), e -> e <= value))") if edges else F.lit(0)
    table = counts.table.withColumn("_bucket", bucket)
    totals = table.groupBy("_bucket").agg(F.sum("ties").alias("_in_bucket"))
    before = F.sum("_in_bucket").over(Window.orderBy("_bucket").rowsBetween(*running)) - F.col("_in_bucket")
    totals = totals.select("_bucket", before.alias("_before"))
    within = Window.partitionBy("_bucket").orderBy("value").rowsBetween(*running)
    ranked = table.withColumn("_upto", F.sum("ties").over(within)).join(F.broadcast(totals), "_bucket")
    return ranked.select("value", "ties", (F.col("_before") + upto).alias("avg_rank"))


def average_rank_share(df: DataFrame, col: str, out: str, key: str, counted_on: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = average-tie rank of ``col`` / number of non-NULL values; NULL stays NULL."""
    counts = count_values(df if counted_on is None else counted_on, F.col(col))
    table = value_ranks(counts).select("value", "ties", (F.col("avg_rank") / F.lit(counts.rows)).alias(out))
    return lookup_join(df, F.col(col), counts, table, out, F.col(key))


def value_share(df: DataFrame, value: Column, out: str, key: str, counted_on: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = share of the row's value among non-NULL values; NULL gets 0."""
    counts = count_values(df if counted_on is None else counted_on, value)
    table = counts.table.withColumn(out, F.col("ties") / F.lit(max(counts.rows, 1)))
    return lookup_join(df, value, counts, table, out, F.col(key)).fillna(0.0, [out])
