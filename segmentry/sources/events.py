"""Reading event logs: scan, coercion, row caps and samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry import settings
from segmentry.functions.quantiles import element_at
from segmentry.session import materialize


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Partitioned scan of any Spark source (parquet, orc, csv, json, jdbc, ...).

    For ``jdbc`` pass ``partitionColumn`` / ``lowerBound`` / ``upperBound`` /
    ``numPartitions`` so that the read is split over executors.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load() if fmt == "jdbc" else reader.load(path)


def union_inputs(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of several inputs, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def take_rows(df: DataFrame, max_rows: int | None, order_by: Sequence[str] = ()) -> DataFrame:
    """At most ``max_rows`` rows (0 or None = all); an order that is total makes the choice repeatable.

    Not a ``limit``, which would move all its rows through one task: rows per
    partition are counted, and a filter on the position keeps whole partitions up to
    the one where the cap falls.
    """
    if not max_rows:
        return df
    df = df.orderBy(*order_by) if order_by else df
    placed = materialize(df.withColumn("_at", F.monotonically_increasing_id()))
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    left = max_rows
    for r in placed.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row per partition
        if r["count"] >= left:
            return placed.where((part < r["part"]) | ((part == r["part"]) & (row < left))).drop("_at")
        left -= r["count"]
    return placed.drop("_at")


def draw(seed: int, key: Column) -> Column:
    """A number below 2^52 from the md5 of seed and key, which other engines can work out too."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, 13), 16, 10).cast("bigint")


def exact_sample(df: DataFrame, fraction: float, seed: int = settings.SEED, order_key: str | None = None) -> DataFrame:
    """Seeded sample of exactly ``int(rows * fraction)`` rows, without replacement.

    Every row draws an integer from its key; the rows below the draw of the wanted rank are
    kept, and of those that equal it the ones with the smallest keys.  No task gathers the
    sample.  With ``order_key`` (a unique column) the choice depends on the key alone; without,
    rows are numbered once and kept, so that all passes see the same numbers.
    """
    if order_key:
        drawn = df.withColumn("_key", F.col(order_key))
    else:
        drawn = materialize(df.withColumn("_key", F.monotonically_increasing_id()))
    drawn = drawn.withColumn("_draw", draw(seed, F.col("_key")))
    target = int(drawn.count() * fraction)
    if target <= 0:
        return df.limit(0)
    last = int(element_at(drawn, "_draw", target - 1))  # below 2^53, so exact as a double
    below = drawn.where(F.col("_draw") < last)
    # Draws equal to the last one are a handful at most.
    equal = drawn.where(F.col("_draw") == last).orderBy("_key").limit(target - below.count())
    return below.unionByName(equal).drop("_key", "_draw")


def coerce_events(df: DataFrame) -> DataFrame:
    """Cast the known columns; a value that does not parse becomes NULL, NaN prices too.

    Columns that are absent are skipped, columns that are unknown are kept.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    casts = {}
    if "event_time" in types and not types["event_time"].startswith("timestamp"):
        casts["event_time"] = F.col("event_time").try_cast("timestamp")
    for name, target in settings.NUMERIC_COLUMNS.items():
        if name not in types:
            continue
        value = F.col(name)
        if target == "bigint" and types[name] == "string":
            # "12.0" is a number too: go through double only where bigint does not parse.
            value = F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))
        else:
            value = value.try_cast(target)
        casts[name] = F.nanvl(value, F.lit(None).cast("double")) if target == "double" else value
    for name in settings.STRING_COLUMNS:
        if name in types:
            casts[name] = F.col(name).cast("string")
    return df.withColumns(casts) if casts else df


def load_events(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_rows: int | None = None,
    sample_fraction: float | None = None,
    convert_types: bool = True,
    seed: int = settings.SEED,
    schema=None,
    order_key: str | None = None,
    **options,
) -> DataFrame:
    """Scan, optionally cap or sample, and coerce.  A row cap wins over a fraction.

    The sample has exactly ``int(rows * sample_fraction)`` rows; ``order_key`` names a unique column to draw by.
    """
    df = read_table(spark, path, fmt, schema, **options)
    if max_rows:
        df = take_rows(df, max_rows)
    elif sample_fraction and sample_fraction < 1.0:
        df = exact_sample(df, sample_fraction, seed, order_key)
    return coerce_events(df) if convert_types else df


def prepare_events(spark: SparkSession, path: str, validate: bool = True, **options) -> tuple[DataFrame, DataFrame | None]:
    """``load_events`` plus the quality report (``None`` when validation is off)."""
    from segmentry.operators.quality import check_events, quality_counts

    events = load_events(spark, path, **options)
    if not validate:
        return events, None
    check_events(events)
    return events, quality_counts(events)
