"""Connected components and dense numbering as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.functions.ranks import ValueCounts, lookup_join, value_ranks
from segmentry.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)``; the component is its smallest node.

    ``edges`` is ``(a, b)``; a self edge introduces a lone node.  Alternates the
    large-star and small-star steps (Kiveris et al., 2014), which end in one star
    per component after a number of rounds logarithmic in its size.  Minima are
    combined map-side, and a hub's edges meet its single minimum in a join that
    adaptive execution splits.
    """
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    stars = materialize(_oriented(edges).distinct())
    state = None
    while True:
        # Already one star per component?  Every node points at one root that points nowhere.
        fans = stars.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        if fans.where("n > 1").isEmpty() and stars.join(fans.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        both = stars.union(stars.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _oriented(large).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = materialize(_oriented(small.union(lowest)).distinct())
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            break
        state = now
    return nodes.join(stars.withColumnsRenamed({"a": "node", "b": "root"}), "node", "left").select(
        "node", F.coalesce("root", "node").alias("component")
    )


def _oriented(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller end, without self edges."""
    a, b = edges.columns
    return edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))


def dense_codes(df: DataFrame, col: str, out: str, key: str) -> DataFrame:
    """Add ``out`` = 0, 1, 2, ... in the order of the distinct values of ``col``; NULL stays NULL."""
    table = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("ties"))
    table = materialize(table)
    distinct, rows = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("ties"), F.lit(0))).first()
    counts = ValueCounts(table, distinct, rows)
    ones = ValueCounts(table.select("value", F.lit(1).alias("ties")), distinct, distinct)
    codes = value_ranks(ones).select("value", (F.col("avg_rank") - 1).cast("int").alias(out))
    return lookup_join(df, F.col(col), counts, table.join(codes, "value"), out, F.col(key))
