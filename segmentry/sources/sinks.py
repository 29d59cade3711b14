"""Result sinks: tables as CSV, reports and name lists as text, all through Spark writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str) -> None:
    """Comparison and profile tables (a handful of rows) as one CSV part with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """Markdown report as a text file in whatever file system ``path`` names."""
    lines = [(i, line) for i, line in enumerate(text.split("\n"))]
    rows = spark.createDataFrame(lines, "i int, value string").coalesce(1).sortWithinPartitions("i")
    rows.select("value").write.mode("overwrite").text(path)


def write_feature_names(spark: SparkSession, names: list[str], path: str) -> None:
    rows = spark.createDataFrame(list(enumerate(names)), "position int, feature string")
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def read_feature_names(spark: SparkSession, path: str) -> list[str]:
    return [r["feature"] for r in spark.read.parquet(path).orderBy("position").collect()]
