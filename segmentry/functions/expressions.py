"""Small column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """``num / den`` where ``den`` is positive, else ``default`` (ANSI-safe)."""
    return F.when(den > 0, num / den).otherwise(F.lit(default).cast("double"))


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def finite_or_null(col: Column) -> Column:
    """NaN and both infinities become NULL (Spark orders NaN above infinity)."""
    col = col.cast("double")
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def number(value: float) -> str:
    """SQL literal of exactly this double, infinities and NaN included."""
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"DOUBLE('{value}')"


def finite_sql(name: str) -> str:
    """``finite_or_null`` as SQL text, for projections over many columns."""
    value = f"CAST({quoted(name)} AS DOUBLE)"
    return f"CASE WHEN abs({value}) < DOUBLE('Infinity') THEN {value} END"


def right_closed_bins(col: Column, edges: list[float], labels: list[str], include_lowest: bool = False) -> Column:
    """Label of the bin ``(edge_i, edge_i+1]``; the last bin is open to +inf.

    Values at or below the first edge are NULL, unless ``include_lowest`` lets
    the first edge itself into the first bin.
    """
    first = col >= edges[0] if include_lowest else col > edges[0]
    out = F.when(col.isNull() | ~first, None)
    for upper, label in zip(edges[1:], labels):
        out = out.when(col <= upper, label)
    return out.otherwise(labels[-1])


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (NumericType, DecimalType)) and f.name not in exclude
    ]
