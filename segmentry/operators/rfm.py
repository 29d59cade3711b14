"""Recency, frequency and monetary columns with quintile scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions import exact_quantiles
from segmentry.session import gathered

QUINTILES = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]


def add_rfm_columns(customers: DataFrame, recency_mode: str = "reference") -> DataFrame:
    """``recency``, ``frequency``, ``frequency_events``, ``monetary``.

    ``recency_mode="reference"`` counts days from the first event of the log to
    the customer's last one; ``"as_of"`` counts days back from the latest
    customer, so that the highest score goes to the most recent.
    """
    if "days_since_last_event" not in customers.columns:
        recency: Column = F.lit(0).cast("bigint")
    elif recency_mode == "reference":
        recency = F.col("days_since_last_event")
    elif recency_mode == "as_of":
        recency = customers.agg(F.max("days_since_last_event")).scalar() - F.col("days_since_last_event")
    else:
        raise ValueError(f"Unknown recency mode: {recency_mode}")
    return customers.withColumns(
        {
            "recency": recency,
            "frequency": F.col("purchase_count"),
            "frequency_events": F.col("total_events"),
            "monetary": F.col("total_spending"),
        }
    )


def quantile_score(col: str, edges: list[float | None]) -> Column:
    """1 + number of interior edges below the value; equal edges count once.

    NULL when fewer than two edges differ, as there is then no bin to fall in.
    """
    unique = sorted({e for e in edges if e is not None})
    if len(unique) < 2:
        return F.lit(None).cast("int")
    score = F.lit(1)
    for edge in unique[1:-1]:
        score = score + (F.col(col) > F.lit(edge)).cast("int")
    return F.when(F.col(col).isNotNull(), score)


def rfm_scores(customers: DataFrame, recency_mode: str = "reference") -> DataFrame:
    """RFM columns plus ``recency_score`` (reversed), ``frequency_score``, ``monetary_score``."""
    df = add_rfm_columns(customers, recency_mode)
    edges = exact_quantiles(df, ["recency", "frequency", "monetary"], QUINTILES)
    return df.withColumns(
        {
            "recency_score": 6 - quantile_score("recency", edges["recency"]),
            "frequency_score": quantile_score("frequency", edges["frequency"]),
            "monetary_score": quantile_score("monetary", edges["monetary"]),
        }
    )


def aggregate_events(events: DataFrame, include_rfm: bool = True, preferred: bool = False) -> DataFrame:
    """Customer features, with RFM scores unless switched off.

    The customer table is kept (memory, then disk) because the score edges are
    read from it before the scores are written.
    """
    from segmentry.operators.customers import customer_features

    customers = customer_features(events, preferred=preferred).persist()
    customers = gathered(customers, customers.count())
    return rfm_scores(customers) if include_rfm else customers
