from segmentry.functions.expressions import (
    finite_or_null,
    finite_sql,
    hours_between,
    number,
    numeric_columns,
    quoted,
    ratio,
    right_closed_bins,
)
from segmentry.functions.quantiles import OrderStats, element_at, exact_quantiles, order_statistics
from segmentry.functions.ranks import average_rank_share, count_values, lookup_join, value_ranks, value_share

__all__ = [
    "OrderStats",
    "average_rank_share",
    "count_values",
    "element_at",
    "exact_quantiles",
    "finite_or_null",
    "finite_sql",
    "hours_between",
    "lookup_join",
    "number",
    "numeric_columns",
    "order_statistics",
    "quoted",
    "ratio",
    "right_closed_bins",
    "value_ranks",
    "value_share",
]
